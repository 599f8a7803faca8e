"""Packing and BPE coding, against the tokenizers library and the contract's invariants."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mixloom.llm.byte_bpe import byte_encoding
from mixloom.llm.packing import Packer, pack_documents
from mixloom.llm.word_bpe import code_digests, decode_documents, encode_documents, merge_by_heap, merge_by_scan, word_bpe

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
HARD = [
    None, "", " ", "a", "<|endoftext|>", "a<|startoftext|>b<|EndOfText|> <|endoftext|>  c", "x" * 3000, "ab" * 700 + " " + "Stra\u00dfe" * 200,
    "it's I'LL we've", "\u03a3\u0391\u03a3 \u0130 \u01c5 \u1e9e \u00e9\u0301", "\x1c\x1d\x85\xa0\u2028\u3000\ufeff", "1\u0663\u00b2\u2167 \u4e2d\u6587 \U0001f600",
]


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_library(text):
    by_bytes, by_words = Tokenizer.from_file(BYTES) if not CACHE else CACHE[0], CACHE[1] if CACHE else Tokenizer.from_file(WORDS)
    CACHE[:] = [by_bytes, by_words]
    assert byte_encoding(BYTES)(text).tolist() == by_bytes.encode(text, add_special_tokens=False).ids
    ids = by_words.encode(text, add_special_tokens=False).ids
    assert word_bpe(WORDS).encode(text) == ids
    assert word_bpe(WORDS).decode(ids) == by_words.decode(ids, skip_special_tokens=False)


CACHE: list = []


@given(st.lists(st.integers(0, 4), min_size=1, max_size=40))
def test_heap_and_scan_merge_alike(parts):
    pairs = {0 << 32 | 1: (2, 5), 5 << 32 | 0: (0, 6), 1 << 32 | 1: (1, 7), 2 << 32 | 2: (3, 2), 7 << 32 | 3: (4, 8)}
    assert merge_by_scan(list(parts), pairs) == merge_by_heap(list(parts), pairs)


def frame(spark, texts):
    rows = [(k, t, "clash", 1) for k, t in enumerate(texts)] + [(None, "no id", "x", 2), (1, texts[1], "again", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")


def test_code_digests(spark, libraries):
    rows = code_digests(frame(spark, HARD), WORDS).collect()
    assert len(rows) == len(HARD) + 2
    by_id = {row["doc_id"]: row for row in rows}
    for k, text in enumerate(HARD):
        ids = libraries[1].encode(text or "", add_special_tokens=False).ids
        decoded = libraries[1].decode(ids, skip_special_tokens=False)
        assert by_id[k]["n_tokens"] == len(ids)
        assert by_id[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert by_id[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_encode_and_decode(spark, libraries):
    encoded = encode_documents(frame(spark, HARD), WORDS)
    decoded = {row["doc_id"]: row["text"] for row in decode_documents(encoded, WORDS).collect()}
    for k, text in enumerate(HARD):
        assert decoded[k] == libraries[1].decode(libraries[1].encode(text or "", add_special_tokens=False).ids, skip_special_tokens=False)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert code_digests(none, WORDS).collect() == []
    assert pack_documents(none, BYTES).collect() == []


def check_pieces(pieces, documents, window=1024):
    """``documents``: ids by key; every id in one piece, sequences gapless, no padding but at powers of two."""
    fills: dict = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == fills.get(p["sequence_id"], 0)
        fills[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(0 < f <= window for f in fills.values())
    assert all(f & (f - 1) == 0 for f in fills.values())
    for key, ids in documents.items():
        at = 0
        for p in sorted((p for p in pieces if p["doc_id"] == key), key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)


def test_pack_documents(spark, libraries):
    texts = [*HARD, *["word " * n for n in (1, 10, 500, 1022, 1023, 1024, 5000)]]
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in enumerate(texts)] + [(None, "no id", "x", 2)], "doc_id long, text string, sequence_id string, length int")
    expected = {k: [*libraries[0].encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}
    expected[None] = [*libraries[0].encode("no id").ids, 0]
    check_pieces(pack_documents(docs.repartition(3), BYTES).collect(), expected)


def test_repeated_rows_are_packed_apart(spark):
    docs = spark.createDataFrame([(1, "same text"), (1, "same text")], "doc_id long, text string")
    pieces = pack_documents(docs.coalesce(1), BYTES).collect()
    assert sum(p["length"] for p in pieces) == 2 * pieces[0]["doc_tokens"]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60))
def test_packer(sizes):
    packer = Packer(16, 0)
    for k, n in enumerate(sizes):
        packer.add(k, np.arange(n, dtype=np.uint32))
    packer.close()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check_pieces([dict(zip(names, r, strict=True)) for r in packer.rows], {k: list(range(n)) for k, n in enumerate(sizes)}, 16)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 15), min_size=1, max_size=40))
def test_placement_minimises_the_sum_of_squares(sizes):
    packer = Packer(16, 0)
    for k, n in enumerate(sizes):
        before = packer.levels.copy()

        def squares(level, n=n, before=before):
            levels = before.copy()
            levels[level] -= level > 0
            if level + n < 16:
                levels[level + n] += 1
            return int((levels[1:16] ** 2).sum())

        allowed = [0, *(h for h in range(1, 17 - n) if before[h])]
        packer.add(k, np.arange(n, dtype=np.uint32))
        assert int((packer.levels[1:16] ** 2).sum()) == min(map(squares, allowed))
