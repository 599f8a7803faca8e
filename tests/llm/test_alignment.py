"""Alignment of two tokenizers, against plain loops over the libraries' own tokens."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mixloom.llm import alignment as al
from mixloom.llm.byte_bpe import LONG_SPACE, byte_encoding, byte_of_char

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def byte_level():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer


def tokens(text, byte_level):
    """(ids of A, their bytes, ids of B, their bytes), or nothing at all."""
    if not text:
        return [], [], [], []
    to_byte = byte_of_char()
    a = byte_level.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(to_byte[c] for c in byte_level.id_to_token(i)) for i in a]
    processor = al.pieces(B)[0]
    b = processor.encode(text)
    bytes_b = [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, processor.id_to_piece(i)) for i in b)]
    whole = (" " + text).encode()
    return (a, bytes_a, b, bytes_b) if b"".join(bytes_a) == b"".join(bytes_b) == whole else ([], [], [], [])


def spans(parts):
    out, at = [], 0
    for part in parts:
        out.append((at, at + len(part)))
        at += len(part)
    return out


def brute(rows, byte_level):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per row."""
    links, groups = [], []
    for _, text in rows:
        a, bytes_a, b, bytes_b = tokens(text, byte_level)
        span_a, span_b = spans(bytes_a), spans(bytes_b)
        links.append([(a[i], b[j]) for i, (s, e) in enumerate(span_a) for j, (t, f) in enumerate(span_b) if max(s, t) < min(e, f)])
        ends = sorted({e for _, e in span_a} & {e for _, e in span_b})
        cut, parts = 0, []
        for end in ends:
            inside = lambda span: cut <= span[0] and span[1] <= end  # noqa: B023, E731
            parts.append(([x for x, s in zip(a, span_a) if inside(s)], [x for x, s in zip(b, span_b) if inside(s)]))
            cut = end
        groups.append(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in parts))
    documents = Counter(pair for one in links for pair in set(one))
    most = {}
    for (a, _), n in documents.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (doc, text), one, group in zip(rows, links, groups):
        a, _, b, _ = tokens(text, byte_level)
        best = sum(documents[pair] == most[pair[0]] for pair in one)
        digest = hashlib.sha256(group.encode()).hexdigest() if group else ""
        out.append((doc, len(a), len(b), group.count(";") + bool(group), len(one), best, sum(documents[p] for p in one), digest))
    return out


TEXTS = [
    "The quick brown fox, jumping over 12345 lazy dogs!", " leading and  double  spaces ", "naïve café — déjà vu; Ünïcödé   line",
    "日本語のテキスト and 한국어 😀😀🏳️‍🌈", "<|endoftext|> <s> </s> <unk> <0x41> <|im_start|>", "meta ▁ sign", "tab\tand\nnew\r\nline\x00\x01",
    "", None, " ", "a", "aaaaaaaaaaaaaaaaaaaaaaaa" * 40, "the the the the THE The", "x = [i for i in range(10)]\n\n\n    return x",
]


@pytest.mark.parametrize("partitions", [1, 5])
def test_digests_equal_brute_force(spark, byte_level, partitions, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2]), (2, "The other row of an id"), (None, TEXTS[0])]
    frame = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, block string, n_a int")
    found = al.alignment_digests(frame.repartition(partitions), A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute(rows, byte_level), key=repr)


def test_documents_of_many_kinds(spark, byte_level, sf_texts):
    frame = spark.createDataFrame(sf_texts, "doc_id long, text string")
    found = al.alignment_digests(frame, A, B).collect()
    assert sorted(map(tuple, found)) == sorted(brute(sf_texts, byte_level))


@pytest.fixture(scope="module")
def sf_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 1500").select("doc_id", "text")
    return [tuple(r) for r in docs.orderBy("doc_id").collect()]


def test_real_tokens_come_back(spark):
    frame = spark.createDataFrame([(1, TEXTS[0]), (2, ""), (3, None), (4, TEXTS[3])], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in al.aligned_tokens(frame, A, B).collect()}
    of_a, of_b = al.byte_tokens(A), al.pieces(B)[1]
    for doc, text in ((1, TEXTS[0]), (4, TEXTS[3])):
        row = rows[doc]
        assert b"".join(of_a[i] for i in row["a"]) == b"".join(of_b[i] for i in row["b"]) == (" " + text).encode()
        assert sum(g["n_a"] for g in row["groups"]) == len(row["a"]) and sum(g["n_b"] for g in row["groups"]) == len(row["b"])
        at_a = at_b = 0
        for group in row["groups"]:
            one, two = row["a"][at_a : at_a + group["n_a"]], row["b"][at_b : at_b + group["n_b"]]
            assert b"".join(of_a[i] for i in one) == b"".join(of_b[i] for i in two)
            at_a, at_b = at_a + group["n_a"], at_b + group["n_b"]
    assert rows[2]["a"] == rows[3]["b"] == rows[2]["groups"] == []


def test_windows_do_not_change_groups(monkeypatch):
    texts = ["word " * 500, None, "日本語" * 100, "xy z" * 300]
    whole = al.Alignment(texts, A, B)
    monkeypatch.setattr(al, "WINDOW", 7)
    cut = al.Alignment(texts, A, B)
    assert (whole.cut_a == cut.cut_a).all() and (whole.cut_b == cut.cut_b).all() and len(whole.cut_a) > 500


def test_empty_table_and_very_long_text(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert al.alignment_digests(empty, A, B).count() == 0
    rows = [(1, " " * 1_200_000 + "end"), (2, "lorem ipsum " * 150_000), (3, "short")]
    found = {r["doc_id"]: r for r in al.alignment_digests(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()}
    assert found[1]["n_a"] > 1_000_000 and found[2]["n_groups"] > 300_000 and found[3]["n_links"] > 0


@pytest.mark.parametrize("special", [True, False])
def test_long_white_space_is_encoded_as_by_the_library(special):
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = not special
    encode = byte_encoding(A, special)
    for space in (" ", "\n", "\t", "　", " \n", "\x85"):
        run = space * (LONG_SPACE + 5)
        for text in (run, run + "word", "word" + run, "a" + run + " b" + run + "!", run + "<|endoftext|>", run + "\x1cx"):
            assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr((space, text[-20:]))


def test_two_million_blanks_do_not_end_the_job():
    encode = byte_encoding(A)
    for space in (" ", "\n", "\t"):
        for tail in ("", "word"):
            assert len(encode(space * 2_000_000 + tail)) >= 1_000_000
