"""Two tokenizers' ids of the same texts, cut into groups where both have a token's end.

*Groups.* The tokens of a text cover the same bytes in both tokenizers. The cumulative ends of
each side are the keys of a dictionary from end to index; the sorted common keys of both are
where the id lists are cut, so that a pair of slices is the smallest stretch both tokenize.
Dictionaries are made of a window of ``WINDOW`` tokens at a time, so a long text needs no more
memory than its ids.

*Links.* Inside a slice a link is made of every token of one side with every token of the other
that shares a byte with it. Between two neighbouring ends of either side there is one token of
each, so a slice of m and n tokens has m + n - 1 links.

*Counts.* A block of documents sends each pair of linked ids once, with the number of its
documents that hold it. Spark sums pairs before it shuffles them, finds the highest count of
each id of the first tokenizer (at most one row per vocabulary entry, which bounds what is
broadcast), and answers each block in the order it asked. No text is tokenized twice.

Defined results: the second tokenizer puts a space before a text, so the first is given one.
A null or empty text has no tokens, nor has one whose bytes a tokenizer does not keep; strings
of special tokens are text as any other. Rows are documents of their own, also where they share
an id or have none; an empty table gives no rows; other columns are not read.
"""

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.blocks import BLOCK_BITS, pack, sub_batches, unpack
from mixloom.llm.byte_bpe import byte_encoding, vocabulary
from mixloom.storage import staged

BLOCK_BYTES = 4 << 20  # of text
WINDOW = 1 << 12
META = "\u2581"  # how the pieces of the second tokenizer write a space
STRETCHES = re.compile(" +[^ ]*")
KEPT, KEPT_LENGTH = 1 << 18, 48  # stretches whose ids a worker keeps, and their longest


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> list[bytes]:
    """By id the bytes of the entries of a byte-level BPE file."""
    known, special = vocabulary(path)
    out = [b""] * (max([*known.values(), *special.values()]) + 1)
    for token, number in known.items():
        out[number] = token
    return out


@lru_cache(maxsize=2)
def pieces(path: str):
    """The processor of a piece file, and by id the bytes of its pieces."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        byte = processor.is_byte(number)
        out.append(bytes([int(piece[1:-1], 16)]) if byte else piece.replace(META, " ").encode())
    return processor, out


class PieceEncoder:
    """Ids by a piece file, stretch by stretch: a stretch is spaces and what follows up to the next
    space. No piece has a space after another character, so none crosses from one stretch into the
    next, and the ids of a text are those of its stretches; frequent ones are kept. A file with such
    pieces has its texts encoded whole."""

    def __init__(self, path: str):
        self.processor, self.bytes = pieces(path)
        self.kept: dict[str, bytes | None] = {}  # ids as four bytes each
        self.apart = not any(b" " in token.lstrip(b" ") for token in self.bytes)

    def _learn(self, stretches: set[str]) -> dict[str, bytes | None]:
        """The ids of stretches, which begin with the space that the processor adds; None for those
        whose ids do not keep their bytes."""
        listed = list(stretches)
        out = {}
        for one, ids in zip(listed, self.processor.encode([one[1:] for one in listed], num_threads=1), strict=True):
            ids = ids if one != " " else [self.processor.piece_to_id(META)]
            out[one] = array("I", ids).tobytes() if b"".join([self.bytes[i] for i in ids]) == one.encode() else None
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The ids of each text, with the space before it; None if they do not keep its bytes. A
        null or empty text has none."""
        split = [(STRETCHES.findall(" " + text) if self.apart else [" " + text]) if text else [] for text in texts]
        seen = set(chain.from_iterable(split))
        new = self._learn(seen - self.kept.keys())
        if len(self.kept) + len(new) > KEPT:
            self.kept = {one: self.kept[one] for one in seen & self.kept.keys()}
        fits = len(self.kept) + len(new) <= KEPT
        if fits and max(map(len, new), default=0) <= KEPT_LENGTH:
            self.kept.update(new)
            of_texts = self.kept
        else:
            of_texts = self.kept | new
            self.kept.update((one, ids) for one, ids in new.items() if fits and len(one) <= KEPT_LENGTH)
        out: list[np.ndarray | None] = []
        for stretches in split:
            found = [of_texts[one] for one in stretches]
            out.append(None if None in found else np.frombuffer(b"".join(found), np.uint32))
        return out


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """Kept per Python worker."""
    return PieceEncoder(path)


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side are before every common end, in rising order."""
    cuts: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
    for begin in range(0, len(ends_a), WINDOW):
        window = ends_a[begin : begin + WINDOW]
        low, high = np.searchsorted(ends_b, [window[0], window[-1] + 1])
        index_a = dict(zip(window.tolist(), range(begin + 1, begin + 1 + len(window))))
        index_b = dict(zip(ends_b[low:high].tolist(), range(int(low) + 1, int(high) + 1)))
        both = sorted(index_a.keys() & index_b.keys())
        cuts.append(np.array([[index_a[end] for end in both], [index_b[end] for end in both]], np.int64))
    cut_a, cut_b = np.concatenate(cuts, axis=1)
    return cut_a, cut_b


@lru_cache(maxsize=2)
def token_sizes(path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray]:
    """By id the bytes of both sides' tokens."""
    one, two = (np.array([len(t) for t in side], np.int64) for side in (byte_tokens(path_a), pieces(path_b)[1]))
    return one, two


class Alignment:
    """The aligned tokens of some texts: ids ``a`` and ``b`` of all of them in a row, ``from_a``
    and ``from_b`` where each text's begin, and groups as ``cut_a`` and ``cut_b``, how many
    tokens there are up to the end of each."""

    def __init__(self, texts: list[str | None], path_a: str, path_b: str):
        encode, encoder = byte_encoding(path_a, False), piece_encoder(path_b)
        size_a, size_b = token_sizes(path_a, path_b)
        b = encoder.encode(texts)
        none = np.zeros(0, np.uint32)
        b = [none if ids is None else ids for ids in b]
        a = [encode(" " + text) if len(ids) else none for text, ids in zip(texts, b, strict=True)]
        self.from_a, self.from_b = (np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate([*side, none]).astype(np.int64) for side in (a, b))
        self.ends_a, self.ends_b = np.cumsum(size_a[self.a]), np.cumsum(size_b[self.b])
        self.cut_a, self.cut_b = common_cuts(self.ends_a, self.ends_b)
        self.n_groups = np.diff(np.searchsorted(self.cut_a, self.from_a, "right"))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, index in ``a``, index in ``b``) of every link, in order."""
        ends = np.concatenate([self.ends_a, self.ends_b])
        ends.sort(kind="stable")
        ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])] if len(ends) else ends
        at_a, at_b = np.searchsorted(self.ends_a, ends), np.searchsorted(self.ends_b, ends)
        return np.searchsorted(self.from_a, at_a, "right") - 1, at_a, at_b

    def group_strings(self) -> Iterator[memoryview]:
        """By text its groups as ``a1,a2|b1;a3|b2,b3``."""
        table, width = _number_strings(int(self.a.max(initial=0)), int(self.b.max(initial=0)))
        size_a, size_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        place_a = np.arange(len(self.a)) + np.repeat(self.cut_b - size_b, size_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.cut_a, size_b)
        text = np.empty(len(self.a) + len(self.b), np.int64)
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), np.int64)
        last_a[self.cut_a - 1] = True
        last_b[self.cut_b - 1] = 1
        last_b[self.from_b[1:][np.diff(self.from_b) > 0] - 1] = 2
        text[place_a] = 2 * self.a + last_a
        text[place_b] = width + 3 * self.b + last_b
        joined = table.take(pa.array(text))
        offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
        data = memoryview(joined.buffers()[2] or b"") if len(joined) else memoryview(b"")
        starts = offsets[self.from_a + self.from_b]
        for low, high in zip(starts[:-1], starts[1:], strict=True):
            yield data[low:high]


@lru_cache(maxsize=4)
def _number_table(upto_a: int, upto_b: int) -> pa.Array:
    first = [f"{i}{s}" for i in range(upto_a) for s in (",", "|")]
    return pa.array([*first, *(f"{i}{s}" for i in range(upto_b) for s in (",", ";", ""))], pa.large_string())


def _number_strings(most_a: int, most_b: int) -> tuple[pa.Array, int]:
    """Ids with what may follow them, and where those of the second side begin."""
    upto_a, upto_b = 1 << most_a.bit_length(), 1 << most_b.bit_length()
    return _number_table(upto_a, upto_b), 2 * upto_a


def _chosen(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def aligned_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a, b, groups) of every row: the ids of both tokenizers, and per group how many
    of each it has."""
    group = pa.struct([("n_a", pa.int32()), ("n_b", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 1):
            found = Alignment(batch.column(1).to_pylist(), path_a, path_b)
            at = np.concatenate([[0], np.cumsum(found.n_groups)])
            sizes = pa.StructArray.from_arrays(
                [pa.array(np.diff(c, prepend=0), pa.int32()) for c in (found.cut_a, found.cut_b)], fields=list(group)
            )
            lists = [
                pa.ListArray.from_arrays(pa.array(begin, pa.int32()), values)
                for begin, values in ((found.from_a, pa.array(found.a, pa.int32())), (found.from_b, pa.array(found.b, pa.int32())), (at, sizes))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["doc_id", "a", "b", "groups"])

    schema = "doc_id long, a array<int>, b array<int>, groups array<struct<n_a: int, n_b: int>>"
    return _chosen(docs, id_col, text_col).mapInArrow(run, schema)


OWN = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string())])


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _block_row(number: int, batch: pa.RecordBatch, path_a: str, path_b: str) -> pa.RecordBatch:
    """What a block knows of its documents, and the pairs it asks for with its own counts."""
    found = Alignment(batch.column(1).to_pylist(), path_a, path_b)
    docs = batch.num_rows
    text, at_a, at_b = found.links()
    width = len(pieces(path_b)[1])
    pairs, pair = np.unique(found.a[at_a] * width + found.b[at_b], return_inverse=True)
    entries, times = np.unique(text * max(1, len(pairs)) + pair, return_counts=True)
    doc_of, pair_of = entries // max(1, len(pairs)), entries % max(1, len(pairs))
    digests = [hashlib.sha256(s).hexdigest() if len(s) else "" for s in found.group_strings()]
    counts = [np.diff(found.from_a), np.diff(found.from_b), found.n_groups, np.bincount(text, minlength=docs)]
    own = pa.RecordBatch.from_arrays(
        [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string())], schema=OWN
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, OWN) as writer:
        writer.write_batch(own)
    packet = pack(sink.getvalue().to_pybytes(), *map(_narrow, (np.bincount(doc_of, minlength=docs), pair_of, times)))
    asked = [pairs // width, pairs % width, np.bincount(pair_of, minlength=len(pairs))]
    columns = [pa.array([number], pa.int64()), pa.array([packet], pa.binary()), *(pa.array([c], pa.list_(pa.int32())) for c in asked)]
    return pa.RecordBatch.from_arrays(columns, ["block", "packet", "a", "b", "n"])


def pair_counts(asked: DataFrame) -> DataFrame:
    """(a, b, count, best) of the rows (a, b, n): how many documents link the pair, and whether
    no pair of that ``a`` has more."""
    counts = asked.groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # at most one row per id of the first tokenizer
    return counts.join(F.broadcast(most), "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment_digests(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row:
    ``n_best`` are its links whose pair no other pair of the same first id exceeds in documents,
    ``count_sum`` the documents of the pairs of all its links."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << BLOCK_BITS
        for batch in sub_batches(batches, 1, BLOCK_BYTES):
            yield _block_row(number, batch, path_a, path_b)
            number += 1

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own, per_doc, pair_of, times = unpack(batch.column(0)[row].as_py())
                docs_here = pa.ipc.open_stream(own).read_next_batch()
                known, best = np.zeros(len(pair_of), np.int64), np.zeros(len(pair_of), bool)
                answers = batch.column(1)[row].values
                if answers is not None:
                    order = np.argsort(answers.field("pos").to_numpy())
                    known = answers.field("count").to_numpy()[order][pair_of]
                    best = answers.field("best").to_numpy(zero_copy_only=False)[order][pair_of]
                upto = np.concatenate([[0], np.cumsum(per_doc, dtype=np.int64)])
                sums = [np.diff(np.concatenate([[0], np.cumsum(times * of_pair, dtype=np.int64)])[upto]) for of_pair in (best, known)]
                columns = [*docs_here.columns[:5], *map(pa.array, sums), docs_here.column(5)]
                yield pa.RecordBatch.from_arrays(columns, [*OWN.names[:5], "n_best", "count_sum", "groups_sha256"])

    schema = "block long, packet binary, a array<int>, b array<int>, n array<int>"
    blocks = staged(_chosen(docs, id_col, text_col).mapInArrow(send, schema), "aligned-blocks")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("pos", "pair")).select("block", "pos", "pair.*")
    known = staged(pair_counts(asked), "pair-counts")
    answers = asked.join(known, ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("pos", "count", "best")).alias("answers"))
    told = blocks.select("block", "packet").join(answers, "block", "left").select("packet", "answers")
    return told.mapInArrow(finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
