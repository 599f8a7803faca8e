"""Removal of repeated word windows, compacted along their sources.

Every window of ``k`` words is an edge of a de Bruijn graph whose nodes are its first and its
last ``k - 1`` words. An edge is labelled with its source: the place of its occurrence in the
smallest document that has it. Windows of other documents are repeats of their source.

1. *Anchors.* Equal windows have equal smallest ``m``-word hashes. Blocks send their distinct
   anchors; those of at least two documents come back. Windows without one cannot repeat, so
   only the others, a small part, go on as edges.
2. *Edges.* Blocks send one entry per distinct candidate edge; grouping by edge gives its
   source, which goes back to every block that has repeats of it.
3. *Paths.* Joined back to its block, an edge follows another on the same path when both its
   place and its source move on by one word; each run of such edges becomes one row. Runs
   are not cut where another document branches off, so node degrees are not needed.
4. *Verification.* Each path's source coordinates are joined to the block of its source,
   which digests the words that stand there. The block of the repeat digests its own words and
   stops the job if they differ, so no hash collision can remove a word unnoticed.

A block sends an anchor or edge once however often it has it, so a passage that a third of
all documents share costs a bucket one entry per block. Buckets grow in number with the text.

Defined results: a null text has no words; a document with fewer than ``k`` words loses none;
repeated rows with one id do not remove each other's words; rows with a null id neither hold
nor lose windows; an empty table gives no rows. Other columns pass through
``remove_repeats`` as they are.
"""

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.llm.blocks import BLOCK_BYTES, Words, by_bucket, from_payload, pack, runs_hash, stage_blocks, text_bytes, unpack
from mixloom.storage import staged

K = 13
ANCHOR_WORDS = 6
#: Text per bucket of anchors and edges.
BUCKET_BYTES = 4 << 20
LOW_40 = np.uint64((1 << 40) - 1)
LOW_16 = np.uint64(0xFFFF)


class Windows:
    """A block's words and the hashes of its windows; ``valid`` marks windows that lie inside
    one document with an id."""

    def __init__(self, payload: bytes, id_col: str, text_col: str, k: int):
        self.rows = from_payload(payload)
        names = self.rows.schema.names
        ids = self.rows.column(names.index(id_col))
        has_id = ids.is_valid().to_numpy(zero_copy_only=False)
        self.doc_ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = Words(self.rows.column(names.index(text_col)).cast(pa.binary()).to_pylist())
        lanes = self.words.hashes()
        self.lanes = [lane[self.words.ids] for lane in lanes]
        of = self.words.text_of
        n = max(0, len(of) - k + 1)
        self.valid = (of[:n] == of[k - 1 :]) & has_id[of[:n]] if n else np.zeros(0, bool)
        self.doc = of[:n]
        self.k = k

    def anchors(self) -> np.ndarray:
        """For each window, the smallest hash among its runs of ``ANCHOR_WORDS`` words."""
        if not len(self.valid):
            return np.zeros(0, np.uint64)
        m = min(ANCHOR_WORDS, self.k)
        least, span, width = runs_hash(self.lanes[0], m), self.k - m + 1, 1
        while width < span:
            step = min(width, span - width)
            least = np.minimum(least[: len(least) - step], least[step:])
            width += step
        return least[: len(self.valid)]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        return runs_hash(self.lanes[0], self.k), runs_hash(self.lanes[1], self.k)

    def digest(self, start: int, windows: int) -> bytes:
        words = self.words.words(start, start + windows + self.k - 1)
        return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _five(keys: np.ndarray) -> bytes:
    """The low five bytes of each key."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").reshape(-1).astype(np.uint64)


def _rows(names: list[str], types: list, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


PACKET = ["bucket", "block", "packet"]
PACKET_TYPES = [pa.int32(), pa.int64(), pa.binary()]
PACKET_SCHEMA = "bucket int, block long, packet binary"


def _entries(w: Windows, block: int, at: np.ndarray, one: np.ndarray, two: np.ndarray, buckets: int):
    """Packets of one entry per distinct edge: its first place in the block, the place in
    the block's smallest document that has it, the edge's hash, whether several documents
    here have it, and that smallest document."""
    if not len(at):
        return
    doc = w.doc_ids[w.doc[at]]
    order = np.lexsort((at, doc, two, one))
    new = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
    begins = np.flatnonzero(new)
    ends = np.concatenate([begins[1:], [len(order)]]) - 1
    least = order[begins]
    place = np.minimum.reduceat(at[order], begins)
    several = doc[order[ends]] != doc[least]
    one, two, least_at, least_doc = one[least], two[least], at[least], w.doc[at[least]]
    by_place = np.argsort(place)
    bucket = ((two >> np.uint64(16)) % np.uint64(buckets))[by_place]
    for number, chosen in by_bucket(bucket, buckets):
        c = by_place[chosen]
        docs, index = np.unique(least_doc[c], return_inverse=True)
        packet = pack(
            place[c].astype(np.uint32), least_at[c].astype(np.uint32), one[c], (two[c] & LOW_16).astype(np.uint16),
            several[c], index.astype(np.uint32), w.doc_ids[docs],
        )
        yield number, block, packet


class Substrings:
    """The four steps over one set of blocks; columns ``id_col`` and ``text_col``."""

    def __init__(self, docs: DataFrame, k: int, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES):
        self.k = k
        self.windows = partial(Windows, id_col=id_col, text_col=text_col, k=k)
        # smaller blocks send to fewer buckets, so that packets do not get more
        bucket_bytes = BUCKET_BYTES * max(1, BLOCK_BYTES // block_bytes)
        self.buckets = int(min(1 << 24, max(16, text_bytes(docs, text_col) // bucket_bytes)))
        self.blocks = stage_blocks(docs, text_col, block_bytes)

    def shared_anchors(self) -> DataFrame:
        """(block, packets): each block's anchors that at least two documents have."""
        buckets, windows = self.buckets, self.windows

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    w = windows(payload.as_py())
                    anchors, doc = w.anchors()[w.valid], w.doc[w.valid]
                    order = np.argsort(anchors, kind="stable")
                    anchors, doc = anchors[order], doc[order]
                    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])) if len(anchors) else np.zeros(0, int)
                    last = np.concatenate([first[1:] - 1, [len(anchors) - 1]]) if len(first) else first
                    distinct, several = anchors[first], doc[first] != doc[last]
                    rows = []
                    for bucket, at in by_bucket((distinct >> np.uint64(40)) % np.uint64(buckets), buckets):
                        rows.append((bucket, block, pack(_five(distinct[at]), np.packbits(several[at]))))
                    yield _rows(PACKET, PACKET_TYPES, rows)

        def meet(group: pa.Table) -> pa.Table:
            parts = [unpack(p) for p in group.column("packet").to_pylist()]
            keys = [_from_five(part[0]) for part in parts]
            several = [np.unpackbits(part[1], count=len(key)).astype(bool) for part, key in zip(parts, keys, strict=True)]
            values, inverse, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            shared = counts > 1
            shared[inverse[np.concatenate(several)]] = True
            ends = np.cumsum([len(key) for key in keys])[:-1]
            mine = np.split(shared[inverse], ends)
            rows = []
            for bucket, block, key, one in zip(group.column("bucket").to_pylist(), group.column("block").to_pylist(), keys, mine, strict=True):
                if one.any():
                    rows.append((bucket, block, _five(key[one])))
            return pa.Table.from_batches([_rows(PACKET, PACKET_TYPES, rows)])

        sent = self.blocks.mapInArrow(send, PACKET_SCHEMA)
        back = sent.groupBy("bucket").applyInArrow(meet, PACKET_SCHEMA)
        return back.groupBy("block").agg(F.collect_list(F.struct("bucket", "packet")).alias("packets"))

    def sourced_edges(self, anchors: DataFrame) -> DataFrame:
        """(block, packets): for each block its repeated edges with their sources."""
        buckets, windows = self.buckets, self.windows

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, payload, packets in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                    w = windows(payload.as_py())
                    found = [np.uint64(p["bucket"]) << np.uint64(40) | _from_five(p["packet"]) for p in packets.as_py()]
                    shared = np.sort(np.concatenate(found))
                    own = w.anchors()
                    key = ((own >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40) | own & LOW_40
                    near = np.minimum(np.searchsorted(shared, key), len(shared) - 1)
                    at = np.flatnonzero(w.valid & (shared[near] == key))
                    one, two = w.edges()
                    yield _rows(PACKET, PACKET_TYPES, list(_entries(w, block, at, one[at], two[at], buckets)))

        def meet(group: pa.Table) -> pa.Table:
            numbers = group.column("block").to_pylist()
            parts = [unpack(p) for p in group.column("packet").to_pylist()]
            sizes = [len(part[0]) for part in parts]
            place, least, one, tag, several = (np.concatenate([part[c] for part in parts]) for c in range(5))
            doc = np.concatenate([part[6][part[5]] for part in parts])
            part_of = np.repeat(np.arange(len(parts)), sizes)
            block = np.array(numbers, np.int64)[part_of]
            order = np.lexsort((least, block, doc, tag, one))
            new = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (tag[order][1:] != tag[order][:-1])])
            head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
            source = np.empty(len(order), np.int64)
            source[order] = head
            answer = (doc[source] < doc) | several
            rows = []
            for number, ours in enumerate(np.split(np.arange(len(place)), np.cumsum(sizes)[:-1])):
                ours = ours[answer[ours]]
                if len(ours):
                    s = source[ours]
                    shift = least[s].astype(np.int64) - place[ours]
                    rows.append((0, numbers[number], pack(place[ours], doc[s], block[s], shift.astype(np.int32))))
            return pa.Table.from_batches([_rows(PACKET, PACKET_TYPES, rows)])

        sent = self.blocks.join(anchors, "block").mapInArrow(send, PACKET_SCHEMA)
        back = sent.groupBy("bucket").applyInArrow(meet, PACKET_SCHEMA)
        return back.groupBy("block").agg(F.collect_list("packet").alias("packets"))

    def paths(self, edges: DataFrame) -> DataFrame:
        """(block, start, windows, source_doc, source_block, source_start): runs of edges whose
        place and source both move on word by word."""
        names = ["block", "start", "windows", "source_doc", "source_block", "source_start"]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]

        def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, packets in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    place, doc, source, shift = (np.concatenate(c) for c in zip(*map(unpack, packets), strict=True))
                    order = np.argsort(place)
                    place, doc, source, shift = place[order].astype(np.int64), doc[order], source[order], shift[order]
                    stop = (np.diff(place) != 1) | (np.diff(doc) != 0) | (np.diff(source) != 0) | (np.diff(shift) != 0)
                    begin = np.concatenate([[0], np.flatnonzero(stop) + 1])
                    length = np.diff(np.concatenate([begin, [len(place)]]))
                    columns = [np.full(len(begin), block), place[begin], length, doc[begin], source[begin], place[begin] + shift[begin]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        schema = "block long, start int, windows int, source_doc long, source_block long, source_start int"
        return staged(edges.mapInArrow(compact, schema), "repeated-paths")

    def sources_digested(self, paths: DataFrame) -> DataFrame:
        """(source_block, source_start, windows, digest) of the words at the sources of paths.
        Paths with one source ask once, so a source that most blocks repeat is no hot row."""
        windows = self.windows
        wanted = paths.select("source_block", "source_start", "windows").distinct()
        asked = wanted.groupBy("source_block").agg(F.collect_list(F.struct("source_start", "windows")).alias("asked"))
        names = ["source_block", "source_start", "windows", "digest"]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = (batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist())
                for block, payload, asked in zip(*columns, strict=True):
                    w = windows(payload.as_py())
                    rows = [(block, a["source_start"], a["windows"], w.digest(a["source_start"], a["windows"])) for a in asked]
                    yield _rows(names, types, rows)

        joined = self.blocks.join(asked, self.blocks["block"] == asked["source_block"]).select("block", "payload", "asked")
        return joined.mapInArrow(run, "source_block long, source_start int, windows int, digest binary")

    def finished(self, paths: DataFrame, finish, schema) -> DataFrame:
        """``finish(windows, removed)`` for each block, where ``removed`` marks the words that
        a verified path covers in a document other than its source."""
        windows, k = self.windows, self.k
        digests = self.sources_digested(paths)
        own = paths.join(digests, ["source_block", "source_start", "windows"]).groupBy("block").agg(
            F.collect_list(F.struct("start", "windows", "source_doc", "digest")).alias("paths")
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for payload, found in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    w = windows(payload.as_py())
                    yield finish(w, _removed(w, found or [], k))

        return self.blocks.join(own, "block", "left").select("payload", "paths").mapInArrow(run, schema)


def _removed(w: Windows, paths: list[dict], k: int) -> np.ndarray:
    n = len(w.words.ids)
    marks = np.zeros(n + 1, np.int64)
    if paths:
        source = np.full(len(w.valid), np.iinfo(np.int64).max)
        for path in paths:
            if w.digest(path["start"], path["windows"]) != path["digest"]:
                raise ValueError("the words at a path's source are not the path's")
            source[path["start"] : path["start"] + path["windows"]] = path["source_doc"]
        # a path names the first place of each edge in its block; equal windows follow it
        one, two = w.edges()
        marked = np.unique(one[source < np.iinfo(np.int64).max])
        at = np.flatnonzero(w.valid & (marked[np.minimum(np.searchsorted(marked, one), len(marked) - 1)] == one))
        order = at[np.lexsort((at, two[at], one[at]))]
        new = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        hit = order[source[first] < w.doc_ids[w.doc[order]]]
        marks[hit] += 1
        np.add.at(marks, np.minimum(hit + k, n), -1)
    return np.cumsum(marks[:n]) > 0


def _steps(docs: DataFrame, k: int, id_col: str, text_col: str, finish, schema, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    steps = Substrings(docs, k, id_col, text_col, block_bytes)
    paths = steps.paths(steps.sourced_edges(steps.shared_anchors()))
    return steps.finished(paths, finish, schema)


def repeat_digests(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def finish(w: Windows, removed: np.ndarray) -> pa.RecordBatch:
        ids = w.rows.column(0).to_pylist()
        rows = []
        for doc, (begin, end) in enumerate(zip(w.words.starts[:-1], w.words.starts[1:], strict=True)):
            kept = w.words.ids[begin:end][~removed[begin:end]]
            text = b" ".join([w.words.dictionary[i] for i in kept])
            rows.append((ids[doc], int(end - begin), int(end - begin - len(kept)), hashlib.sha256(text).hexdigest()))
        return _rows(names, types, rows)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _steps(chosen, k, "doc_id", "text", finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(
    docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with the repeated words taken out of the texts. A text that loses words is its
    kept words joined by one space; all other texts, and all other columns, stay as they are.
    A task's memory grows with ``block_bytes`` of text; the rows are the same for any."""
    at = docs.columns.index(text_col)
    types = [f.dataType for f in docs.schema.fields]
    if not isinstance(types[at], T.StringType):
        raise ValueError(f"{text_col} must be a string column")

    def finish(w: Windows, removed: np.ndarray) -> pa.RecordBatch:
        texts = w.rows.column(at).to_pylist()
        lost = np.add.reduceat(np.append(removed, False), w.words.starts[:-1]) if len(texts) else []
        for doc in np.flatnonzero((np.asarray(lost) > 0) & (w.words.counts > 0)):
            begin, end = w.words.starts[doc], w.words.starts[doc + 1]
            kept = w.words.ids[begin:end][~removed[begin:end]]
            texts[doc] = b" ".join([w.words.dictionary[i] for i in kept]).decode()
        return w.rows.set_column(at, w.rows.schema.field(at), pa.array(texts, pa.string()))

    return _steps(docs, k, id_col, text_col, finish, docs.schema, block_bytes)
