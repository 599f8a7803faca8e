"""Exact Jaccard self-join of shingle sets by universe partition.

Shingles are hashed into segments, their number set by a size band. Two sets with Jaccard
similarity t differ in at most H = (1 - t) / (1 + t) * (|x| + |y|) shingles, so if a set is
cut into segments and for some of them a tolerance v (0: equal, 1: one shingle more or less)
is allowed, a similar set must meet a tolerance as soon as the sum of v + 1 exceeds H: else
every one of these segments would differ by more than its tolerance, more than H in all.

*Index.* A set enters the index of its own band with one key per segment that is not empty;
in bands of small sets also with every segment less one shingle, its one-deletion
neighbourhood. *Probe.* A set probes its own band and the smaller ones it can match. It
allocates tolerances to its segments at the lowest estimated cost: small segments are common
and cost candidates, tolerance 1 costs look-ups but counts twice, empty segments are never
used. Any allocation that exceeds H is exact, so the estimate decides speed only. A set whose
nonempty segments cannot reach H, about one in millions, is compared with all of its band.

*Candidates.* Keys meet in buckets. Up to ``STAR`` index entries under one key give all
pairs; more give a star around the smallest document, and what the star leaves undecided is
settled later inside its members. Equal sets (by a 128-bit digest) are one class before
anything is verified. Sizes and odd sketches, whose distance never exceeds that of the sets,
drop most of the rest; every pair left is verified on the words of the two texts.

*Stars.* After the links of all pairs so far are joined into components, the members that
are not in their star's component are compared with all of its members, in blocks of bounded
size, exactly; a block returns a spanning forest of its links, which has the same components.
So a group of thousands of near copies never becomes all its pairs.

Defined results: a document with no word has the empty set and links with nothing; one with
fewer words than a shingle has its whole sequence as its one shingle; documents that share an
id are one node; rows with a null id are returned with their own size and a null component;
an empty table gives no rows; other columns are not read.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.blocks import Words, by_bucket, mix, pack, runs_hash, sub_batches, text_bytes, unpack
from mixloom.llm.components import components
from mixloom.operators.skew import join_small
from mixloom.storage import staged

BUCKET_BYTES = 4 << 20
BAND_RATIO = 0.85
ONE_DELETION_UP_TO = 24  # largest size of a band with one-deletion keys in its index
STAR = 32
MEMBERS = 1000  # of a star in one block
MISS = 16.0  # how much rarer one more shingle makes a segment, for the cost estimate
COMMON = 1000.0  # candidates expected from an empty segment, for the cost estimate
LOW_40 = np.uint64((1 << 40) - 1)


class Similarity:
    """100 * |x ∩ y| >= percent * |x ∪ y|, and what follows from it for sizes and bands."""

    def __init__(self, percent: int):
        self.percent = percent

    def most_different(self, total: int) -> int:
        """The largest symmetric difference of two similar sets of ``total`` elements in all."""
        return (100 - self.percent) * total // (100 + self.percent)

    def largest_partner(self, size: int) -> int:
        return size * 100 // self.percent

    def smallest_partner(self, size: int) -> int:
        return -(-size * self.percent // 100)

    def holds(self, common: int, total: int) -> bool:
        return 100 * common >= self.percent * (total - common)


@lru_cache(maxsize=4096)
def band_of(size: int) -> tuple[int, int]:
    """The band (smallest and largest size) that a size belongs to."""
    low = 1
    while True:
        high = max(low, int(low / BAND_RATIO))
        if size <= high:
            return low, high
        low = high + 1


@lru_cache(maxsize=4096)
def segments_of(low: int, high: int, percent: int) -> int:
    """How many segments the band's universe has: enough for H + 1 of them, and for those
    that a set of the band leaves empty, five standard deviations above their mean."""
    needed = Similarity(percent).most_different(high + Similarity(percent).largest_partner(high)) + 1
    if needed == 1:
        return 1
    count = needed + 1
    while count < 4 * needed and high > ONE_DELETION_UP_TO:
        empty = count * np.exp(-low / count)
        if count - needed >= empty + 5 * np.sqrt(empty):
            break
        count += 1
    return count


@lru_cache(maxsize=100_000)
def allocation(sizes: tuple[int, ...], units: int, one_deletion: bool) -> tuple[int, ...] | None:
    """A tolerance per segment (-1: not used) with sum(v + 1) >= units at the least cost, or
    None where the nonempty segments do not reach it. ``sizes`` are in falling order."""
    usable = [k for k, size in enumerate(sizes) if size]
    if not one_deletion:
        return tuple(0 if k < units else -1 for k in range(len(sizes))) if len(usable) >= units else None
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for size in sizes:
        options = [(-1, 0, 0.0)]
        if size:
            options.append((0, 1, 1 + COMMON / MISS**size))
        if size > 1:  # one deletion from a single shingle leaves an empty segment, which has no keys
            options.append((1, 2, size + 2 + (size + 1) * COMMON / MISS ** (size - 1)))
        after: dict[int, tuple[float, tuple[int, ...]]] = {}
        for reached, (cost, chosen) in best.items():
            for tolerance, gain, price in options:
                at, total = min(units, reached + gain), cost + price
                if at not in after or total < after[at][0]:
                    after[at] = (total, (*chosen, tolerance))
        best = after
    return best[units][1] if units in best else None


class Signatures:
    """Index and probe keys of sets of 64-bit shingle hashes."""

    def __init__(self, percent: int):
        self.similar = Similarity(percent)

    def _segments(self, shingles: np.ndarray, low: int, high: int):
        count = segments_of(low, high, self.similar.percent)
        spread = mix(shingles)
        segment = (spread % np.uint64(count)).astype(np.int64)
        value = mix(spread + np.uint64(low))
        sizes = np.bincount(segment, minlength=count)
        sums = np.zeros(count, np.uint64)
        np.add.at(sums, segment, value)
        return segment, value, sizes, sums

    @staticmethod
    def _keys(sums: np.ndarray, segment: np.ndarray, low: int, kind: int) -> np.ndarray:
        return mix(sums + mix(segment.astype(np.uint64) * np.uint64(4) + np.uint64(kind) + (np.uint64(low) << np.uint64(32))))

    def index(self, shingles: np.ndarray) -> np.ndarray:
        low, high = band_of(len(shingles))
        segment, value, sizes, sums = self._segments(shingles, low, high)
        used = np.flatnonzero(sizes)
        keys = [self._keys(sums[used], used, low, 0)]
        if high <= ONE_DELETION_UP_TO:
            keys.append(self._keys(sums[segment] - value, segment, low, 1))
        return np.unique(np.concatenate(keys))

    def probe(self, shingles: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The keys to look up, and the bands (their smallest sizes) that no keys can cover."""
        size = len(shingles)
        low, high = band_of(self.similar.smallest_partner(size))
        keys, uncovered = [], []
        while low <= size:
            segment, value, sizes, sums = self._segments(shingles, low, high)
            units = self.similar.most_different(size + min(high, size)) + 1
            order = np.argsort(-sizes, kind="stable")
            one_deletion = high <= ONE_DELETION_UP_TO
            if one_deletion:
                chosen = allocation(tuple(sizes[order].tolist()), units, True)
                tolerance = np.full(len(sizes), -1) if chosen is None else np.array(chosen)
            else:
                chosen = units <= np.count_nonzero(sizes) or None
                tolerance = np.where(np.arange(len(sizes)) < units, 0, -1)
            if chosen is None:
                uncovered.append(low)
            else:
                equal = order[tolerance == 0]
                keys.append(self._keys(sums[equal], equal, low, 0))
                near = order[tolerance == 1]
                if len(near):
                    keys += [self._keys(sums[near], near, low, 0), self._keys(sums[near], near, low, 1)]
                    inside = np.isin(segment, near)
                    less = sums[segment[inside]] - value[inside]
                    keys.append(self._keys(less, segment[inside], low, 0))
            low, high = band_of(high + 1)
        return (np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)), uncovered


def sketch_bits(size: int) -> int:
    return max(64, 1 << max(0, int(size - 1).bit_length()))


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bits that flip with every element hashed to them; as many bits as elements or more."""
    bits = sketch_bits(len(shingles))
    spread = (mix(shingles ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(spread, minlength=bits).astype(np.uint8) & 1)


def sketch_distance(x: bytes, y: bytes) -> int:
    """At most the sets' symmetric difference. The longer sketch is folded to the shorter."""
    one, two = (np.frombuffer(s, np.uint8) for s in (x, y))
    if len(one) < len(two):
        one, two = two, one
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, in order."""
    w = Words(texts, lower=True)
    lane = w.hashes()[0][w.ids] if len(w.ids) else np.zeros(0, np.uint64)
    grams = runs_hash(lane, words)
    out = []
    for begin, end in zip(w.starts[:-1], w.starts[1:], strict=True):
        if end - begin >= words:
            out.append(np.unique(grams[begin : end - words + 1]))
        elif end > begin:
            out.append(runs_hash(lane[begin:end], int(end - begin)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


INFO = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("band", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())]
)
PACKET = pa.schema([("bucket", pa.int32()), ("packet", pa.binary())])
PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("star", pa.bool_())])


def set_info(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, band, digest, sketch) of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 1):
            sets = shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), words)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            sketches = [odd_sketch(s).tobytes() for s in sets]
            bands = [band_of(len(s))[0] if len(s) else 0 for s in sets]
            yield _batch(INFO, [batch.column(0).to_pylist(), [len(s) for s in sets], bands, digests, sketches])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, band long, digest binary, sketch binary")


def candidate_pairs(docs: DataFrame, words: int, percent: int, buckets: int, keys: type = Signatures) -> DataFrame:
    """(a, b, star): pairs that share a key; ``star`` marks those around the smallest document
    of a key with many, which is their ``a``. A null ``star`` says that ``a`` is to be compared
    with the whole band ``b``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = keys(percent)
        for batch in sub_batches(batches, 1):
            ids = batch.column(0).to_pylist()
            seen: set[bytes] = set()
            entries: list[tuple[list, list]] = [([], []), ([], [])]
            uncovered: list[tuple[int, int]] = []
            for doc, shingles in zip(ids, shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), words), strict=True):
                if doc is None or not len(shingles) or (same := shingles.tobytes()) in seen:
                    continue
                seen.add(same)
                asked, bands = signatures.probe(shingles)
                uncovered += [(doc, band) for band in bands]
                for side, own in enumerate((signatures.index(shingles), asked)):
                    entries[side][0].append(own)
                    entries[side][1].append(np.full(len(own), doc, np.int64))
            packets: dict[int, list] = {}
            for side, (parts, owners) in enumerate(entries):
                if not parts:
                    continue
                key, owner = np.concatenate(parts), np.concatenate(owners)
                for bucket, at in by_bucket((key >> np.uint64(40)) % np.uint64(buckets), buckets):
                    docs_here, counts = _run_lengths(owner[at])
                    low = (key[at] & LOW_40).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                    narrow = counts.astype(np.uint16 if counts.max() < 65536 else np.int64)
                    packets.setdefault(bucket, [None] * 6)[3 * side : 3 * side + 3] = low, docs_here, narrow
            rows = [(bucket, pack(*packet, None)) for bucket, packet in packets.items()]
            if uncovered:
                rows.append((0, pack(*[None] * 6, np.array(uncovered, np.int64).reshape(-1))))
            yield _batch(PACKET, [[r[0] for r in rows], [r[1] for r in rows]])

    def meet(group: pa.Table) -> pa.Table:
        sides: list[tuple[list, list]] = [([], []), ([], [])]
        uncovered = [np.zeros(0, np.int64)]
        for packet in group.column("packet").to_pylist():
            *parts, bands = unpack(packet)
            if bands is not None:
                uncovered.append(bands)
            for found, owners in sides:
                low, docs_here, counts = parts[:3]
                parts = parts[3:]
                if low is not None:
                    wide = np.zeros((len(low) // 5, 8), np.uint8)
                    wide[:, :5] = np.frombuffer(low, np.uint8).reshape(-1, 5)
                    found.append(wide.view("<i8").reshape(-1))
                    owners.append(np.repeat(docs_here, counts))
        none = np.zeros(0, np.int64)
        (index, held), (probe, asking) = ([np.concatenate([none, *part]) for part in side] for side in sides)
        pairs = _batch(PAIR, list(_meet(index, held, probe, asking)))
        sets, bands = np.concatenate(uncovered).reshape(-1, 2).T
        return pa.Table.from_batches([pairs, _batch(PAIR, [sets, bands, [None] * len(sets)])])

    sent = docs.mapInArrow(send, "bucket int, packet binary")
    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long, star boolean")


def _run_lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[begin], np.diff(np.concatenate([begin, [len(values)]]))


def _meet(index: np.ndarray, held: np.ndarray, probe: np.ndarray, asking: np.ndarray):
    """Distinct (a, b, star) of probes and index entries with equal keys."""
    order = np.argsort(index, kind="stable")
    index, held = index[order], held[order]
    low, high = np.searchsorted(index, probe, "left"), np.searchsorted(index, probe, "right")
    count = high - low
    few = (count > 0) & (count <= STAR)
    n = count[few]
    at = np.repeat(low[few] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    a, b = np.repeat(asking[few], n), held[at]
    star = np.zeros(len(a), bool)
    many = count > STAR
    if many.any():
        keys, where = np.unique(probe[many], return_inverse=True)
        begin, end = np.searchsorted(index, keys, "left"), np.searchsorted(index, keys, "right")
        n = end - begin
        members = held[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        group = np.concatenate([np.repeat(np.arange(len(keys)), n), where])
        members = np.concatenate([members, asking[many]])
        centre = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(centre, group, members)
        a, b = np.concatenate([a, centre[group]]), np.concatenate([b, members])
        star = np.concatenate([star, np.ones(len(group), bool)])
    a, b = np.minimum(a, b), np.maximum(a, b)
    real = a != b
    a, b, star = a[real], b[real], star[real]
    order = np.lexsort((star, b, a))
    a, b, star = a[order], b[order], star[order]
    last = np.concatenate([(a[1:] != a[:-1]) | (b[1:] != b[:-1]), [True]]) if len(a) else np.zeros(0, bool)
    return a[last], b[last], star[last]


def exact_shingles(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """The distinct shingles of each text as numbers that are equal exactly where the words
    are, among these texts. A text with fewer words has a number of its own, as only an equal
    text could share it, and equal texts are one class already."""
    w = Words(texts, lower=True)
    gram = w.ids.astype(np.int64)
    for k in range(1, words):
        n = len(w.ids) - k
        if n <= 0:
            break
        _, gram = np.unique(gram[:n] * len(w.dictionary) + w.ids[k:], return_inverse=True)
    out = []
    for text, (begin, end) in enumerate(zip(w.starts[:-1], w.starts[1:], strict=True)):
        out.append(np.unique(gram[begin : end - words + 1]) if end - begin >= words else np.array([-1 - text], np.int64))
    return out


def similar_pairs(pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) of the rows (a, b, text_a, text_b) whose texts are similar, by their words."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similar = Similarity(percent)
        for batch in batches:
            for part in sub_batches(iter([batch]), 2):
                left, right = (part.column(c).cast(pa.binary()).to_pylist() for c in (2, 3))
                sets = exact_shingles([*left, *right], words)
                rows = []
                for k, (a, b) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                    x, y = sets[k], sets[len(left) + k]
                    if similar.holds(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)):
                        rows.append((a, b))
                yield _batch(schema, [[r[0] for r in rows], [r[1] for r in rows]])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def star_links(blocks: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links between the undecided and all members of each
    block of rows (star, i, j, undecided, doc_id, label, text); equal labels are linked already."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(group: pa.Table) -> pa.Table:
        similar = Similarity(percent)
        undecided = np.array(group.column("undecided").to_pylist(), bool)
        docs = group.column("doc_id").to_pylist()
        sets = exact_shingles(group.column("text").cast(pa.binary()).to_pylist(), words)
        parent = {label: label for label in group.column("label").to_pylist()}
        labels = group.column("label").to_pylist()

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        others = np.flatnonzero(~undecided)
        sizes = np.array([len(sets[k]) for k in others])
        owner = np.repeat(np.arange(len(others)), sizes)
        shingle = np.concatenate([sets[k] for k in others]) if len(others) else np.zeros(0, np.int64)
        order = np.argsort(shingle, kind="stable")
        shingle, owner = shingle[order], owner[order]
        rows = []
        for x in np.flatnonzero(undecided):
            low, high = np.searchsorted(shingle, sets[x], "left"), np.searchsorted(shingle, sets[x], "right")
            n = high - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common = np.bincount(owner[at], minlength=len(others))
            for y in np.flatnonzero(similar.holds(common, sizes + len(sets[x]))):
                one, two = root(labels[x]), root(labels[others[y]])
                if one != two:
                    parent[one] = two
                    rows.append((docs[x], docs[others[y]]))
        return pa.Table.from_batches([_batch(schema, [[r[0] for r in rows], [r[1] for r in rows]])])

    return blocks.groupBy("star", "i", "j").applyInArrow(compare, "a long, b long")


def _close_enough(pairs: DataFrame, percent: int) -> DataFrame:
    """The rows (a, b, n_a, n_b, sketch_a, sketch_b) that sizes and sketches do not exclude."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similar = Similarity(percent)
        for batch in batches:
            rows = [
                (a, b)
                for a, b, n, m, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                if sketch_distance(x, y) <= similar.most_different(n + m)
            ]
            yield _batch(schema, [[r[0] for r in rows], [r[1] for r in rows]])

    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return pairs.filter(fits).select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return staged(join_small(docs, ids, ["doc_id"], "inner"), "candidate-texts")


def _ordered(pairs: DataFrame) -> DataFrame:
    """(a, b) with the smaller class first, each pair once."""
    return pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


def ngram_components(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", keys: type = Signatures
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``. Two documents link when
    their shingle sets have a Jaccard similarity of ``percent`` / 100 or more; a component's id
    is its smallest document. ``keys`` makes the index and probe keys of a set."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = int(min(1 << 24, max(16, text_bytes(docs) // BUCKET_BYTES)))

    # classes of equal sets, named after their smallest document
    info = staged(set_info(docs, words), "set-info")
    named = info.filter("doc_id is not null and n_shingles > 0")
    firsts = [F.first(column).alias(name) for column, name in (("n_shingles", "n"), ("band", "band"), ("sketch", "sketch"))]
    classes = staged(named.groupBy("digest").agg(F.min("doc_id").alias("rep"), *firsts), "set-classes")
    members = named.join(classes.select("digest", "rep"), "digest").select("doc_id", "rep")
    members = staged(members, "set-members")

    # candidate pairs of classes, of documents that share a key
    found = staged(candidate_pairs(docs, words, percent, buckets, keys), "set-pairs")
    class_a = members.select(F.col("doc_id").alias("a"), F.col("rep").alias("rep_a"))
    class_b = members.select(F.col("doc_id").alias("b"), F.col("rep").alias("rep_b"))
    paired = found.filter("star is not null").distinct().join(class_a, "a").join(class_b, "b").filter("rep_a <> rep_b")
    stars = paired.filter("star").select(F.col("rep_a").alias("star"), F.col("rep_b").alias("doc_id")).distinct()
    stars = staged(stars, "set-stars")
    asked = found.filter("star is null").select("a", F.col("b").alias("band")).distinct().join(class_a, "a")
    whole_bands = asked.join(classes.select("band", F.col("rep").alias("rep_b")), "band").filter("rep_a <> rep_b")
    pairs = _ordered(paired.select("rep_a", "rep_b").unionByName(whole_bands.select("rep_a", "rep_b")))

    # those that sizes and sketches allow, verified on their texts
    side_a, side_b = (
        classes.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        for side in ("a", "b")
    )
    close = staged(_close_enough(pairs.join(side_a, "a").join(side_b, "b"), percent), "set-close")
    texts = _texts(docs, close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    text_a, text_b = (
        texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")) for side in ("a", "b")
    )
    similar = similar_pairs(close.join(text_a, "a").join(text_b, "b"), words, percent)
    links = staged(similar.unionByName(_shared_ids(members)), "set-links")

    labels = components(links)
    more = _undecided_links(docs, stars, labels, words, percent)
    if more is not None:
        labels = components(links.unionByName(more))
    rows = info.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
    rows = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("label", "rep"))
    return rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def _shared_ids(members: DataFrame) -> DataFrame:
    """(a, b): links between the classes that one id has rows in."""
    several = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).filter("a < most")
    return members.join(several, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))


def _undecided_links(
    docs: DataFrame, stars: DataFrame, labels: DataFrame, words: int, percent: int
) -> DataFrame | None:
    """Links inside stars between members that the links so far leave apart; None for none."""
    label, star_label = F.coalesce("label", "doc_id"), F.coalesce("star_label", "star")
    of_member = labels.withColumnRenamed("node", "doc_id")
    of_star = labels.select(F.col("node").alias("star"), F.col("label").alias("star_label"))
    judged = stars.join(of_member, "doc_id", "left").join(of_star, "star", "left")
    judged = judged.select("star", "doc_id", label.alias("label"), (label != star_label).alias("undecided"))
    judged = staged(judged, "judged-stars")
    counts = judged.groupBy("star").agg(F.count(F.lit(1)).alias("n"), F.count_if("undecided").alias("u"))
    blocks = [F.ceil(F.col(name) / MEMBERS).alias(name) for name in ("n", "u")]
    sizes = staged(counts.filter("u > 0").select("star", *blocks), "star-sizes")
    if not sizes.limit(1).count():
        return None
    rows = judged.join(sizes, "star")
    place, every = F.xxhash64("doc_id"), lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    asking = rows.filter("undecided").withColumns({"i": F.pmod(place, F.col("u")), "j": every("n")})
    asked = rows.withColumns({"i": every("u"), "j": F.pmod(place, F.col("n")), "undecided": F.lit(False)})
    columns = ["star", "i", "j", "undecided", "doc_id", "label"]
    texts = _texts(docs, rows.select("doc_id").distinct())
    blocks = asking.select(columns).unionByName(asked.select(columns)).join(texts, "doc_id")
    return staged(star_links(blocks, words, percent), "star-links")


def near_duplicates_dropped(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and others) without those of documents that link, over
    any number of links, with a document of a smaller id. Rows with a null id stay."""
    found = ngram_components(docs, words, percent)
    later = staged(found.filter("component_id < doc_id").select("doc_id").distinct(), "later-copies")
    return join_small(docs, later, ["doc_id"], "left_anti")
