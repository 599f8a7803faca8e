"""Near duplicates by an LSH forest over minhash signatures.

*Forest.* Each set of shingles has ``TREES`` signatures of ``DEPTH`` minhash values. A tree is
the sorted order of one of them: sets that agree on the first d values, which two sets of
similarity s do with chance s ** d, are neighbours there, and how far they agree is their
longest common prefix (LCP). Rows of all trees are sorted by range partitions and numbered, and
cut into blocks of equally many rows that also see the ``REGION`` rows before and after them;
so no prefix, however frequent, makes a block larger than others.

*Depth.* Regions are prefixes. A region goes from ``LEAST`` values to as many as it takes until
at most ``REGION`` sets are left in it: sparse regions stay shallow and miss next to nothing,
dense ones get deeper.

*Candidates.* First the nearest in each tree, the LCP neighbours, are verified and joined into
components. Then all pairs of each region that are in different components still. Where more
than ``REGION`` sets share a whole signature, those of a block that are not in the component of
the block's first are compared with all of that signature there, by an inverted index and
without making their pairs. A group of thousands of near copies thus costs each of its members
its neighbours, not all pairs.

*Links.* Equal sets (by a 128-bit digest) are one class before anything is sorted. Sizes and odd
sketches, whose distance never exceeds that of the sets, drop candidates that cannot be similar;
every link is confirmed on the full sets, made from the words of both texts.

No false link is possible. A link is missed only if it has no tree with a common region: with
chance (1 - s ** LEAST) ** TREES in sparse regions, 3e-7 at a similarity of 0.85; a pair missed
is still in one component where other links lead from one to the other.

Defined results: a document with no word has the empty set and links with nothing; one with
fewer words than a shingle has its whole sequence as its one shingle; documents that share an
id are one node; rows with a null id are returned with their own size and a null component;
an empty table gives no rows; other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.blocks import sub_batches
from mixloom.llm.components import components
from mixloom.llm.ngram_join import _close_enough, _shared_ids, _texts, _undecided_links, odd_sketch, shingle_sets, similar_pairs
from mixloom.operators.skew import dense_numbers
from mixloom.storage import staged

TREES = 16
DEPTH = 12  # values of a signature
LEAST = 3  # values that all candidates of a tree share
REGION = 32  # sets up to which a region gives all its pairs
BLOCK = 8192  # sorted rows of a block, besides those it sees of its neighbours
VALUE_BYTES = 2
SIGNATURE = DEPTH * VALUE_BYTES

INFO = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary()), ("signatures", pa.binary())]
)


def _constants(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 32, n, np.uint32), rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1)


def signatures(sets: list[np.ndarray], seed: int) -> np.ndarray:
    """(sets, TREES, DEPTH) minhash values, 16 bits of each; ``sets`` are not empty and hold
    evenly spread 64-bit hashes."""
    sizes = np.array([len(s) for s in sets])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((TREES * DEPTH, len(sets)), np.uint16)
    for k, (shift, factor) in enumerate(zip(*_constants(seed, TREES * DEPTH), strict=True)):
        least = np.minimum.reduceat((flat ^ shift) * factor, begin)
        # the smallest of n values has its information in their lower bits: mix, then keep some
        out[k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out.T.reshape(len(sets), TREES, DEPTH)


def forest_info(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch, signatures) of every row of ``docs`` (doc_id, text);
    an empty set has null signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 1):
            sets = shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), words)
            signed: list[bytes | None] = [None] * len(sets)
            full = [k for k, s in enumerate(sets) if len(s)]
            if full:
                for k, values in zip(full, signatures([sets[k] for k in full], seed), strict=True):
                    signed[k] = values.astype(">u2").tobytes()
            columns = [
                batch.column(0), [len(s) for s in sets], [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                [odd_sketch(s).tobytes() for s in sets], signed,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, INFO.types, strict=True)], schema=INFO)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sketch binary, signatures binary")


def sorted_trees(classes: DataFrame) -> DataFrame:
    """(at, tree, signature, rep): the rows of all trees in order, numbered from 0. ``classes``
    has (rep, signatures)."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = classes.select("rep", "signatures", tree)
    signature = F.expr(f"substring(signatures, tree * {SIGNATURE} + 1, {SIGNATURE})").alias("signature")
    return dense_numbers(rows.select(F.col("tree").cast("int"), signature, "rep"), ["tree", "signature", "rep"], "at")


def in_blocks(rows: DataFrame, block: int, region: int) -> DataFrame:
    """``rows`` with the ``block`` each is in or seen from: its own, and that before or after
    where it is within ``region`` rows of it. ``own`` tells them apart."""
    number, place = F.floor(F.col("at") / block), F.col("at") % block
    before = F.when((place < region) & (number > 0), number - 1)
    after = F.when(place >= block - region, number + 1)
    seen = rows.withColumn("block", F.explode(F.array_compact(F.array(number, before, after))))
    return seen.withColumn("own", F.col("block") == number)


def common_prefixes(tree: np.ndarray, values: np.ndarray) -> np.ndarray:
    """By row, how many leading values it shares with the row before; -1 across trees."""
    lcp = np.full(len(tree), -1, np.int64)
    if len(tree) > 1:
        same = np.cumprod(values[1:] == values[:-1], axis=1).sum(axis=1)
        lcp[1:] = np.where(tree[1:] == tree[:-1], same, -1)
    return lcp


def regions(lcp: np.ndarray, region: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, wide) of each row's region: the shallowest prefix of at least ``LEAST``
    values that at most ``region`` of the rows share. Where even whole signatures are shared
    by more, ``wide`` is true and the region is that of the signature."""
    n = len(lcp)
    begin, end, open_ = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for depth in range(LEAST, DEPTH + 1):
        starts = np.flatnonzero(lcp < depth)
        group = np.cumsum(lcp < depth) - 1
        low, high = starts[group], np.append(starts[1:], n)[group]
        taken = open_ & ((high - low <= region) | (depth == DEPTH))
        begin[taken], end[taken] = low[taken], high[taken]
        open_ &= ~taken
    return begin, end, end - begin > region


def region_pairs(begin: np.ndarray, end: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): for each i of ``rows`` the later rows j of its region."""
    n = end[rows] - rows - 1
    first = np.repeat(rows, n)
    return first, first + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _sorted_group(group: pa.Table):
    group = group.sort_by("at")
    tree, rep, own = (group.column(name).to_numpy() for name in ("tree", "rep", "own"))
    raw = b"".join(group.column("signature").to_pylist())
    return group, rep, common_prefixes(tree, np.frombuffer(raw, ">u2").reshape(len(rep), DEPTH)), own


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
WIDER = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("star", pa.bool_())])


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def nearest_pairs(blocks: DataFrame) -> DataFrame:
    """(a, b): LCP neighbours, each row with the one before it."""

    def meet(group: pa.Table) -> pa.Table:
        _, rep, lcp, own = _sorted_group(group)
        near = np.flatnonzero(own & (lcp >= LEAST))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in _distinct(rep[near - 1], rep[near])], schema=PAIRS)

    return blocks.groupBy("block").applyInArrow(meet, "a long, b long")


def apart_pairs(blocks: DataFrame, region: int) -> DataFrame:
    """(a, b, star): pairs of one region with different labels. Where a region is wider than
    ``region``, each of its rows in the block with the first, as a star."""

    def meet(group: pa.Table) -> pa.Table:
        group, rep, lcp, own = _sorted_group(group)
        label = group.column("label").to_numpy()
        begin, end, wide = regions(lcp, region)
        one, two = region_pairs(begin, end, np.flatnonzero(own & ~wide))
        apart = label[one] != label[two]
        pairs = _distinct(rep[one[apart]], rep[two[apart]])
        star = np.flatnonzero(wide)
        split = np.zeros(len(rep), bool)  # regions that are not of one component
        split[begin[star[label[star] != label[begin[star]]]]] = True
        star = star[split[begin[star]]]
        columns = [np.concatenate([pairs[0], rep[begin[star]]]), np.concatenate([pairs[1], rep[star]])]
        marks = np.repeat([False, True], [len(pairs[0]), len(star)])
        return pa.Table.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(marks)], schema=WIDER)

    return blocks.groupBy("block").applyInArrow(meet, "a long, b long, star boolean")


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """Staged (a, b): those of ``pairs`` that are similar by their full sets."""
    side_a, side_b = (
        classes.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        for side in ("a", "b")
    )
    close = staged(_close_enough(pairs.distinct().join(side_a, "a").join(side_b, "b"), percent), f"{name}-close")
    texts = _texts(docs, close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    text_a, text_b = (texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")) for side in ("a", "b"))
    return staged(similar_pairs(close.join(text_a, "a").join(text_b, "b"), words, percent), f"{name}-links")


def forest_components(
    docs: DataFrame, words: int = 3, percent: int = 85, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
    region: int = REGION, block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``. Two documents link when
    their shingle sets have a Jaccard similarity of ``percent`` / 100 or more; a component's id
    is its smallest document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    info = staged(forest_info(docs, words, seed), "forest-info")
    named = info.filter("doc_id is not null and n_shingles > 0")
    firsts = [F.first(column).alias(name) for column, name in (("n_shingles", "n"), ("sketch", "sketch"), ("signatures", "signatures"))]
    classes = staged(named.groupBy("digest").agg(F.min("doc_id").alias("rep"), *firsts), "forest-classes")
    members = staged(named.join(classes.select("digest", "rep"), "digest").select("doc_id", "rep"), "forest-members")

    trees = sorted_trees(classes.select("rep", "signatures"))
    near = nearest_pairs(in_blocks(trees, block, region)).filter("a <> b")
    links = _confirmed(docs, classes, near, words, percent, "near").unionByName(_shared_ids(members))
    links = staged(links, "forest-links")
    labels = components(links)

    of_rep = labels.select(F.col("node").alias("rep"), "label")
    labelled = trees.join(of_rep, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    apart = staged(apart_pairs(in_blocks(labelled, block, region), region), "forest-apart").filter("a <> b")
    further = _confirmed(docs, classes, apart.select("a", "b"), words, percent, "apart")
    if further.limit(1).count():
        links = links.unionByName(further)
        labels = components(links)
    stars = staged(apart.filter("star").select(F.col("a").alias("star"), F.col("b").alias("doc_id")).distinct(), "forest-stars")
    more = _undecided_links(docs, stars, labels, words, percent) if stars.limit(1).count() else None
    if more is not None:
        labels = components(links.unionByName(more))

    rows = info.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
    rows = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("label", "rep"))
    return rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
