"""Exact top-k by integer inner product over an impact-ordered index, a score at a time.

The components of a vector, scaled and floored, are the postings of its dimensions. A block
of vectors keeps each dimension's postings in order of value, cut into segments by quantised
value. For a query, a segment's impact is the most that one of its postings can add to a
score. Segments of all dimensions are processed in falling impact: their postings add what
they are worth to accumulators, which also count a vector's processed dimensions.

After each round the unprocessed rest of a vector is bounded: each dimension that has been
opened can add at most the round's impact, each other one at most its highest. The exact
scores of the most promising vectors give the score to beat. Once few vectors can still reach
it, the others are proven out, and those few are scored exactly; until then the rounds go on
down to the last segment. Nothing is skipped without that proof.

Queries are rows of the table itself. Vectors and queries are dealt into blocks, each pair of
a vector block and a query block is one task of bounded size, and the best of every pair meet
in a window per query.

Defined results: vectors that are null or hold a null or non-finite component take no part,
nor do rows with a null id; a query meets every vector of its own length but those of its own
id; ties go to the smaller id; a repeated row is ranked as often as it is there; a query
without candidates has no row; other columns are not read. Scores are whole numbers of 64 bits:
a table with a component so large that a sum of products might not fit is an error that names
the row.
"""


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
QUERY_ROWS = 8192
SEGMENT = 8  # values per segment
ROUNDS = (0.5, 0.65, 1.0)  # shares of the impacts' range, as points of proof
TRIED = 32  # vectors scored exactly at a point of proof, to learn the score to beat
ENOUGH = 8  # stop when one vector in so many is still possible
SHIFT = 40  # bits for a score, below those for the count of its dimensions


class ImpactIndex:
    """The postings of one block: by dimension in order of value, with segment borders."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)
        self.least, self.most = vectors.min(axis=0), vectors.max(axis=0)
        self.reach = int(np.abs(vectors).max(initial=0))

    def _cut(self, dim: int, weight: int, impact: int) -> int:
        """How many postings of a dimension, from its high-impact end, lie in segments whose
        impact is ``impact`` or more."""
        values = self.values[dim]
        if weight > 0:
            segment = -(-impact // weight) // SEGMENT * SEGMENT
            return len(values) - int(np.searchsorted(values, segment, "left"))
        segment = (-impact // -weight) // SEGMENT * SEGMENT + SEGMENT - 1
        return int(np.searchsorted(values, segment, "right"))

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` of the block, ties to smaller ids."""
        n, dims = self.vectors.shape
        high = np.maximum(query * self.least, query * self.most)
        used = np.flatnonzero(query)
        # one sum of floats may hold score and count, exactly: whole numbers that stay below 2 ** 53
        packed = dims < 1 << 12 and int(np.abs(query).max(initial=0)) * self.reach * dims < 1 << (SHIFT - 1)
        score, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        done = np.zeros(dims, np.int64)
        top, bottom = int(high.max(initial=0)), int(np.minimum(query * self.least, query * self.most).min(initial=0))
        possible = np.flatnonzero(self.ids != query_id)
        for share in ROUNDS:
            impact = top - int((top - bottom) * share)
            at, worth = [], []
            for dim in used:
                weight = int(query[dim])
                upto = self._cut(dim, weight, impact) if share < 1 else n
                if upto > done[dim]:
                    part = slice(n - upto, n - done[dim]) if weight > 0 else slice(done[dim], upto)
                    at.append(self.order[dim, part])
                    worth.append(self.values[dim, part] * weight)
                    done[dim] = upto
            if at and packed:
                total = np.bincount(np.concatenate(at), np.concatenate(worth) + (1 << SHIFT), n)
                found = np.rint(total / (1 << SHIFT))
                score += (total - found * (1 << SHIFT)).astype(np.int64)
                count += found.astype(np.int64)
            elif at:
                np.add.at(score, np.concatenate(at), np.concatenate(worth))
                count += np.bincount(np.concatenate(at), minlength=n)
            opened = done > 0
            # a dimension not opened adds its highest value at most; an opened one less than the round's impact
            bound = score + int(high[~opened].sum()) + (int(opened.sum()) - count) * max(impact, 0)
            if share == 1:
                bound = score
            bound = bound[possible]
            tried = possible[np.argpartition(-bound, TRIED)[:TRIED]] if len(possible) > TRIED else possible
            exact = np.sort(self.vectors[tried] @ query)[::-1]
            if len(exact) >= k:
                possible = possible[bound >= exact[k - 1]]
            if len(possible) <= max(TRIED, n // ENOUGH):
                break
        scores = self.vectors[possible] @ query
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible[best]], scores[best]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, x, size, reach) of the rows that take part; ``reach`` is the largest scaled component."""
    whole: Column = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), whole.alias("v")).filter("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floored = F.transform("v", lambda x: F.floor(x * scale).cast("long"))
    reach = F.aggregate("v", F.lit(0.0), lambda most, x: F.greatest(most, F.abs(x * scale)))
    return rows.filter(finite).select("id", floored.alias("x"), F.size("v").alias("size"), reach.alias("reach"))


def exact_top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the
    ``k`` rows with the highest inner product."""
    rows = integer_vectors(vectors, id_col, vector_col, scale)
    asks = F.col("id") % every == 0
    most = F.max(F.struct("reach", "id")).alias("most")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(asks).alias("queries"), F.max("size").alias("size"), most).first()
    if seen["n"] and (reach := seen["most"]["reach"] + 1.0) * reach * seen["size"] >= 2.0**62:
        raise ValueError(f"the products of row {seen['most']['id']} may not fit: its components reach {seen['most']['reach'] / scale:g}")
    blocks, chunks = max(1, -(-seen["n"] // BLOCK_ROWS)), max(1, -(-seen["queries"] // QUERY_ROWS))
    place = F.xxhash64("id")
    held = rows.withColumns({"block": F.pmod(place, F.lit(blocks)), "chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))), "asks": F.lit(False)})
    queries = rows.filter(asks)
    asking = queries.withColumns({"block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "chunk": F.pmod(place, F.lit(chunks)), "asks": F.lit(True)})
    columns = ["size", F.col("block").cast("int").alias("block"), F.col("chunk").cast("int").alias("chunk"), "asks", "id", "x"]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        ids = group.column("id").to_numpy()
        x = group.column("x").combine_chunks()
        flat = x.flatten().to_numpy().reshape(len(ids), -1)
        found = []
        if asks.any() and not asks.all():
            index = ImpactIndex(ids[~asks], flat[~asks])
            for row in np.flatnonzero(asks):
                near, scores = index.search(int(ids[row]), flat[row], k)
                found.append((np.full(len(near), ids[row]), near, scores))
        arrays = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pa.Table.from_arrays([pa.array(a, pa.int64()) for a in arrays], schema=schema)

    pairs = held.select(*columns).unionByName(asking.select(*columns))
    best = pairs.groupBy("size", "block", "chunk").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
