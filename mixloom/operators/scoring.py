"""The best tracks of many playlists by inner product of factors, exact and bounded.

Playlists are dealt into blocks. All tracks stream through the task of a block in order of
falling norm, and each playlist keeps its best k so far. An inner product is at most the
product of the norms (Cauchy-Schwarz), so a playlist is done once its norm times that of the
next tracks stays below its k-th score; tracks after that are not scored for it, and its list
is exact. A playlist's own tracks are out before the cut, so nothing is fetched too deep.

The tracks are shuffled once and read by the task of each block, so what is written grows with
the playlists and the tracks, and not with their product.

What Python holds in a task is one block of playlists with k tracks each, their own tracks and one
stretch of tracks, whatever the number of tracks; Spark holds the sorted tracks of a lane, or
spills them. A block's list is whole, so one row a playlist leaves its task, as a list, and
nothing is shuffled after it. Only where there are too few playlists to employ the cluster, or
very many tracks, are the tracks dealt into lanes, each in order of norm; then the lists of all
lanes meet, a row per playlist and lane.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLAYLIST_BLOCK = 65_536  # playlists of a block at most; all tracks are read for each block
LANE_LEAST = 16_384  # tracks of a lane at least
LISTED = 2_048  # playlists whose lists are put out together
SMALL_BLOCK = 2_048  # blocks of fewer playlists would read the tracks too often
LANE_TRACKS = 1 << 22  # tracks that stream through one task
STRETCH = 2_048  # tracks scored at a time
FIRST = 4_096  # tracks scored at first, of which a list's first k-th score is known
TOGETHER = 32  # tracks of a row
AT_ONCE = 4_000_000  # scores in memory at a time
TOLD_AT_ONCE = 1 << 20  # 32-bit products at a time, which a processor's cache holds
PAIRS_AT_ONCE = 2_048  # pairs whose factors are put side by side
TOLD = 1e30  # products of norms that 32 bits hold with room to spare
WAITING = 4  # a list's length is so many times the room of those that wait
SLACK = 1 + 1e-5  # scores are rounded; the bound allows for it

PLAYLIST, OWN, TRACK = 0, 1, 2
NONE = np.iinfo(np.int64).min  # in the place of a track that is not there


def _keys(scores: np.ndarray, tracks: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the scores, ties to the smaller track first."""
    bits = scores.view(np.int32).astype(np.int64)
    keys = (np.where(bits >= 0, bits, bits ^ 0x7FFFFFFF) << 32) - tracks
    keys[~np.isfinite(scores)] = NONE
    return keys


def _of_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, tracks) again."""
    ordered = -((-keys) >> 32)
    bits = np.where(ordered >= 0, ordered, ordered ^ 0x7FFFFFFF).astype(np.int32)
    return bits.view(np.float32), (ordered << 32) - keys


def _marked(marks: np.ndarray) -> np.ndarray:
    """Where ``marks`` are true, of which few are; eight are looked at together."""
    flat = marks.reshape(-1)
    whole = len(flat) // 8 * 8
    some = np.flatnonzero(flat[:whole].view(np.uint64))
    eight, place = np.nonzero(flat[:whole].reshape(-1, 8)[some])
    return np.concatenate([some[eight] * 8 + place, whole + np.flatnonzero(flat[whole:])])


class BestSoFar:
    """The best ``k`` tracks of a block of playlists, while tracks come in falling norm.

    Most tracks are told by 32-bit products, which miss the true ones by less than a bound: only
    those that may be among a playlist's best are scored in full. They wait beside the list, and
    it is put in order when their room is full; until then its k-th score is that of before."""

    def __init__(self, playlists: np.ndarray, factors: np.ndarray, own: np.ndarray, k: int):
        self.playlists, order = np.unique(playlists, return_index=True)
        self.factors, self.k = factors[order].astype(np.float64), k
        self.narrow = self.factors.astype(np.float32)
        self.norms = np.sqrt((self.factors**2).sum(axis=1))
        self.room = max(1, k // WAITING)
        self.best = np.full((len(self.playlists), k + self.room), NONE, np.int64)  # the list, and those that wait
        self.waiting = np.zeros(len(self.playlists), np.int64)
        self.least = np.full(len(self.playlists), NONE, np.int64)
        self.floor = np.full(len(self.playlists), -np.inf)  # the k-th score
        self.scored = np.zeros(len(self.playlists), np.int64)
        row = np.searchsorted(self.playlists, own[:, 0])
        known = (row < len(self.playlists)) & (self.playlists[np.minimum(row, len(self.playlists) - 1)] == own[:, 0])
        by_track = np.argsort(own[known, 1], kind="stable")
        self.own_track, self.own_row = own[known, 1][by_track], row[known][by_track]
        # memory that is used again and again: new pages cost more than what is done with them
        self.products, self.marks = np.empty(TOLD_AT_ONCE, np.float32), np.empty(TOLD_AT_ONCE, bool)
        self.pairs = np.empty((2, PAIRS_AT_ONCE, self.factors.shape[1]))

    def add(self, tracks: np.ndarray, factors: np.ndarray, norm: float) -> None:
        """Tracks of norm ``norm`` at most, and not above those before them."""
        active = np.flatnonzero(~(self.norms * norm * SLACK < self.floor))
        if not len(active):
            return
        self.scored[active] += len(tracks)
        low, high = np.searchsorted(self.own_track, tracks, "left"), np.searchsorted(self.own_track, tracks, "right")
        n = high - low
        own_row = self.own_row[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        own_column = np.repeat(np.arange(len(tracks)), n)
        by_row = np.argsort(own_row, kind="stable")
        own = own_row[by_row], own_column[by_row]
        told = self.norms[active] * norm < TOLD
        told &= (self.least[active] > NONE) | (len(tracks) > self.k)
        told &= len(tracks) <= TOLD_AT_ONCE
        untold = self._add_told(active[told], tracks, factors, norm, own) if told.any() else active[:0]
        rest = np.concatenate([active[~told], untold])
        rest.sort()
        step = max(1, AT_ONCE // len(tracks))
        for begin in range(0, len(rest), step):
            rows = rest[begin : begin + step]
            with np.errstate(over="ignore", invalid="ignore"):
                scores = (self.factors[rows] @ factors.T).astype(np.float32) + np.float32(0)  # no -0
            scores[_own_of(rows, *own)] = -np.inf
            self._order(rows, _keys(scores, tracks))

    def _add_told(self, active: np.ndarray, tracks: np.ndarray, factors: np.ndarray, norm: float, own: tuple) -> np.ndarray:
        """For playlists with products that 32 bits hold. Gives those whose list is not full and
        which have fewer than ``k`` tracks here that are not their own: nothing is done for them."""
        narrow, width, untold = factors.astype(np.float32).T.copy(), len(tracks), []
        step = max(1, TOLD_AT_ONCE // width)
        error = self.norms * (norm * (factors.shape[1] + 8) * np.finfo(np.float32).eps) + 1e-30
        for begin in range(0, len(active), step):
            rows = active[begin : begin + step]
            products = np.matmul(self.narrow[rows], narrow, out=self.products[: len(rows) * width].reshape(-1, width))
            products[_own_of(rows, *own)] = -np.inf
            reach = self.floor[rows] - error[rows]
            first = np.flatnonzero(self.least[rows] == NONE)
            if len(first):  # the k-th product is near the k-th score of these tracks
                kth = np.partition(products[first], width - self.k, axis=1)[:, width - self.k]
                reach[first] = np.where(np.isfinite(kth), kth - 2 * error[rows[first]], np.inf)
                untold.append(rows[first[~np.isfinite(kth)]])
            reach = np.nextafter(reach.astype(np.float32), np.float32(-np.inf))
            marks = np.greater_equal(products, reach[:, None], out=self.marks[: products.size].reshape(-1, width))
            row, column = np.divmod(_marked(marks), width)
            mine = products[row, column] > -np.inf
            row, column = rows[row[mine]], column[mine]
            keys = _keys(self._scores(row, factors, column), tracks[column])
            better = keys > self.least[row]
            if better.any():
                self._take(row[better], keys[better])
        return np.concatenate([active[:0], *untold])

    def _scores(self, row: np.ndarray, factors: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The scores of single pairs."""
        found = np.empty(len(row))
        for begin in range(0, len(row), PAIRS_AT_ONCE):
            end = min(len(row), begin + PAIRS_AT_ONCE)
            left, right = (room[: end - begin] for room in self.pairs)
            np.take(self.factors, row[begin:end], axis=0, out=left, mode="clip")
            np.take(factors, column[begin:end], axis=0, out=right, mode="clip")
            np.einsum("ij,ij->i", left, right, out=found[begin:end])
        return found.astype(np.float32) + np.float32(0)  # no -0

    def _take(self, row: np.ndarray, keys: np.ndarray) -> None:
        """These keys of the lists ``row``, which rise, wait, or are put in order with those that do."""
        first = np.flatnonzero(np.diff(row, prepend=-1))
        touched, counts = row[first], np.diff(first, append=len(row))
        place = np.arange(len(row)) - np.repeat(first, counts)
        waits = self.waiting[touched] + counts <= self.room
        some = np.repeat(waits, counts)
        self.best[row[some], self.k + place[some] + self.waiting[row[some]]] = keys[some]
        self.waiting[touched[waits]] += counts[waits]
        if waits.all():
            return
        full, counts = touched[~waits], counts[~waits]
        wide = np.full((len(full), int(counts.max())), NONE, np.int64)
        wide[np.repeat(np.arange(len(full)), counts), place[~some]] = keys[~some]
        self._order(full, wide)

    def _order(self, rows: np.ndarray, keys: np.ndarray) -> None:
        """The best of ``rows``, of those that wait and of these."""
        both = np.concatenate([self.best[rows], keys], axis=1)
        cut = both.shape[1] - self.k
        both.partition(cut, axis=1)
        self.best[rows, : self.k], self.best[rows, self.k :] = both[:, cut:], NONE
        self.waiting[rows], self.least[rows] = 0, both[:, cut]
        full = both[:, cut] > NONE
        self.floor[rows[full]] = _of_keys(both[full, cut])[0]

    def lists(self) -> Iterator[list[np.ndarray]]:
        """(playlist, rank, track, score, tracks scored) of all lists, best first, some playlists
        at a time."""
        for begin in range(0, len(self.playlists), LISTED):
            best = self.best[begin : begin + LISTED]
            keys = -np.sort(-np.where(best == NONE, NONE + 1, best), axis=1)[:, : self.k]
            row, rank = np.nonzero(keys > NONE + 1)
            scores, tracks = _of_keys(keys[row, rank])
            yield [self.playlists[begin + row], rank + 1, tracks, scores, self.scored[begin + row]]


def _own_of(rows: np.ndarray, own_row: np.ndarray, own_column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``rows``, column) of the own tracks of ``rows``; both rows rise."""
    some = slice(*np.searchsorted(own_row, [rows[0], rows[-1] + 1]))
    at = np.searchsorted(rows, own_row[some])
    there = rows[at] == own_row[some]
    return at[there], own_column[some][there]


def _by_norm(tracks: DataFrame, lanes: int) -> DataFrame:
    """(lane, first, place, ids, features): each lane's tracks in order of falling norm, in one
    partition, some to a row; ``place`` falls with the norm of the first. A row without tracks
    begins a lane (``first``)."""
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    norm = F.nanvl(norm, F.lit(float("inf")))
    number = F.col("track_idx").cast("int")
    lane = F.pmod(F.xxhash64(number), F.lit(lanes)).cast("int")
    wide = tracks.select(lane.alias("lane"), number.alias("id"), F.col("features").cast("array<float>").alias("features"), norm.alias("norm"))
    placed = wide.repartition(lanes, "lane").sortWithinPartitions("lane", F.desc("norm"), "id")

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun: int | None = None
        names = ["lane", "first", "place", "ids", "features"]
        for batch in batches:
            of_lane = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(of_lane)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(of_lane)], strict=True):
                if low == high:
                    continue
                number, part = int(of_lane[low]), batch.slice(low, high - low)
                if number != begun:
                    begun = number
                    nothing = [[number], [True], [float("-inf")], [[]], [[]]]
                    types = [pa.int32(), pa.bool_(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float32())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(nothing, types, strict=True)], names)
                begin = np.append(np.arange(0, part.num_rows, TOGETHER), part.num_rows)
                lists, flat = part.column(2), part.column(2).flatten()
                upto = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                columns = [
                    pa.array(np.full(len(begin) - 1, number, np.int32)),
                    pa.array(np.zeros(len(begin) - 1, bool)),
                    pa.array(-part.column(3).to_numpy()[begin[:-1]]),
                    pa.ListArray.from_arrays(pa.array(begin, pa.int32()), part.column(1)),
                    pa.ListArray.from_arrays(pa.array(upto[begin], pa.int32()), flat),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return placed.mapInArrow(together, "lane int, first boolean, place double, ids array<int>, features array<float>")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (g, kind, ids, features) again, those of a kind and block put together: what
    meets the tracks are few rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        begin = np.flatnonzero((np.diff(numbers, prepend=-1) != 0) | (np.diff(kinds, prepend=-1) != 0))
        begin, columns = np.append(begin, len(numbers)), []
        for lists in batch.columns[2:]:
            upto = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            columns.append(pa.ListArray.from_arrays(pa.array(upto[begin], pa.int32()), lists.flatten()))
        first = pa.array(begin[:-1])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(first), batch.column(1).take(first), *columns], ["g", "kind", "ids", "features"])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The lists of each block, of rows that come by block, playlists first, then own tracks,
    then tracks in order of place."""
    block: int | None = None
    held: dict[int, list] = {}
    best: BestSoFar | None = None

    def matrix(kind: int, width: int) -> np.ndarray:
        parts = [p.column("features").flatten().to_numpy() for p in held[kind]]
        return np.concatenate(parts).reshape(-1, width)

    def ids(kind: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(p.column("ids").flatten().to_numpy() for p in held[kind])]).astype(np.int64)

    def score() -> None:
        nonlocal best
        if not held[TRACK] or not (best or held[PLAYLIST]):
            return
        tracks = ids(TRACK)
        factors = matrix(TRACK, sum(len(p.column("features").flatten()) for p in held[TRACK]) // len(tracks)).astype(np.float64)
        if best is None:
            playlists = ids(PLAYLIST)
            best = BestSoFar(playlists, matrix(PLAYLIST, factors.shape[1]), ids(OWN).reshape(-1, 2), k)
            held[PLAYLIST], held[OWN] = [], []
        best.add(tracks, factors, -held[TRACK][0].column("place")[0].as_py())
        held[TRACK] = []

    def finished() -> Iterator[pa.RecordBatch]:
        score()
        for playlists, ranks, tracks, scores, scored in best.lists() if best else ():
            first = np.flatnonzero(ranks == 1)
            begin = pa.array(np.append(first, len(ranks)), pa.int32())
            columns = [
                pa.array(playlists[first], pa.int32()),
                pa.ListArray.from_arrays(begin, pa.array(tracks.astype(np.int32), pa.int32())),
                pa.ListArray.from_arrays(begin, pa.array(scores.astype(np.float32), pa.float32())),
                pa.array(scored[first], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["playlist_idx", "track_idxs", "scores", "scored"])

    for batch in batches:
        if not batch.num_rows:
            continue
        numbers, kinds = batch.column("g").to_numpy(), batch.column("kind").to_numpy()
        cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
            if numbers[begin] != block:
                if block is not None:
                    yield from finished()
                block, best, held = int(numbers[begin]), None, {PLAYLIST: [], OWN: [], TRACK: []}
            step = STRETCH // TOGETHER if kinds[begin] == TRACK else int(end - begin)
            for at in range(begin, end, step):
                held[int(kinds[begin])].append(batch.slice(at, min(step, end - at)))
                if kinds[begin] == TRACK and sum(p.num_rows for p in held[TRACK]) >= (step if best else FIRST // TOGETHER):
                    score()
    if block is not None:
        yield from finished()


def blocks_of(n: int, cores: int) -> int:
    """Blocks of ``n`` playlists: of ``PLAYLIST_BLOCK`` at most, and beyond one to a core as many
    to each."""
    blocks = max(1, -(-n // PLAYLIST_BLOCK), min(cores, -(-n // SMALL_BLOCK)))
    return blocks if blocks <= cores else -(-blocks // cores) * cores


def bounded_lists(
    playlists: DataFrame, tracks: DataFrame, k: int, seeds: DataFrame | None = None, lane_tracks: int = LANE_TRACKS
) -> tuple[DataFrame, int]:
    """(playlist_idx, track_idxs[], scores[], scored) of the best ``k`` tracks of each playlist in
    each lane, best first, and the number of lanes. ``scored`` is how many tracks were scored for
    the playlist; one without any candidate has no row."""
    cores = playlists.sparkSession.sparkContext.defaultParallelism
    n, m = playlists.count(), tracks.count()
    blocks = blocks_of(n, cores)
    lanes = max(1, -(-m // lane_tracks), min(-(-cores // blocks), -(-m // LANE_LEAST)))
    block_of = F.pmod(F.xxhash64(F.col("playlist_idx").cast("int")), F.lit(blocks))
    every_lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))

    def rows(df: DataFrame, kind: int, ids, features) -> DataFrame:
        g = (F.col("_block") * lanes + F.col("_lane")).cast("int").alias("g")
        return df.withColumn("_block", block_of).withColumn("_lane", every_lane).select(g, F.lit(kind).alias("kind"), ids.alias("ids"), features.alias("features"))

    playlist, track = F.col("playlist_idx").cast("int"), F.col("track_idx").cast("int")
    nothing = F.array().cast("array<float>")
    held = rows(playlists, PLAYLIST, F.array(playlist), F.col("features").cast("array<float>"))
    if seeds is not None:
        pairs = seeds.select("playlist_idx", "track_idx").dropna()
        held = held.unionByName(rows(pairs, OWN, F.array(playlist, track), nothing))
    every_g = playlists.sparkSession.range(blocks * lanes).select(F.col("id").cast("int").alias("g"), F.lit(TRACK).alias("kind"))
    held = held.unionByName(every_g.select("*", F.array().cast("array<int>").alias("ids"), nothing.alias("features")))
    # by its number, a block has a partition of its own, and none is empty: each reads a lane's tracks
    dealt = held.repartitionById(blocks * lanes, "g").sortWithinPartitions("g", "kind")
    dealt = dealt.mapInArrow(_packed, "g int, kind int, ids array<int>, features array<float>")
    # the tracks are written once and read by the task of each block, which is a product without a
    # shuffle: a block's own rows meet the row that begins its lane, and its last row the tracks
    of = {name: F.when(F.col("b.kind") == TRACK, F.col(f"t.{name}")).otherwise(F.col(f"b.{name}")).alias(name) for name in ("ids", "features")}
    meets = (F.pmod(F.col("b.g"), F.lit(lanes)) == F.col("t.lane")) & ((F.col("b.kind") == TRACK) != F.col("t.first"))
    met = dealt.alias("b").join(_by_norm(tracks, lanes).alias("t").hint("shuffle_replicate_nl"), meets)
    met = met.select("b.g", "b.kind", "t.place", of["ids"], of["features"])
    schema = "playlist_idx int, track_idxs array<int>, scores array<float>, scored long"
    return met.mapInArrow(lambda batches: _search(batches, k), schema), lanes


def best_lists(
    playlists: DataFrame, tracks: DataFrame, k: int, seeds: DataFrame | None = None, lane_tracks: int = LANE_TRACKS
) -> DataFrame:
    """(playlist_idx, track_idxs[], scores[]): a row a playlist with its ``k`` best tracks, best first,
    leaving out the pairs of ``seeds``. With one lane the lists are as they leave their task, and
    nothing is shuffled; those of several lanes meet as lists."""
    found, lanes = bounded_lists(playlists, tracks, k, seeds, lane_tracks)
    if lanes == 1:
        return found.drop("scored")
    of_lane = F.transform(F.arrays_zip("scores", "track_idxs"), lambda one: F.struct((-one["scores"]).alias("below"), one["track_idxs"].alias("track")))
    met = found.repartition("playlist_idx").groupBy("playlist_idx").agg(F.flatten(F.collect_list(of_lane)).alias("met"))
    best = met.select("playlist_idx", F.slice(F.array_sort("met"), 1, k).alias("best"))
    scores = F.transform("best.below", lambda one: F.lit(0.0).cast("float") - one)  # no -0
    return best.select("playlist_idx", F.col("best.track").alias("track_idxs"), scores.alias("scores"))


def best_scored_tracks(
    playlists: DataFrame, tracks: DataFrame, k: int, seeds: DataFrame | None = None, lane_tracks: int = LANE_TRACKS
) -> DataFrame:
    """(playlist_idx, rank, track_idx, score): the ``k`` best tracks of each playlist, leaving out
    the pairs of ``seeds``. ``playlists`` (playlist_idx, features) and ``tracks`` (track_idx,
    features) hold factors; ties go to the smaller track. Scores are 32-bit; one that is not a
    finite number is no candidate."""
    lists = best_lists(playlists, tracks, k, seeds, lane_tracks)
    rows = lists.select("playlist_idx", F.posexplode(F.arrays_zip("track_idxs", "scores")).alias("place", "one"))
    return rows.select("playlist_idx", (F.col("place") + 1).alias("rank"), F.col("one.track_idxs").alias("track_idx"), F.col("one.scores").alias("score"))


def rows_of(lists: DataFrame) -> DataFrame:
    """(playlist_idx, rank, track_idx) of lists (playlist_idx, track_idxs[])."""
    rows = lists.select("playlist_idx", F.posexplode("track_idxs").alias("place", "track_idx"))
    return rows.select("playlist_idx", (F.col("place") + 1).alias("rank"), "track_idx")


def best_tracks(playlists: DataFrame, tracks: DataFrame, k: int, seeds: DataFrame | None = None) -> DataFrame:
    """(playlist_idx, rank, track_idx) of ``best_scored_tracks``."""
    return rows_of(best_lists(playlists, tracks, k, seeds))


def scored_shares(playlists: DataFrame, tracks: DataFrame, k: int, seeds: DataFrame | None = None) -> DataFrame:
    """(playlist_idx, scored, share): for how many tracks, and for what share of them, a score was
    made before the bound ended the search. With several lanes it is that of the longest."""
    found, lanes = bounded_lists(playlists, tracks, k, seeds)
    share = F.least(F.lit(1.0), F.col("scored") * lanes / F.lit(max(1, tracks.count())))
    return found.groupBy("playlist_idx").agg(F.max("scored").alias("scored")).withColumn("share", share)
