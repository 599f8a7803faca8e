"""Ranked lists: decoding, collecting, seed removal and average precision.

A recommendation is a row (playlist_idx, rank, track_idx), rank from 1. Lists
are collected only where the rank bounds them; relevant tracks stay rows,
because nothing bounds how many a playlist has.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixloom.functions.arrays import average_precision, ids_of
from mixloom.operators.salted import salted_lists
from mixloom.operators.scoring import rows_of
from mixloom.operators.skew import BROADCAST_BYTES, HOT_ROWS, chunked_lists, hot_keys, skew_join
from mixloom.storage import staged

K = 500
CHUNK = 10_000  # values in one collected list
LISTED_ROWS = 1_000_000  # rows of lists that are collected in one task
LISTED_TRACKS = 2_000_000  # tracks whose URIs are broadcast, if their bytes allow


def ranked_rows(recommendations: DataFrame) -> DataFrame:
    """(playlist_idx, recommendations[]) to (playlist_idx, rank, track_idx)."""
    return recommendations.select(
        "playlist_idx",
        F.posexplode(ids_of("recommendations", "track_idx")).alias("place", "track_idx"),
    ).select("playlist_idx", (F.col("place") + 1).alias("rank"), "track_idx")


def first_k(df: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The first ``k`` rows per group with their ``rank``.

    Spark cuts each map task's share of a group to ``k`` before the shuffle, so
    a large group never meets in one task.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def without_seeds(ranked: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """Drop a playlist's own tracks, close the gaps and keep the first ``k``.

    ``ranked`` must reach k + (the playlist's number of seeds) deep to give k.
    """
    fresh = ranked.join(seeds, ["playlist_idx", "track_idx"], "left_anti")
    return first_k(fresh.withColumnRenamed("rank", "old_rank"), "playlist_idx", ["old_rank"], k).select(
        "playlist_idx", "rank", "track_idx"
    )


def collect_ranked(ranked: DataFrame, value: str, name: str, k: int = K) -> DataFrame:
    """(playlist_idx, name[]) in rank order; null values are left out.

    The cut at ``k`` bounds every list.
    """
    pairs = F.array_sort(F.collect_list(F.struct("rank", F.col(value).alias("value"))))
    values = F.filter(ids_of(pairs, "value"), lambda one: one.isNotNull())
    return ranked.filter(F.col("rank") <= k).groupBy("playlist_idx").agg(values.alias(name))


def collect_chunks(df: DataFrame, key: str, value: str, name: str, max_len: int = CHUNK) -> DataFrame:
    """(key, chunk, name[]): the values of each key in order.

    A key with at most ``max_len`` values has the one row ``chunk = 0``; a longer
    list goes on in further rows. Values must be unique per key.
    """
    return chunked_lists(df.select(key, value), key, [value], F.col(value), name, max_len)


def collect_salted(df: DataFrame, key: str, value: str, name: str, max_len: int = CHUNK, min_rows: int = HOT_ROWS) -> DataFrame:
    """The same, with the rows of hot keys spread over salts before they are collected. ``df``
    is read twice and should be a written table."""
    return salted_lists(df.select(key, value), key, [value], F.col(value), name, max_len, min_rows=min_rows)


def decode(ranked: DataFrame, dictionary: DataFrame, key: str, how: str = "inner", hot: list | None = None) -> DataFrame:
    """Add the natural key of ``key``. ``how="left"`` keeps unknown indices as null.

    A popular track stands in most lists, so its rows are joined apart. Unless
    ``hot`` is given, ``ranked`` is read once more to find such tracks and should
    be a written table.
    """
    hot = hot_keys(ranked, key) if hot is None else hot
    return skew_join(ranked, dictionary, key, hot, how)


def score_inputs(ranked: DataFrame, truth: DataFrame, k: int = K) -> DataFrame:
    """The ranked rows that are relevant: at most ``k`` per playlist.

    Joined on (playlist, track), a key no playlist or track can make heavy.
    """
    return ranked.filter(F.col("rank") <= k).join(
        truth.select("playlist_idx", "track_idx"), ["playlist_idx", "track_idx"], "left_semi"
    )


def truth_sizes(truth: DataFrame) -> DataFrame:
    return truth.groupBy("playlist_idx").agg(F.count(F.lit(1)).alias("actual_size"))


def evaluated_playlists(ranked: DataFrame, truth: DataFrame, missing: str = "drop") -> DataFrame:
    """(playlist_idx, actual_size) of the playlists to score.

    ``drop``: those with both a list and relevant tracks. ``zero``: all with
    relevant tracks; one without a list scores 0.
    """
    sizes = truth_sizes(truth)
    if missing == "zero":
        return sizes
    if missing == "drop":
        listed = ranked.select("playlist_idx").distinct()
        return sizes.join(listed, "playlist_idx", "left_semi")
    raise ValueError(f"unknown way to treat missing lists: {missing}")


def scores(ranked: DataFrame, truth: DataFrame, k: int = K, missing: str = "drop") -> DataFrame:
    """(playlist_idx, map_score): AP@k from rows, without collecting any list.

    Sum over the hits of (hits so far / rank) by min(relevant tracks, k).
    """
    so_far = Window.partitionBy("playlist_idx").orderBy("rank")
    gains = (
        score_inputs(ranked, truth, k)
        .withColumn("gain", F.row_number().over(so_far) / F.col("rank"))
        .groupBy("playlist_idx")
        .agg(F.sum("gain").alias("total"))
    )
    wanted = evaluated_playlists(ranked, truth, missing)
    return wanted.join(gains, "playlist_idx", "left").select(
        "playlist_idx",
        F.coalesce(F.col("total") / F.least("actual_size", F.lit(k)), F.lit(0.0)).alias("map_score"),
    )


def scores_of_lists(lists: DataFrame, truth: DataFrame, k: int = K, missing: str = "drop") -> DataFrame:
    """The same scores from lists (playlist_idx, track_idxs[]), a row a playlist and without nulls.

    A list stays a list and moves once, to its playlist's relevant tracks; these come in chunks,
    and the places of the hits in each chunk, at most ``k``, meet again.
    """
    relevant = collect_chunks(truth.select("playlist_idx", "track_idx").dropna().distinct(), "playlist_idx", "track_idx", "relevant")
    listed = lists.select("playlist_idx", F.slice("track_idxs", 1, k).alias("listed"))
    places = F.transform("listed", lambda one, place: F.when(F.array_contains("relevant", one), place + 1))
    hits = listed.join(relevant, "playlist_idx").select("playlist_idx", F.filter(places, lambda one: one.isNotNull()).alias("hits"))
    met = hits.groupBy("playlist_idx").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    gains = F.transform("hits", lambda rank, before: (before + 1) / rank)
    gains = met.select("playlist_idx", F.aggregate(gains, F.lit(0.0), lambda total, one: total + one).alias("total"))
    wanted = evaluated_playlists(lists, truth, missing)
    return wanted.join(gains, "playlist_idx", "left").select(
        "playlist_idx",
        F.coalesce(F.col("total") / F.least("actual_size", F.lit(k)), F.lit(0.0)).alias("map_score"),
    )


def scores_by_array(ranked: DataFrame, truth: DataFrame, k: int = K, missing: str = "drop") -> DataFrame:
    """The same scores through the array expression.

    Of the relevant tracks only those in the list are collected, at most ``k``;
    their full number comes along as a count.
    """
    predicted = collect_ranked(ranked, "track_idx", "predicted", k)
    relevant = (
        score_inputs(ranked, truth, k)
        .groupBy("playlist_idx")
        .agg(F.collect_set("track_idx").alias("relevant"))
    )
    wanted = evaluated_playlists(ranked, truth, missing)
    joined = wanted.join(predicted, "playlist_idx", "left").join(relevant, "playlist_idx", "left")
    none = F.array().cast(joined.schema["predicted"].dataType)
    score = average_precision(
        F.coalesce("predicted", none), F.coalesce("relevant", none), k, F.col("actual_size")
    )
    return joined.select("playlist_idx", score.alias("map_score"))


def score_summary(scored: DataFrame) -> DataFrame:
    """Mean, count, sample deviation and range of the scores, one row."""
    return scored.agg(
        F.avg("map_score").alias("mean_ap"),
        F.count("map_score").alias("num_playlists"),
        F.stddev("map_score").alias("std_dev"),
        F.min("map_score").alias("min_ap"),
        F.max("map_score").alias("max_ap"),
    )


def _listed_tracks(listed: DataFrame, tracks: DataFrame) -> tuple[DataFrame, bool]:
    """The tracks that are listed, staged, and whether they are small enough to broadcast."""
    used = staged(tracks.join(listed.select("track_idx").distinct(), "track_idx", "left_semi"), "listed-tracks")
    size = used.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("track_uri")).alias("bytes")).first()
    return used, size["rows"] <= LISTED_TRACKS and (size["bytes"] or 0) <= BROADCAST_BYTES


def _with_uris(listed: DataFrame, tracks: DataFrame, hot: list | None) -> DataFrame:
    """``listed`` with ``track_uri``, null where it is unknown.

    Only the tracks that are listed count. Where they are small enough to broadcast, the rows move
    once, as numbers, to where their playlist's list is collected; otherwise they move by track.
    """
    used, small = _listed_tracks(listed, tracks)
    if small:
        tasks = -(-listed.count() // LISTED_ROWS) or 1
        return listed.repartition(tasks, "playlist_idx").join(F.broadcast(used), "track_idx", "left")
    return decode(listed, used, "track_idx", "left", hot)


def submission(
    ranked: DataFrame, tracks: DataFrame, playlists: DataFrame, k: int = K, hot: list | None = None
) -> DataFrame:
    """(playlist_id, recommended_track_uris): URIs in rank order, comma-joined, one row for
    every row of ``playlists``.

    Unknown tracks are left out; a list may then be shorter than ``k``, and is empty where
    nothing was recommended.
    """
    return _submitted(_with_uris(ranked.filter(F.col("rank") <= k), tracks, hot), playlists, k)


def submission_of_lists(lists: DataFrame, tracks: DataFrame, playlists: DataFrame, k: int = K, hot: list | None = None) -> DataFrame:
    """The same of lists (playlist_idx, track_idxs[]), a row a playlist, which should be a written table.

    Where the tracks are small enough to broadcast, a list moves once, as one row of numbers, to
    its playlist, and is decoded there.
    """
    lists = lists.select("playlist_idx", F.slice("track_idxs", 1, k).alias("track_idxs"))
    used, small = _listed_tracks(rows_of(lists), tracks)
    if not small:
        return _submitted(decode(rows_of(lists), used, "track_idx", "left", hot), playlists, k)
    listed = lists.agg(F.sum(F.size("track_idxs").cast("long")).alias("n")).first()["n"] or 0
    dealt = lists.repartition(-(-listed // LISTED_ROWS) or 1, "playlist_idx")
    return _submitted(rows_of(dealt).join(F.broadcast(used), "track_idx", "left"), playlists, k)


def _submitted(named: DataFrame, playlists: DataFrame, k: int) -> DataFrame:
    lists = collect_ranked(named, "track_uri", "uris", k)
    return playlists.join(lists, "playlist_idx", "left").select(
        "playlist_id", F.concat_ws(",", "uris").alias("recommended_track_uris")
    )
