"""Reproducible train and test sets.

The side of a row is a function of its key alone, so the split needs no join,
no shuffle and no seed-dependent row order, and any partitioning gives the same
two sets.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How many values each hash can take.
RANGES = {"xxhash64": 1 << 62, "md5": 1 << 32}


def key_hash(keys: list, seed: int = 42, algorithm: str = "xxhash64") -> Column:
    """A whole number below ``RANGES[algorithm]`` for the key. ``md5`` is slower but
    common to all engines."""
    if algorithm == "xxhash64":
        return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(RANGES[algorithm]))
    if algorithm == "md5":
        text = F.concat_ws("|", *[F.col(key).cast("string") for key in keys], F.lit(str(seed)))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash: {algorithm}")


def mark_test(
    df: DataFrame, keys: list, test_share: float = 0.1, seed: int = 42, algorithm: str = "xxhash64"
) -> DataFrame:
    """Add ``is_test``.

    With the playlist as key, whole playlists go to one side. With playlist and
    track as keys, a share of each playlist's tracks is held out instead, which
    keeps every test playlist known to a model fitted on the other side. The whole
    hash is compared, so a share as small as one row in many gets its rows.
    """
    value = key_hash(keys, seed, algorithm)
    return df.withColumn("is_test", value >= round((1 - test_share) * RANGES[algorithm]))


def train_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col("is_test")).drop("is_test")


def heldout_rows(marked: DataFrame) -> DataFrame:
    return marked.filter("is_test").drop("is_test")


def hold_out_tail(playlists: DataFrame, test_share: float = 0.1, seed: int = 42) -> DataFrame:
    """Entries with ``is_test`` for the last tracks of each playlist.

    A playlist's share is seldom a whole number of tracks; it is rounded up for a part
    of the playlists, chosen by a hash of the pid, and down for the others, so that the
    share holds over the corpus and short playlists are not left whole. Works on the
    nested rows, where the length is at hand: no shuffle.
    """
    wanted = F.size("tracks") * F.lit(float(test_share))
    chance = key_hash(["pid"], seed, "md5") / F.lit(RANGES["md5"])
    held = F.floor(wanted) + (chance < wanted - F.floor(wanted)).cast("int")
    return (
        playlists.select("pid", (F.size("tracks") - held).alias("kept"), F.posexplode("tracks").alias("ordinal", "track"))
        .select("pid", "ordinal", "track.track_uri", (F.col("ordinal") >= F.col("kept")).alias("is_test"))
    )


def split_summary(marked: DataFrame) -> DataFrame:
    """Row counts of both sides and the test share, one row."""
    test = F.count_if("is_test")
    rows = F.count(F.lit(1))
    return marked.agg(
        rows.alias("total_rows"),
        (rows - test).alias("train_rows"),
        test.alias("test_rows"),
        (test / rows).alias("test_share"),
    )
