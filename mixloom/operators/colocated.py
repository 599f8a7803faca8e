"""Encoding whose joins move no rows: pairs and dictionaries bucketed and sorted alike.

A dictionary join of the usual kind shuffles the pairs for each key. Here the pairs are written
once in buckets of their track and once, with its index, in buckets of their playlist, and each
dictionary in the same buckets of its key; a bucket then joins its namesake where it lies. The
tables stay for later runs: what is encoded again, or decoded, finds its dictionary in place.

Hot tracks would fill one bucket; their pairs are encoded apart, by at most ``HOT_KEYS`` broadcast
rows, and go straight to the buckets of playlists. A playlist's pairs are as many as its distinct
tracks; where one is hot it is treated alike.
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators.indexing import counted_dictionary
from mixloom.operators.skew import hot_keys_from_counts
from mixloom.storage import scratch_path, staged

ROWS_PER_BUCKET = 1_000_000


def write_bucketed(df: DataFrame, key: str, buckets: int, path: str) -> DataFrame:
    """``df`` in ``buckets`` sorted files by ``key`` below ``path``. The catalog only lends a name
    while the table is written and read back; the files know nothing of it."""
    spark, name = df.sparkSession, f"mixloom_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.option("path", path).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")
    return table


def _encoded(pairs: DataFrame, counted: DataFrame, key: str, buckets: int, root: str) -> DataFrame:
    """``pairs`` with the index of ``key`` instead of it."""
    counted = staged(counted, "counted")
    hot = hot_keys_from_counts(counted, key, "n")
    index = counted.drop("n")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    left = write_bucketed(pairs.filter(~is_hot) if hot else pairs, key, buckets, f"{root}/pairs-by-{key}")
    right = write_bucketed(index, key, buckets, f"{root}/dictionary-of-{key}")
    joined = left.join(right, key).drop(key)
    if hot:
        apart = pairs.filter(is_hot).join(F.broadcast(index.filter(is_hot)), key).drop(key)
        joined = joined.unionByName(apart)
    return joined


def encode_colocated(pairs: DataFrame, root: str | None = None, buckets: int | None = None) -> DataFrame:
    """(playlist_idx, track_idx, count) of the distinct (playlist_id, track_uri) ``pairs``, a
    written table. Tables go below ``root``, by default a scratch folder."""
    root = root or scratch_path(pairs.sparkSession, "colocated")
    buckets = buckets or max(8, -(-pairs.count() // ROWS_PER_BUCKET))
    tracks = counted_dictionary(pairs, "track_uri", "track_idx")
    playlists = counted_dictionary(pairs, "playlist_id", "playlist_idx")
    by_track = _encoded(pairs.filter("track_uri is not null"), tracks, "track_uri", buckets, root)
    coded = _encoded(by_track.filter("playlist_id is not null"), playlists, "playlist_id", buckets, root)
    return coded.select("playlist_idx", "track_idx", F.lit(1).alias("count"))
