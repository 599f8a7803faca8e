"""The test tables as playlist corpus, on Spark."""

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import shape
from mixloom.operators.flatten import implicit_entries, interactions_of, keep_tracks
from mixloom.operators.skew import chunked_lists, dense_numbers, in_chunks, join_small, long_keys, numbers_in_group
from mixloom.operators.split import heldout_rows, mark_test, train_rows
from mixloom.schema import TRACK_PREFIX
from mixloom.sources.sinks import write_parquet
from mixloom.storage import scratch_path, shuffles_dropped, staged

_staged: dict = {}
_paths: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once per application and then read back."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        path, built = scratch_path(spark, name), build()
        with shuffles_dropped(spark):
            _staged[key] = (path, write_parquet(built, path).schema)
    path, schema = _staged[key]
    return spark.read.schema(schema).parquet(path)


def stage_path(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """Where this application already wrote ``name``, if it did."""
    return _paths.get((spark.sparkContext.applicationId, sf_dir, name))


def keep_path(spark: SparkSession, sf_dir: str, name: str, path: str) -> str:
    _paths[(spark.sparkContext.applicationId, sf_dir, name)] = path
    return path


def _tracks(lines: DataFrame, spark: SparkSession, sf_dir: str, *kept) -> DataFrame:
    """Lines with the track columns of their part.

    A plain equi-join: Spark broadcasts ``part`` when its size allows, and splits
    a heavy part at run time otherwise, as no later step keeps this partitioning.
    """
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return lines.join(parts, "l_partkey").select(
        *kept, *[F.expr(sql).alias(name) for name, sql in shape.ENTRY.items()]
    )


def _long_orders(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """(l_orderkey) of the orders with more than ``CHUNK`` lines, None if there are none."""
    long = stage(spark, sf_dir, "long_orders", lambda: long_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", shape.CHUNK))
    return long if long.limit(1).count() else None


def lines_by_playlist(spark: SparkSession, sf_dir: str, columns: list | None = None) -> DataFrame:
    """The lines with ``pid``: their order, or for an order of more than ``CHUNK`` lines the
    chunk of it they fall in. Only lines of such orders are numbered."""
    lines = table(spark, sf_dir, "lineitem")
    if columns:
        lines = lines.select(*columns)
    long, whole = _long_orders(spark, sf_dir), lines.withColumn("pid", F.col("l_orderkey"))
    if long is None:
        return whole
    cut = numbers_in_group(join_small(lines, long, ["l_orderkey"], "left_semi"), ["l_orderkey"], shape.LINE_ORDER, "line")
    cut = cut.withColumn("pid", F.col("l_orderkey") + F.expr(f"line div {shape.CHUNK}") * shape.NEXT_CHUNK).drop("line")
    return join_small(whole, long, ["l_orderkey"], "left_anti").unionByName(cut)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat entries with ``pid`` and the columns that order them."""
    return _tracks(lines_by_playlist(spark, sf_dir), spark, sf_dir, "pid", *shape.LINE_ORDER)


SEEN = ["pid", *shape.LINE_ORDER]


def playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a playlist, a long one as several, without totals or description."""
    return _heads(spark, sf_dir).drop("o_orderkey")


def _heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    modified = shape.MODIFIED_AT.format(seconds=shape.SPARK_SECONDS)
    heads = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *[F.expr(sql).alias(name) for name, sql in shape.PLAYLIST.items()],
        F.expr(modified).alias("modified_at"),
    )
    first = heads.withColumn("pid", F.col("o_orderkey"))
    if _long_orders(spark, sf_dir) is None:
        return first
    further = lines_by_playlist(spark, sf_dir, ["l_orderkey", *shape.LINE_ORDER]).filter("pid <> l_orderkey")
    chunks = further.select(F.col("l_orderkey").alias("o_orderkey"), "pid").distinct()
    return first.unionByName(heads.join(chunks, "o_orderkey"))


def described_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the whole text of the document of the order's number, if there is one."""
    return _described(spark, sf_dir).drop("o_orderkey")


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("o_orderkey"), F.col("text").alias("description")
    )
    return _heads(spark, sf_dir).join(texts, "o_orderkey", "left")


def sized_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the declared ``num_tracks``, one too many for some."""
    counts = lines_by_playlist(spark, sf_dir, ["l_orderkey", *shape.LINE_ORDER]).groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    declared = F.coalesce("n", F.lit(0)) + F.when(F.col("pid") % 97 == 0, 1).otherwise(0)
    return playlists(spark, sf_dir).join(counts, "pid", "left").withColumn("num_tracks", declared).drop("n")


def nested_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlists with nested tracks, staged.

    Every ``CHUNK`` lines of an order make one playlist, so the nested list is bounded even
    for an order that holds much of the table.
    """
    return stage(spark, sf_dir, "playlists", lambda: _build_nested(spark, sf_dir))


def _lines_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *shape.LINE_ORDER, "l_quantity")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return lines.join(parts, "l_partkey")


# Lists are shuffled with what the fields of a track are made of; the fields are made after.
MADE_OF = ["p_name", "p_brand", "l_quantity", "l_partkey", "l_suppkey"]


def _tracks_of(listed: str) -> Column:
    """The tracks of a list with ``MADE_OF``, in its order."""
    fields = {name: re.sub(r"\b([lp]_\w+)", r"one.\1", sql) for name, sql in shape.ENTRY.items()}
    # Some entries state a place that is not theirs.
    wrong = "case when one.l_suppkey % 37 = 0 and one.l_partkey % 5 = 0 then 1 else 0 end"
    made = ", ".join([f"'pos', cast(place + {wrong} as bigint)", *(f"'{name}', {sql}" for name, sql in fields.items())])
    return F.expr(f"transform({listed}, (one, place) -> named_struct({made}))")


def _build_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines_with_parts(spark, sf_dir)
    grouped = chunked_lists(lines, "l_orderkey", shape.LINE_ORDER, F.struct(*MADE_OF), "listed", shape.CHUNK)
    grouped = grouped.select(
        (F.col("l_orderkey") + F.col("chunk") * F.lit(shape.NEXT_CHUNK)).alias("pid"),
        _tracks_of("listed").alias("tracks"),
    )
    return _declared(described_playlists(spark, sf_dir).join(grouped, "pid", "left"))


def _declared(joined: DataFrame, *kept: str) -> DataFrame:
    """Playlists with the totals that they declare, some of them wrong."""
    size = F.greatest(F.coalesce(F.size("tracks"), F.lit(0)), F.lit(0))

    def distinct(name):
        return F.greatest(
            F.coalesce(F.size(F.array_distinct(f"tracks.{name}")), F.lit(0)), F.lit(0)
        )

    def off(step):
        return F.when(F.col("pid") % step == 0, 1).otherwise(0)

    total = F.coalesce(
        F.aggregate("tracks.duration_ms", F.lit(0).cast("bigint"), lambda a, b: a + b),
        F.lit(0).cast("bigint"),
    )
    return joined.select(
        *kept,
        "pid",
        "name",
        "description",
        "collaborative",
        "modified_at",
        (size + off(97)).cast("bigint").alias("num_tracks"),
        (distinct("album_uri") + off(83)).cast("bigint").alias("num_albums"),
        (distinct("artist_uri") + off(79)).cast("bigint").alias("num_artists"),
        "num_followers",
        "num_edits",
        (total + off(73)).cast("bigint").alias("duration_ms"),
        "tracks",
    )


def slices(spark: SparkSession, sf_dir: str, change: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(slice_no, info, playlists): ``SLICE_SIZE`` ids to a slice, of the playlists of
    :func:`nested_playlists` after ``change``.

    The playlists are put together where their slice is: their heads and lines move there as they
    are read, once, and not as lists, which are several times as large.
    """
    change = change or (lambda nested: nested)
    lines = _lines_with_parts(spark, sf_dir).filter("l_orderkey is not null")
    line = F.struct(*dict.fromkeys([*shape.LINE_ORDER, *MADE_OF]))
    lines = in_chunks(lines, "l_orderkey", shape.LINE_ORDER, shape.CHUNK).select(
        (F.col("l_orderkey") + F.col("chunk") * F.lit(shape.NEXT_CHUNK)).alias("pid"), line.alias("line")
    )
    heads = described_playlists(spark, sf_dir)
    head = F.struct(*[name for name in heads.columns if name != "pid"])
    rows = heads.select("pid", head.alias("head")).unionByName(lines, allowMissingColumns=True)

    def playlists(rows: DataFrame) -> DataFrame:
        lists = rows.groupBy("slice_no", "pid").agg(F.collect_list("head").alias("heads"), F.array_sort(F.collect_list("line")).alias("lines"))
        listed = F.when(F.size("lines") > 0, F.col("lines"))
        # lines without a playlist end here, and equal ids are playlists of their own
        joined = lists.select("slice_no", "pid", listed.alias("listed"), F.explode("heads").alias("head"))
        joined = joined.select("slice_no", "pid", "head.*", _tracks_of("listed").alias("tracks"))
        return change(_declared(joined, "slice_no"))

    return to_slices(rows, playlists, _heads(spark, sf_dir))


SLICES_PER_TASK = 50


def to_slices(rows: DataFrame, playlists: Callable[[DataFrame], DataFrame] | None = None, counted: DataFrame | None = None) -> DataFrame:
    """The slices of ``rows``, in order of ``slice_no`` over all partitions.

    The rows move once, to the partition of their slice, where the slices are put together.
    They are playlists, or ``playlists`` makes them of all rows of a ``slice_no``. ``counted`` has the
    ids to count the slices by, where that is less work than to count them in ``rows``.
    """
    number = F.expr(f"pid div {shape.SLICE_SIZE}").alias("slice_no")
    tasks = -(-(rows if counted is None else counted).select(number).distinct().count() // SLICES_PER_TASK) or 1
    low = F.col("slice_no") * shape.SLICE_SIZE
    span = F.concat_ws("-", low, low + shape.SLICE_SIZE - 1)
    info = F.struct(
        F.lit("2017-12-03 08:41:42").alias("generated_on"),
        span.alias("slice"),
        F.lit("v1").alias("version"),
    )
    dealt = rows.withColumn("slice_no", number).repartitionByRange(tasks, "slice_no")
    nested = playlists(dealt) if playlists else dealt
    return (
        nested.groupBy("slice_no")
        .agg(F.array_sort(F.collect_list(F.struct(*nested.drop("slice_no").columns))).alias("playlists"))
        .sortWithinPartitions("slice_no")
        .select("slice_no", info.alias("info"), "playlists")
    )


# --- interactions for the ranking and model queries ---------------------------

DEPTH = 500
NEAR = 1000  # the first tracks, which lists are cut from


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct (customer, part) pairs as (playlist_idx, track_idx), staged."""

    def build():
        lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        return (
            lines.join(orders, "o_orderkey")
            .select(
                F.col("o_custkey").cast("int").alias("playlist_idx"),
                F.col("l_partkey").cast("int").alias("track_idx"),
            )
            .distinct()
            .withColumn("count", F.lit(1))
        )

    return stage(spark, sf_dir, "interactions", build)


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of each playlist's tracks held out, by a hash both engines have."""
    return mark_test(interactions(spark, sf_dir), ["playlist_idx", "track_idx"], 0.1, 42, "md5")


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_rows(marked(spark, sf_dir))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heldout_rows(marked(spark, sf_dir))


def popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rank, track_idx): training tracks by number of playlists, then by index.

    Numbered through range partitions, not in one task.
    """
    def build():
        counts = train(spark, sf_dir).groupBy("track_idx").agg(F.count(F.lit(1)).alias("n"))
        falling = counts.withColumn("neg", -F.col("n"))
        return dense_numbers(falling, ["neg", "track_idx"], "place").select(
            (F.col("place") + 1).cast("int").alias("rank"), "track_idx"
        )

    return stage(spark, sf_dir, "popular", build)


def ranked(spark: SparkSession, sf_dir: str, k: int = DEPTH) -> DataFrame:
    """(playlist_idx, rank, track_idx): the ``k`` most popular tracks that are
    not among the playlist's own; staged. A list with exact values for the
    ranking queries.

    A playlist's own tracks, in order of rank, leave gaps of fresh ones between them; only the
    gaps that reach into the first ``k`` fresh ones are kept. Gaps are cut from one array of the
    first ``NEAR`` tracks, without a shuffle of their rows, and what lies beyond is joined.
    """

    def build():
        seeds = train(spark, sf_dir).select("playlist_idx", "track_idx")
        places = popular(spark, sf_dir)
        own = seeds.filter("playlist_idx is not null").join(places, "track_idx").select("playlist_idx", "rank")
        # a gap ends before an own track, the last one nowhere
        ends = own.unionByName(seeds.select("playlist_idx").distinct().withColumn("rank", F.lit(2**31 - 1)))
        in_order = Window.partitionBy("playlist_idx").orderBy("rank")
        before = F.row_number().over(in_order) - 1  # own tracks before the gap
        gaps = ends.withColumns({"before": before, "begin": F.lag("rank", 1, 0).over(in_order) + 1})
        gaps = gaps.withColumn("last", F.least(F.col("rank") - 1, F.col("before") + k)).filter("begin <= last")
        gaps = staged(gaps.select("playlist_idx", "before", "begin", "last"), "gaps")

        first = places.filter(F.col("rank") <= NEAR).agg(F.array_sort(F.collect_list(F.struct("rank", "track_idx"))).alias("first"))
        first = first.select(F.col("first.track_idx").alias("first"))
        near = gaps.filter(F.col("begin") <= NEAR).crossJoin(F.broadcast(first))
        cut = F.slice("first", F.col("begin"), F.least("last", F.lit(NEAR)) - F.col("begin") + 1)
        near = near.select("playlist_idx", (F.col("begin") - F.col("before")).alias("from"), F.posexplode(cut).alias("place", "track_idx"))
        near = near.select("playlist_idx", (F.col("from") + F.col("place")).alias("rank"), "track_idx")

        reach = F.explode(F.sequence(F.greatest("begin", F.lit(NEAR + 1)), "last"))
        far = gaps.filter(F.col("last") > NEAR).select("playlist_idx", "before", reach.alias("rank")).join(places, "rank")
        return near.unionByName(far.select("playlist_idx", (F.col("rank") - F.col("before")).alias("rank"), "track_idx"))

    return stage(spark, sf_dir, "ranked", build)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct clean (playlist_id, track_uri), staged."""
    return stage(
        spark,
        sf_dir,
        "pairs",
        lambda: interactions_of(keep_tracks(implicit_entries(entries(spark, sf_dir)))),
    )


def track_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(track_idx, track_uri) of the parts with a track URI; the others are
    unknown indices to a decode."""
    uri = F.expr(shape.ENTRY["track_uri"])
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    return parts.select(F.col("l_partkey").cast("int").alias("track_idx"), uri.alias("track_uri")).filter(
        F.col("track_uri").startswith(TRACK_PREFIX)
    )


def playlist_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("playlist_idx"), (F.col("c_custkey") + 1000000).alias("playlist_id")
    )
