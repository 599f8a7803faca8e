"""Joins and numberings that stay even when one key holds much of the data."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.storage import staged

HOT_KEYS = 256
HOT_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def hot_key_counts(df: DataFrame, key: str, limit: int = HOT_KEYS, min_rows: int = HOT_ROWS) -> dict:
    """At most ``limit`` keys that each hold at least 1/limit of the rows, with about how many.

    One pass with a mergeable frequent-items sketch: no shuffle by key, and one
    row back to the driver. A key the sketch misses costs speed, never rows.
    """
    top = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(`{key}`, {limit}, {limit * 16})").alias("items"),
    ).first()
    floor = max(min_rows, top["rows"] / limit)
    return {item["item"]: item["count"] for item in top["items"] if item["item"] is not None and item["count"] >= floor}


def hot_keys(df: DataFrame, key: str, limit: int = HOT_KEYS, min_rows: int = HOT_ROWS) -> list:
    """The keys of :func:`hot_key_counts`."""
    return list(hot_key_counts(df, key, limit, min_rows))


def hot_keys_from_counts(
    counts: DataFrame, key: str, n: str, limit: int = HOT_KEYS, min_rows: int = HOT_ROWS
) -> list:
    """The same from exact counts per key, where a dictionary has them already."""
    size = counts.agg(F.sum(n).alias("rows"), F.max(n).alias("largest")).first()
    floor = max(min_rows, (size["rows"] or 0) / limit)
    if (size["largest"] or 0) < floor:
        return []
    heavy = counts.filter(F.col(n) >= floor).orderBy(F.desc(n)).limit(limit)
    return [row[key] for row in heavy.select(key).collect()]


def skew_join(left: DataFrame, right: DataFrame, key: str, hot: list, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right``, which has one row per key.

    Rows of the ``hot`` keys never move: the matching rows of ``right``, at most
    one per hot key and so at most ``HOT_KEYS`` in all, are broadcast to them.
    All other keys are joined as usual. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    cold_rows = left.filter(~is_hot).join(right, key, how)
    hot_rows = left.filter(is_hot).join(F.broadcast(right.filter(is_hot)), key, how)
    return cold_rows.unionByName(hot_rows)


def join_small(left: DataFrame, right: DataFrame, keys: list, how: str, max_rows: int = HOT_ROWS) -> DataFrame:
    """Join to a side that is small in ordinary data: broadcast it only if its
    counted size allows, otherwise shuffle. ``right`` should be a written table.
    Texts and lists have no size of their own, so their bytes are added up too."""
    if _is_small(right, max_rows):
        right = F.broadcast(right)
    return left.join(right, keys, how)


def _is_small(df: DataFrame, max_rows: int) -> bool:
    sizes = [F.octet_length(name) for name, kind in df.dtypes if kind in ("string", "binary")]
    sizes += [F.octet_length(F.to_json(F.struct(name))) for name, kind in df.dtypes if kind.startswith(("array", "map", "struct"))]
    some = df.limit(max_rows + 1)
    if not sizes:
        return some.count() <= max_rows
    total = F.sum(sum((F.coalesce(size, F.lit(0)).cast("long") for size in sizes), F.lit(0).cast("long")))
    found = some.agg(F.count(F.lit(1)).alias("rows"), total.alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= BROADCAST_BYTES


def _placed(df: DataFrame, order: list) -> DataFrame:
    """Range-partition by ``order``, sort inside, and fix each row's place.

    ``monotonically_increasing_id`` holds the partition number in its upper bits
    and the row's place in the lower 33. The result is written to the shared
    folder, so every later branch sees the same cut whatever happens to the
    executors that made it.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_at")
    )
    return staged(placed, "placed")


def dense_numbers(df: DataFrame, order: list, name: str) -> DataFrame:
    """Number all rows 0, 1, 2, … in ``order``, which must be unique.

    Equal to ``row_number() over (order by …) - 1`` without its single
    partition: each range partition numbers its own rows and adds the size of
    the partitions before it. Only the partition sizes, one row per partition,
    meet in one task and are broadcast.
    """
    placed = _placed(df, order)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )


def numbers_in_group(df: DataFrame, group: list, order: list, name: str) -> DataFrame:
    """Number the rows of each group 0, 1, 2, … in ``order``.

    Equal to ``row_number() over (partition by group order by order) - 1``, but
    a large group is spread over range partitions and never sits in one task.
    Where a group goes on from one partition to the next, the rows it had before
    are added; at most one group per partition does, so that table is at most
    one row per partition and is broadcast.
    """
    placed = _placed(df, [*group, *order])
    within = Window.partitionBy("_part", *group).orderBy("_row")
    inside = placed.withColumn("_inside", F.row_number().over(within) - 1)

    leading = placed.filter(F.col("_row") == 0).select(*group).distinct()
    spans = (
        placed.select("_part", *group)
        .join(F.broadcast(leading), group, "left_semi")
        .groupBy("_part", *group)
        .agg(F.count(F.lit(1)).alias("_size"))
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("_start", F.sum("_size").over(before)).filter("_start > 0").drop("_size")
    return (
        inside.join(F.broadcast(carried), ["_part", *group], "left")
        .withColumn(name, F.coalesce("_start", F.lit(0)) + F.col("_inside"))
        .drop("_part", "_row", "_inside", "_start")
    )


def long_keys(df: DataFrame, key: str, max_len: int) -> DataFrame:
    """Staged (key): the keys with more than ``max_len`` rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return staged(counts.filter(F.col("_n") > max_len).select(key), "long-keys")


def in_chunks(df: DataFrame, key: str, order: list, max_len: int) -> DataFrame:
    """``df`` with ``chunk``: which ``max_len`` rows of its key, in ``order``, a row is among.

    The rows of short keys have chunk 0 and do not move; only those of longer ones are numbered.
    ``df`` is read twice, and once more where there are long keys; keys must not be null.
    """
    long, whole = long_keys(df, key, max_len), df.withColumn("chunk", F.lit(0))
    if not long.limit(1).count():
        return whole
    numbered = numbers_in_group(join_small(df, long, [key], "left_semi"), [key], order, "_place")
    cut = numbered.withColumn("chunk", F.floor(F.col("_place") / max_len).cast("int")).drop("_place")
    return join_small(whole, long, [key], "left_anti").unionByName(cut)


def chunked_lists(df: DataFrame, key: str, order: list, value: Column, name: str, max_len: int) -> DataFrame:
    """(key, chunk, name[]): the values of each key in ``order``, at most ``max_len`` to a row.

    Nearly all keys are short: they are collected in one shuffle and have the one row
    ``chunk = 0``. Their rows move before they are collected: a map task that collects parts of
    lists sorts all its rows for it, and spills them. Only the rows of longer keys are numbered, through range partitions, and
    cut, so no task and no row ever holds an unbounded list. ``order`` must be unique within
    a key, and keys not null.
    """
    placed = F.struct(*order, value.alias("_value"))
    listed = F.transform(F.array_sort(F.collect_list(placed)), lambda one: one["_value"]).alias(name)
    long = long_keys(df, key, max_len)
    if not long.limit(1).count():
        return df.repartition(key).groupBy(key).agg(listed).select(key, F.lit(0).alias("chunk"), name)
    short = join_small(df, long, [key], "left_anti").repartition(key).groupBy(key).agg(listed).select(key, F.lit(0).alias("chunk"), name)
    numbered = numbers_in_group(join_small(df, long, [key], "left_semi"), [key], order, "_place")
    chunk = F.floor(F.col("_place") / max_len).cast("int").alias("chunk")
    return short.unionByName(numbered.groupBy(key, chunk).agg(listed))
