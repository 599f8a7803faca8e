"""Ordered lists per key, where one key may hold much of the data.

Run-time skew handling covers joins, not aggregations: a key with half the rows would be collected
by one task. Hot keys, at most ``HOT_KEYS`` found by one pass of a mergeable sketch, are salted:

1. A hash of the order columns gives each row of a hot key one of as many salts as the key has
   expected lists. Each (key, salt) collects and sorts its own partial list.
2. Every ``STEP``-th entry of all partial lists is a sample. Samples in order, one of every
   ``max_len`` / ``STEP``, are where the key's order is cut into ranges.
3. Partial lists are cut at those bounds, which costs a binary search each, and the pieces of a
   range are merged k ways, as they are sorted.
4. Lengths of the ranges before give each entry its place, and so its chunk.

No task ever holds more of a key than a salt's share or a range, both of about ``max_len``
entries. All other keys are collected as usual.
"""

import heapq
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mixloom.operators.skew import HOT_KEYS, HOT_ROWS, chunked_lists, hot_key_counts, join_small
from mixloom.storage import staged

STEP = 64


def salted_lists(
    df: DataFrame, key: str, order: list, value: Column, name: str, max_len: int, limit: int = HOT_KEYS, min_rows: int = HOT_ROWS
) -> DataFrame:
    """(key, chunk, name[]): as :func:`mixloom.operators.skew.chunked_lists`, which see. Keys with
    1/``limit`` of the rows and at least ``min_rows`` are collected through salts."""
    hot = hot_key_counts(df, key, limit, min_rows)
    if not hot:
        return chunked_lists(df, key, order, value, name, max_len)
    is_hot = F.col(key).isin(list(hot))
    cold = chunked_lists(df.filter(~is_hot), key, order, value, name, max_len)
    rows = df.filter(is_hot).select(key, *order, value.alias("_value"))
    salts = F.create_map(*[F.lit(x) for pair in ((k, max(1, -(-n // max_len))) for k, n in hot.items()) for x in pair])
    partial = partial_lists(rows, key, order, salts)
    merged = staged(merged_ranges(partial, range_bounds(partial, key, max_len), key), "salted-ranges")
    return cold.unionByName(_chunks(merged, key, name, max_len))


def partial_lists(rows: DataFrame, key: str, order: list, salts: Column) -> DataFrame:
    """Staged (key, _salt, _list): the entries of each salt in order, structs of ``order`` and
    ``_value``. ``salts`` maps keys to numbers of salts."""
    salt = F.pmod(F.xxhash64(*order), salts[F.col(key)]).alias("_salt")
    entries = F.array_sort(F.collect_list(F.struct(*order, "_value"))).alias("_list")
    return staged(rows.groupBy(key, salt).agg(entries), "salted-partials")


def range_bounds(partial: DataFrame, key: str, max_len: int) -> DataFrame:
    """(key, _bounds): the entries at which a key's order is cut, in order."""
    step = max(1, min(STEP, max_len // 4))
    every = F.expr(f"transform(filter(sequence({step}, greatest(size(_list), {step}), {step}), i -> i <= size(_list)), i -> element_at(_list, cast(i as int)))")
    samples = partial.select(key, F.explode(every).alias("_sample"))
    numbered = samples.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_sample")))
    chosen = numbered.filter(F.col("_n") % max(1, max_len // step) == 0)
    return staged(chosen.groupBy(key).agg(F.array_sort(F.collect_list("_sample")).alias("_bounds")), "salted-bounds")


def merged_ranges(partial: DataFrame, bounds: DataFrame, key: str) -> DataFrame:
    """(key, _range, _list): all partial lists of a key, merged range by range."""
    kind = partial.schema["_list"].dataType
    bounded = join_small(partial.select(key, "_list"), bounds, [key], "left")
    key_type = dict(partial.dtypes)[key]
    schema = f"`{key}` {key_type}, _range int, _list {kind.simpleString()}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    fields = kind.elementType.names

    def ordered(entries: list[dict]) -> list[tuple]:
        return [tuple(entry[f] for f in fields) for entry in entries]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)

    def cut(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                owner, entries, at = (batch.column(c)[row].as_py() for c in range(3))
                places = ordered(entries)
                cuts = [0, *(bisect_left(places, bound) for bound in ordered(at or [])), len(entries)]
                pieces = zip(cuts[:-1], cuts[1:], strict=True)
                yield table([(owner, number, entries[low:high]) for number, (low, high) in enumerate(pieces) if high > low])

    def merge(group: pa.Table) -> pa.Table:
        lists = group.column("_list").to_pylist()
        joined = list(heapq.merge(*lists, key=lambda entry: tuple(entry[f] for f in fields)))
        return pa.Table.from_batches([table([(group.column(0)[0].as_py(), group.column(1)[0].as_py(), joined)])])

    return bounded.mapInArrow(cut, schema).groupBy(key, "_range").applyInArrow(merge, schema)


def _chunks(merged: DataFrame, key: str, name: str, max_len: int) -> DataFrame:
    """(key, chunk, name[]) from the ranges of each key in order."""
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = merged.select(key, "_range", F.size("_list").cast("long").alias("_n"))
    starts = staged(sizes.select(key, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "salted-starts")
    placed = join_small(merged, starts, [key, "_range"], "inner").withColumn("_n", F.size("_list"))
    cut = F.expr(
        f"explode(transform(sequence(_start div {max_len}, (_start + _n - 1) div {max_len}), c -> named_struct("
        f"'chunk', cast(c as int), 'start', _start, 'part', slice(_list, cast(greatest(c * {max_len} - _start, 0) + 1 as int), "
        f"cast(least((c + 1) * {max_len} - _start, _n) - greatest(c * {max_len} - _start, 0) as int)))))"
    )
    pieces = placed.select(key, cut.alias("_piece")).select(key, "_piece.chunk", F.struct("_piece.start", "_piece.part").alias("_piece"))
    parts = F.flatten(F.transform(F.array_sort(F.collect_list("_piece")), lambda one: one["part"]))
    return pieces.groupBy(key, "chunk").agg(F.transform(parts, lambda one: one["_value"]).alias(name))
