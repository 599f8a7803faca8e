"""The exact top n of a histogram, by a sketch first and counts of few values after.

A full histogram shuffles every distinct value. Here a first pass keeps at most ``capacity``
counters a task (Misra and Gries): when there are more, the count of the counter just beyond is
taken from all, and what has been taken is the task's error. Summaries add up: a value occurs at
least as often as its counters say, and at most by the sum of all errors more. So with

    low(v) <= count(v) <= low(v) + error

only values whose upper bound reaches the n-th largest lower bound can be among the first n. The
second pass counts those alone, and only they are shuffled. Values without a counter occur
``error`` times at most; where that reaches the n-th lower bound, as in data without frequent
values, the sketch says nothing and the full histogram is made. Results are the same either way.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.operators.skew import join_small
from mixloom.operators.stats import histogram
from mixloom.storage import staged

CAPACITY = 1 << 16  # counters of a task
SUMMARY = "value string, low long, error long"


def _merged(values: pa.Array, counts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    table = pa.table({"value": values, "n": counts}).group_by("value").aggregate([("n", "sum")])
    return table.column("value").combine_chunks(), table.column("n_sum").to_numpy()


def summaries(df: DataFrame, value: Column, capacity: int = CAPACITY) -> DataFrame:
    """(value, low, error) of every task: its counters, and one row for its error (``low`` null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, low, error = pa.array([], pa.string()), np.zeros(0, np.int64), 0
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            both = pa.chunked_array([values, seen.field("values").cast(pa.string())]).combine_chunks()
            values, low = _merged(both, np.concatenate([low, seen.field("counts").to_numpy()]))
            if len(low) > capacity:
                taken = int(np.partition(low, len(low) - capacity - 1)[len(low) - capacity - 1])
                error += taken
                kept = low > taken
                values, low = values.filter(pa.array(kept)), low[kept] - taken
        yield pa.RecordBatch.from_arrays([values, pa.array(low, pa.int64()), pa.nulls(len(low), pa.int64())], ["value", "low", "error"])
        last = [pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([error], pa.int64())]
        yield pa.RecordBatch.from_arrays(last, ["value", "low", "error"])

    return df.select(value.cast("string").alias("value")).mapInArrow(run, SUMMARY)


def candidates(df: DataFrame, value: Column, n: int, capacity: int = CAPACITY) -> DataFrame | None:
    """Staged (value): all that can be among the ``n`` most frequent, ties with the last included;
    None where the bound does not tell."""
    found = staged(summaries(df, value, capacity), "frequent-summaries")
    error = found.agg(F.sum("error")).first()[0] or 0
    lows = staged(found.filter("low is not null").groupBy("value").agg(F.sum("low").alias("low")), "frequent-values")
    last = lows.orderBy(F.desc("low")).limit(n).agg(F.min("low").alias("low"), F.count(F.lit(1)).alias("n")).first()
    floor = last["low"] if last["n"] == n else 0  # fewer values than asked for: all are wanted
    if error and error >= floor:
        return None
    return staged(lows.filter(F.col("low") + error >= floor).select("value"), "frequent-candidates")


def top_histogram(
    df: DataFrame, value, name: str = "value", n: int = 20, seen: list | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """(``name``, count) of the ``n`` most frequent values, as :func:`mixloom.operators.stats.histogram`
    gives them. ``df`` is read twice and should be a written table."""
    value = F.col(value) if isinstance(value, str) else value
    wanted = candidates(df, value, n, capacity)
    if wanted is not None:
        # a null value is one like any other, and equal to itself alone
        keyed = df.withColumn("_key", F.struct(F.coalesce(value.cast("string"), F.lit("")).alias("text"), value.isNull().alias("none")))
        keys = wanted.select(F.struct(F.coalesce("value", F.lit("")).alias("text"), F.col("value").isNull().alias("none")).alias("_key"))
        df = join_small(keyed, keys, ["_key"], "left_semi")
    return histogram(df, value, name, n, seen)
