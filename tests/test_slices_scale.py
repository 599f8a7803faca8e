"""Slices are put together where their playlists have moved to, once, and written compressed."""

import gzip
import json
import os

from pyspark.sql import functions as F

from catalog import queries, shape, views
from mixloom.operators.skew import chunked_lists
from mixloom.sources import slices


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_playlists_move_once_into_compressed_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "SLICES_PER_TASK", 3)
    nested = spark.range(0, 10 * shape.SLICE_SIZE, 100).select(F.col("id").alias("pid"), F.concat(F.lit("n"), "id").alias("name"))
    made = views.to_slices(nested)
    assert plan(made).count("Exchange ") == 1 and "rangepartitioning(slice_no" in plan(made)
    path = str(tmp_path / "slices")
    slices.write_slices(made.drop("slice_no"), path, compression="gzip")
    names = sorted(one for one in os.listdir(path) if one.endswith(".json.gz"))
    read = [json.loads(gzip.open(os.path.join(path, one)).read()) for one in names]
    assert [one["info"]["slice"] for one in read] == [f"{n * 1000}-{n * 1000 + 999}" for n in range(10)]
    assert [p["pid"] for one in read for p in one["playlists"]] == list(range(0, 10_000, 100))
    assert slices.read_slices(spark, path).count() == 10
    first = slices.read_first_slices(spark, path, 2).select(F.explode("playlists.pid").alias("pid")).collect()
    assert sorted(row.pid for row in first) == list(range(0, 2000, 100))


def test_rows_move_before_they_are_collected(spark):
    df = spark.createDataFrame([(n % 5, n) for n in range(40)], "key int, value int")
    lists = chunked_lists(df, "key", ["value"], F.col("value"), "values", 10)
    shown = plan(lists)
    assert shown.index("partial_collect_list") < shown.index("Exchange ")
    assert sorted(map(tuple, lists.collect())) == [(k, 0, list(range(k, 40, 5))) for k in range(5)]


def test_a_large_slice_is_one_file_also_after_a_shuffled_join(spark, tmp_path, monkeypatch):
    nested = spark.range(0, 60 * shape.SLICE_SIZE, 100).select(F.col("id").alias("pid"), F.lit("n").alias("name"))
    nested.write.parquet(str(tmp_path / "nested"))
    monkeypatch.setattr(views, "nested_playlists", lambda spark, sf_dir: spark.read.parquet(str(tmp_path / "nested")))
    # no broadcast, and partitions as large inputs have them: some of the lines, one of the first and last ones
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        path = queries._large_slices(spark, str(tmp_path))
    finally:
        for name in settings:
            spark.conf.unset(name)
    for part in range(3):
        folder = os.path.join(path, f"part={part}")
        (only,) = [one for one in os.listdir(folder) if one.startswith("mpd")]
        pids = [p["pid"] for p in json.loads(open(os.path.join(folder, only)).read())["playlists"]]
        assert pids == list(range(part * 20_000, (part + 1) * 20_000, 100))


def test_slices_move_lines_and_not_lists_and_equal_the_nested_playlists(spark, tmp_path, monkeypatch):
    """Orders and parts that come twice or not at all, null keys and a long order."""
    monkeypatch.setattr(views, "SLICES_PER_TASK", 1)
    folder = str(tmp_path)
    lines = [(n % 40 + 990 if n >= 600 else 7, n % 5 + 1, n % 4, n) for n in range(900)] + [(None, 1, 1, 1), (5000, 1, 1, 1), (8, None, 1, 1), (8, 99, 1, 1)]
    day = F.expr("timestamp_ntz'1995-01-01 00:00:00'")
    lines = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int")
    lines = lines.withColumns({"l_extendedprice": F.lit(1.5), "l_shipdate": day, "l_quantity": F.col("l_linenumber").cast("double")})
    lines.unionByName(lines.filter("l_linenumber % 50 = 0")).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.createDataFrame([(key, 3) for key in [7, 7, 8, 9, *range(980, 1040)]] + [(None, 1)], "o_orderkey long, o_custkey long")
    orders = orders.withColumns({"o_orderpriority": F.lit("5-LOW"), "o_orderstatus": F.lit("O"), "o_orderdate": day})
    orders.write.parquet(f"{folder}/orders.parquet")
    parts = spark.createDataFrame([(1, "one", "b"), (2, "two", "b"), (2, "two again", "c"), (3, None, "c"), (None, "none", "d")], "p_partkey long, p_name string, p_brand string")
    parts.write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(7, "a text"), (1000, ""), (None, "x")], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")

    made = views.slices(spark, folder)
    assert not [key for key in views._staged if key[1:] == (folder, "playlists")]  # nothing nested is written or moved
    moves = [one for one in plan(made).split("\n") if "rangepartitioning(slice_no" in one]
    assert len(moves) == 1
    nested = views.nested_playlists(spark, folder)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(made) == rows(views.to_slices(nested))
    assert sum(len(row.playlists) for row in made.collect()) == nested.count() > 66
