import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from mixloom import storage
from mixloom.operators import flatten, stats
from mixloom.plans import etl, tools
from mixloom.schema import slice_schema
from mixloom.sources import sinks, slices, versions
from tests.conftest import INFO, playlist


def plain_rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_only_matching_names_are_read(spark, slice_dir):
    read = slices.read_slices(spark, slice_dir)
    assert read.count() == 2
    pids = {row.pid for row in flatten.playlists_of(read).select("pid").collect()}
    assert 99 not in pids and pids == set(range(13))


def test_first_files_in_name_order(spark, slice_dir):
    assert [os.path.basename(one) for one in slices.first_slice_paths(spark, slice_dir, 1)] == ["mpd.slice.0-999.json"]
    assert slices.read_first_slices(spark, slice_dir, 1).count() == 1
    assert slices.read_first_slices(spark, slice_dir, 11).count() == 2
    assert slices.read_first_slices(spark, slice_dir, 3, name_glob="none*").count() == 0


def test_a_narrow_schema_reads_the_same_values(spark, slice_dir):
    whole = flatten.flatten_entries(slices.read_slices(spark, slice_dir))
    schema = slice_schema(["pid"], flatten.FLAT_FIELDS)
    narrow = flatten.flatten_entries(slices.read_slices(spark, slice_dir, schema=schema))
    assert sorted(whole.collect()) == sorted(narrow.collect())
    with pytest.raises(ValueError):
        slice_schema(["nothing"])


def test_written_slices_match_the_name_pattern(spark, slice_dir, tmp_path):
    read = slices.read_slices(spark, slice_dir)
    path = str(tmp_path / "out")
    slices.write_slices(read.withColumn("number", F.col("info.slice")), path, order="number")
    again = slices.read_slices(spark, path)
    assert sorted(row.info.slice for row in again.collect()) == ["0-999", "1000-1999"]
    assert flatten.flatten_entries(again).count() == flatten.flatten_entries(read).count()


def test_null_and_empty_tracks_give_no_entry(spark, slice_dir):
    entries = flatten.entries_of(flatten.playlists_of(slices.read_slices(spark, slice_dir)))
    assert not {10, 11} & {row.pid for row in entries.select("pid").collect()}


def test_clean_and_dedup(spark, slice_dir):
    read = slices.read_slices(spark, slice_dir)
    flat, clean = flatten.flatten_entries(read), flatten.clean_entries(read)
    assert flat.count() - clean.count() == 1  # the local track
    unique = flatten.dedup_entries(clean)
    keys = unique.select("playlist_id", "track_uri")
    assert unique.count() == keys.distinct().count() == flatten.interactions_of(clean).count()
    assert unique.filter("playlist_id = 12").count() == 4
    assert {row["count"] for row in unique.collect()} == {1}


def test_dedup_keeps_the_first_in_order(spark):
    rows = spark.createDataFrame(
        [(1, "t", "late", "x", 2), (1, "t", "zz early", "y", 1), (2, "t", "b", "x", 5)],
        "playlist_id int, track_uri string, track_name string, artist_name string, at int",
    )
    got = flatten.dedup_entries(rows, ["at"]).orderBy("playlist_id").collect()
    assert [row.track_name for row in got] == ["zz early", "b"]
    assert flatten.dedup_entries(rows).orderBy("playlist_id").first().track_name == "late"


def test_slice_info(spark, slice_dir):
    got = plain_rows(stats.slice_info(slices.read_raw_slices(spark, slice_dir)))
    assert got == [
        ("generated_on", "2017-12-03"),
        ("generated_on", "2017-12-03"),
        ("licence", "open"),
        ("slice", "0-999"),
        ("slice", "1000-1999"),
        ("version", "v1"),
    ]


def test_etl_writes_a_dense_and_complete_matrix(spark, slice_dir, tmp_path):
    out = etl.run_etl(spark, slice_dir, str(tmp_path / "etl"))
    pairs = flatten.interactions_of(flatten.clean_entries(slices.read_slices(spark, slice_dir)))
    decoded = out["interactions"].join(out["playlist_indexer"], "playlist_idx").join(out["track_indexer"], "track_idx")
    assert sorted(decoded.select("playlist_id", "track_uri").collect()) == sorted(pairs.collect())
    tracks = sorted(out["track_indexer"].collect(), key=lambda row: row.track_uri)
    assert [row.track_idx for row in tracks] == list(range(len(tracks)))
    sides = etl.run_split(out["interactions"], str(tmp_path / "split"), 0.3)
    assert sides["train"].count() + sides["test"].count() == out["interactions"].count()


def rows_of(spark):
    return spark.range(40).select(
        F.col("id").alias("playlist_id"), F.lit("spotify:track:1,spotify:track:2").alias("recommended_track_uris")
    )


def test_submission_file_forms(spark, tmp_path):
    rows = rows_of(spark).repartition(4)
    schema = "playlist_id bigint, recommended_track_uris string"
    path = str(tmp_path / "plain")
    sinks.write_submission(rows, path)
    assert len([one for one in os.listdir(path) if one.endswith(".csv")]) == 4
    back = spark.read.schema(schema).option("header", True).csv(path)
    assert sorted(back.collect()) == sorted(rows.collect())
    path = str(tmp_path / "zipped")
    sinks.write_submission(rows.coalesce(1), path, compression="gzip")
    (part,) = [one for one in os.listdir(path) if one.endswith(".csv.gz")]
    with gzip.open(os.path.join(path, part), "rt") as lines:
        assert lines.readline().strip() == "playlist_id,recommended_track_uris"


def test_scratch_is_dropped_as_a_whole(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "scratch")
    monkeypatch.setattr(storage, "scratch_dir", lambda _: folder)
    kept = storage.staged(spark.range(5), "kept")
    assert kept.count() == 5 and os.path.isdir(folder)
    storage.drop_scratch(spark)
    assert not os.path.exists(folder)
    storage.drop_scratch(spark)  # nothing there is nothing to do
    assert storage.staged(spark.range(2), "again").count() == 2


def test_a_staged_table_is_dropped_alone(spark, tmp_path):
    one, two = storage.staged(spark.range(50).repartition(3, "id"), "one", drop_shuffles=True), storage.staged(spark.range(7), "two")
    assert one.count() == 50 and spark.conf.get(storage.CLEANUP) == "false"
    storage.drop_staged(one.filter("id > 3"))
    assert two.count() == 7
    with pytest.raises(Exception, match="exist"):
        one.collect()
    spark.range(3).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError, match="not a staged table"):
        storage.drop_staged(spark.read.parquet(str(tmp_path / "own")))
    assert spark.read.parquet(str(tmp_path / "own")).count() == 3


def test_versions_read_the_newest_published_run(spark, tmp_path):
    root = str(tmp_path / "versions")
    assert versions.newest_run(spark, root) is None
    versions.write_version(spark.range(3), root, "20240102_000000")
    versions.write_version(spark.range(5), root, "20240101_000000")
    assert versions.read_newest(spark, root).count() == 3
    assert versions.read_version(spark, root, "20240101_000000").count() == 5
    # Data of a lost job, complete or not, are not read.
    lost = versions.new_attempt(root, "20250101_000000")
    spark.range(9).write.parquet(f"{lost}/data")
    assert versions.read_newest(spark, root).count() == 3
    with pytest.raises(versions.NotPublished, match="no such version"):
        versions.read_version(spark, root, "20250101_000000")


def test_two_runs_with_one_id_do_not_mix(spark, tmp_path):
    root = str(tmp_path / "versions")
    one, two = versions.new_attempt(root, "1"), versions.new_attempt(root, "1")
    assert one != two
    for attempt, n in ((one, 3), (two, 7)):
        for name in ("left", "right"):
            spark.range(n).write.parquet(f"{attempt}/{name}")
    versions.publish(spark, root, "1", two, ["left", "right"])
    with pytest.raises(versions.NotPublished, match="published already"):
        versions.publish(spark, root, "1", one, ["left", "right"])
    folder = versions.folder_of(spark, root, "1")
    assert {spark.read.parquet(f"{folder}/{name}").count() for name in ("left", "right")} == {7}
    (row,) = versions.published(spark, root).collect()
    assert {(t["name"], t["rows"]) for t in row["tables"]} == {("left", 7), ("right", 7)}


def test_an_incomplete_attempt_is_not_published(spark, tmp_path):
    root = str(tmp_path / "versions")
    versions.write_version(spark.range(2), root, "1")
    attempt = versions.new_attempt(root, "2")
    spark.range(4).write.parquet(f"{attempt}/left")
    with pytest.raises(versions.NotPublished, match="not complete"):
        versions.publish(spark, root, "2", attempt, ["left", "right"])
    assert versions.newest_run(spark, root) == "1"
    with pytest.raises(ValueError):
        versions.new_attempt(root, "a/b")


def test_run_metrics_grow_by_one_row(spark, tmp_path):
    path = str(tmp_path / "metrics")
    metrics = spark.sql("select 0.25D as mean_ap, 7L as num_playlists, 0.1D as std_dev")
    for stamp in ("a", "b"):
        sinks.append_run_metrics(metrics, path, stamp, 3)
    back = spark.read.schema(sinks.METRICS_SCHEMA).option("header", True).csv(path)
    assert sorted(tuple(row) for row in back.collect()) == [("a", 0.25, 7, 3.0), ("b", 0.25, 7, 3.0)]


def test_intermediate_tables_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = storage.shared_dir(spark)
    if named is not None:
        assert folder == named
    assert spark.sparkContext.getCheckpointDir() is not None
    assert storage.scratch_path(spark, "x") != storage.scratch_path(spark, "x")
    assert storage.scratch_path(spark, "x").startswith(storage.scratch_dir(spark) + "/")


@pytest.fixture(scope="module")
def damaged_dir(tmp_path_factory):
    """A good slice, one with values of other types, and one that ends too early."""
    folder = tmp_path_factory.mktemp("damaged")
    wrong = {**playlist(2, [1, 2, 3]), "num_followers": "many"}
    nameless = {**playlist(3, [1, 2, 3]), "pid": "one", "num_edits": 1.5}
    misplaced = playlist(4, [1, 2, 3])
    misplaced["tracks"][1]["pos"] = "second"
    for number, lists in enumerate(([playlist(0, [1]), playlist(1, [2])], [wrong, nameless, misplaced, {**playlist(5, [1]), "tracks": "none"}], [playlist(6, [1])])):
        text = json.dumps({"info": INFO, "playlists": lists})
        (folder / f"mpd.slice.{number}.json").write_text(text[: len(text) // 2] if number == 2 else text)
    return str(folder)


def test_damaged_slices_stop_the_job_with_their_name(spark, damaged_dir):
    with pytest.raises(Exception, match=r"mpd\.slice\.[12]\.json"):
        flatten.flatten_entries(slices.read_slices(spark, damaged_dir)).collect()
    with pytest.raises(Exception, match=r"mpd\.slice\.2\.json"):
        slices.read_raw_slices(spark, damaged_dir).collect()
    with pytest.raises(ValueError, match="damaged"):
        slices.read_slices(spark, damaged_dir, damaged="ignore")
    assert slices.read_slices(spark, damaged_dir, damaged="null").count() == 3


def test_check_reports_damage_and_goes_on(spark, damaged_dir):
    found = tools.check(spark, damaged_dir, 7)["violations"]
    rows = {(r.rule, r.pid, r.pos, r.detail) for r in found.filter("rule in ('unreadable_slice', 'wrong_type')").collect()}
    assert rows == {
        ("unreadable_slice", None, None, "mpd.slice.2.json"), ("wrong_type", 2, None, "num_followers"), ("wrong_type", None, None, "pid"),
        ("wrong_type", None, None, "num_edits"), ("wrong_type", 4, 1, "pos"), ("wrong_type", 5, None, "tracks"),
    }
    assert {r.pid for r in found.filter("rule = 'missing_pid'").collect()} == {3, 6}
    assert found.filter("rule = 'repeated_pid'").count() == 0


def test_file_names_follow_the_order_past_a_thousand(spark, tmp_path):
    many = spark.range(2500).select(F.col("id").alias("slice_no"), F.struct(F.col("id").cast("string").alias("slice")).alias("info"))
    path = str(tmp_path / "many")
    slices.write_slices(many.repartition(1), path, order="slice_no")
    names = sorted(one for one in os.listdir(path) if one.endswith(".json"))
    numbers = [int(json.loads(open(os.path.join(path, one)).read())["info"]["slice"]) for one in names]
    assert numbers == list(range(2500))
