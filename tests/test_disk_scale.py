"""What stays on disk: shuffles of tables that are written, and texts."""

import gzip
import json
import os

from pyspark.sql import functions as F

from catalog import queries, shape, views
from mixloom import storage
from mixloom.sources import split_slices


def nested(spark, tmp_path, monkeypatch, n=40):
    made = spark.range(0, n * shape.SLICE_SIZE, 100).select(F.col("id").alias("pid"), F.lit("n").alias("name"), F.lit(3).alias("num_followers"))
    made.write.parquet(str(tmp_path / "nested"))
    monkeypatch.setattr(views, "nested_playlists", lambda spark, sf_dir: spark.read.parquet(str(tmp_path / "nested")))


def test_settings_are_put_back_and_nest(spark):
    with storage.shuffles_dropped(spark):
        with storage.shuffles_dropped(spark):
            assert spark.conf.get(storage.CLEANUP) == "true"
        assert spark.conf.get(storage.CLEANUP) == "true"
    assert spark.conf.get(storage.CLEANUP, None) != "true"


def test_damaged_slices_are_written_compressed(spark, tmp_path, monkeypatch):
    nested(spark, tmp_path, monkeypatch, 6)
    path = queries._damaged_slices(spark, str(tmp_path))
    names = sorted(one for one in os.listdir(path) if one.startswith("mpd"))
    assert len(names) == 6 and all(one.endswith(".gz") for one in names)
    whole = [text for text in (gzip.open(os.path.join(path, one), "rt").read() for one in names) if text.endswith("]}\n")]
    assert sorted(len(json.loads(text)["playlists"]) for text in whole) == [10] * len(whole) and len(whole) >= 4


def test_a_large_slice_is_made_where_its_playlists_have_moved_to(spark, tmp_path, monkeypatch):
    nested(spark, tmp_path, monkeypatch)
    told, context = [], storage.shuffles_dropped
    monkeypatch.setattr(queries, "shuffles_dropped", lambda spark: told.append(1) or context(spark))
    path = queries._large_slices(spark, str(tmp_path))
    assert told == [1]
    for part in range(2):
        (name,) = [one for one in os.listdir(f"{path}/part={part}") if one.startswith("mpd")]
        lines = open(f"{path}/part={part}/{name}").read().split("\n")
        assert lines[0] == '{"info": {"version":"v1","slice":"}, [ {"}, "playlists": [' and lines[-2:] == ["]}", ""]
        assert lines[1][0] == " " and all(line[0] == "," for line in lines[2:-2])
        assert [json.loads(line[1:])["pid"] for line in lines[1:-2]] == list(range(part * 20_000, (part + 1) * 20_000, 100))


def test_texts_of_records_are_kept_small_and_their_pieces_dropped(spark, tmp_path, monkeypatch):
    folder = tmp_path / "slices"
    folder.mkdir()
    (folder / "mpd.slice.0.json").write_text(json.dumps({"playlists": [{"pid": n, "tracks": []} for n in range(300)]}))
    kept, whole = {}, storage.staged

    def staged(df, name, *rest, **more):
        kept[name] = whole(df, name, *rest, **more)
        return kept[name]

    monkeypatch.setattr(split_slices, "staged", staged)
    found = split_slices.SplitSlices(spark, str(folder), "mpd.slice.*")
    assert found.playlists().count() == 300
    assert all(file.endswith(".zstd.parquet") for file in found.records.inputFiles())
    (pieces,) = {file.rsplit("/", 1)[0].removeprefix("file://") for file in kept["range-pieces"].inputFiles()}
    assert not os.path.exists(pieces)
