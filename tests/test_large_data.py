"""Large slices cut into ranges, lists of hot keys through salts, the id index."""

import json
import random

import pytest
from pyspark.sql import functions as F

from mixloom.functions.text import normalize_name
from mixloom.operators import colocated, frequent, quality, ranking, salted, skew, stats
from mixloom.operators.flatten import entries_of, playlists_in_file_order
from mixloom.plans import etl, tools
from mixloom.schema import slice_schema
from mixloom.sources import id_index, split_slices
from mixloom.sources.slices import read_raw_slices, read_slices
from mixloom.storage import staged
from tests.conftest import INFO, playlist

TEXTS = ['plain', 'quote " and \\ back', '}], {"playlists": [', "\\\\", 'ends in \\"', "é \U0001f600 \t", "", "[[[", '"playlists": [ {', "{"]


def written(folder, name, playlists, **layout):
    (folder / name).write_text(json.dumps({"info": INFO, "playlists": playlists}, **layout), encoding="utf-8")


def odd_playlists(seed, n, first=0):
    rng = random.Random(seed)
    lists = []
    for pid in range(first, first + n):
        one = playlist(pid, [rng.randrange(50) for _ in range(rng.randrange(0, 9))])
        one["name"], one["description"] = rng.choice(TEXTS), rng.choice(TEXTS) * rng.randrange(1, 30)
        for track in one["tracks"]:
            track["track_name"] = rng.choice(TEXTS)
        lists.append(one)
    return lists


@pytest.fixture()
def small_ranges(spark):
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


def rows_of(playlists):
    return sorted(map(str, playlists.select("seen_at", F.to_json(F.struct(*[c for c in playlists.columns if c != "seen_at"]))).collect()))


@pytest.mark.parametrize(
    ("size", "layout"),
    [(251, {}), (1200, {"indent": 2}), (1500, {"separators": (",", ":"), "ensure_ascii": False}), (1 << 27, {})],
)
def test_ranges_give_what_whole_files_give(spark, tmp_path, small_ranges, size, layout):
    written(tmp_path, "mpd.slice.0-999.json", odd_playlists(1, 12), **layout)
    written(tmp_path, "mpd.slice.1000-1999.json", odd_playlists(2, 5, 1000), **layout)
    written(tmp_path, "mpd.slice.2000-2999.json", [], **layout)
    written(tmp_path, "other.json", odd_playlists(3, 5, 5000))
    small_ranges(size)
    found = split_slices.SplitSlices(spark, str(tmp_path))
    small_ranges(1 << 27)
    assert rows_of(found.playlists()) == rows_of(playlists_in_file_order(read_slices(spark, str(tmp_path))))
    assert found.damage().count() == 0
    assert sorted(tuple(r["info"]) for r in found.info().collect()) == [tuple(INFO.values())] * 3
    if size < 1000:
        assert found.states.count() > 15


def test_roots_in_any_order_and_text_after_them(spark, tmp_path, small_ranges):
    lists = odd_playlists(4, 12)
    text = json.dumps({"other": [{"pid": 1}, [{"pid": 2}]], "playlists": lists, "note": '"playlists": [{', "info": INFO, "more": {"playlists": [{"pid": 3}]}})
    (tmp_path / "mpd.slice.0-999.json").write_text("\n" + text + "\n\n")
    small_ranges(600)
    found = split_slices.SplitSlices(spark, str(tmp_path))
    assert [r["pid"] for r in found.playlists().orderBy("seen_at").collect()] == list(range(12))
    assert [tuple(r["info"]) for r in found.info().collect()] == [tuple(INFO.values())]


@pytest.mark.parametrize("size", [400, 1 << 20])
def test_damage_is_told_with_its_offset(spark, tmp_path, small_ranges, size):
    lists = odd_playlists(5, 8)
    text = json.dumps({"info": INFO, "playlists": lists}, ensure_ascii=False).encode()
    at = [text.index(json.dumps(one, ensure_ascii=False).encode()) for one in lists]
    (tmp_path / "mpd.slice.0-999.json").write_bytes(text[: at[6] + 40])
    wrong = text.replace(b'"pid": 3,', b'"pid": "x",')
    (tmp_path / "mpd.slice.1000-1999.json").write_bytes(wrong)
    (tmp_path / "mpd.slice.2000-2999.json").write_bytes(text[:-1])
    (tmp_path / "mpd.slice.3000-3999.json").write_bytes(text[: at[2] + len(json.dumps(lists[2], ensure_ascii=False).encode())])
    small_ranges(size)
    found = split_slices.SplitSlices(spark, str(tmp_path))
    told = {(r["file"].rsplit("/", 1)[-1], r["offset"], r["problem"]) for r in found.damage().collect()}
    cut = at[2] + len(json.dumps(lists[2], ensure_ascii=False).encode())
    assert told == {
        ("mpd.slice.0-999.json", at[6], "unfinished record"),
        ("mpd.slice.0-999.json", at[6] + 40, "unbalanced file"),
        ("mpd.slice.1000-1999.json", at[3], "damaged record"),
        ("mpd.slice.2000-2999.json", len(text) - 1, "unbalanced file"),
        ("mpd.slice.3000-3999.json", cut, "unbalanced file"),
    }
    kept = found.playlists(damaged="null").groupBy("seen_at.file").count().collect()
    assert {r["file"]: r["count"] for r in kept} == {f"mpd.slice.{k}000-{k}999.json".replace("0000-0", "0-"): n for k, n in enumerate([6, 8, 8, 3])}
    with pytest.raises(ValueError, match="at byte"):
        found.playlists()
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "mpd.slice.0-999.json").write_bytes(wrong)
    with pytest.raises(Exception, match=f"damaged record at byte {at[3]} of"):
        split_slices.SplitSlices(spark, str(tmp_path / "only")).playlists().collect()


def test_fewer_fields_and_no_files(spark, tmp_path, small_ranges):
    written(tmp_path, "mpd.slice.0-999.json", odd_playlists(6, 6))
    small_ranges(400)
    narrow = slice_schema(["pid"], ["track_uri"])["playlists"].dataType.elementType
    got = split_slices.SplitSlices(spark, str(tmp_path)).playlists(narrow)
    assert got.columns == ["seen_at", "pid", "tracks"]
    assert entries_of(got).columns == ["pid", "seen_at", "ordinal", "track_uri"]
    assert split_slices.SplitSlices(spark, str(tmp_path), "none.*").playlists().count() == 0


# --- hot keys -----------------------------------------------------------------


def lists_of(df):
    return sorted((r[0], r["chunk"], list(r["values"])) for r in df.collect())


@pytest.mark.parametrize("max_len", [7, 100, 4000])
def test_salted_lists_equal_chunked_lists(spark, max_len):
    rng = random.Random(7)
    rows = [("half", n) for n in rng.sample(range(50_000), 3000)] + [("tenth", n) for n in rng.sample(range(50_000), 600)]
    rows += [(f"k{k}", n) for k in range(300) for n in range(rng.randrange(1, 14))]
    df = spark.createDataFrame(rows, "key string, value int").repartition(5)
    assert set(skew.hot_key_counts(df, "key", min_rows=500)) == {"half", "tenth"}
    mine = ranking.collect_salted(df, "key", "value", "values", max_len, min_rows=500)
    assert lists_of(mine) == lists_of(ranking.collect_chunks(df, "key", "value", "values", max_len))
    assert mine.columns == ["key", "chunk", "values"]


def test_salts_bound_what_a_task_collects(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("key"), F.col("id").alias("value")).withColumn("_value", F.col("value"))
    partial = salted.partial_lists(rows, "key", ["value"], F.create_map(F.lit(1), F.lit(20)))
    sizes = [r["n"] for r in partial.select(F.size("_list").alias("n")).collect()]
    assert len(sizes) == 20 and max(sizes) < 1200
    merged = salted.merged_ranges(partial, salted.range_bounds(partial, "key", 1000), "key").collect()
    assert max(len(r["_list"]) for r in merged) < 1500
    joined = [e["value"] for r in sorted(merged, key=lambda r: r["_range"]) for e in r["_list"]]
    assert joined == list(range(20_000))


def test_salted_lists_by_several_columns_and_of_structs(spark):
    rng = random.Random(8)
    rows = [(9, f"{rng.randrange(40):02d}", n) for n in range(2500)] + [(k, "a", 0) for k in range(9)]
    df = spark.createDataFrame(rows, "key long, word string, n int").repartition(4)
    value = F.struct("n", "word")
    mine = salted.salted_lists(df, "key", ["word", "n"], value, "values", 300, min_rows=1000)
    plain = skew.chunked_lists(df, "key", ["word", "n"], value, "values", 300)
    assert lists_of(mine) == lists_of(plain)


# --- id index -----------------------------------------------------------------


@pytest.fixture()
def corpus_of_files(tmp_path):
    folder = tmp_path / "corpus"
    folder.mkdir()
    pids = list(range(400))
    random.Random(9).shuffle(pids)
    for k in range(40):
        lists = [playlist(pid, [1, 2, 3, 4, 5]) for pid in pids[k * 10 : k * 10 + 10]]
        written(folder, f"mpd.slice.{k}.json", lists)
    return folder, {pid: f"mpd.slice.{at // 10}.json" for at, pid in enumerate(pids)}


def names(paths):
    return {p.rsplit("/", 1)[-1] for p in paths}


def test_a_lookup_opens_only_files_that_hold_an_id(spark, corpus_of_files, tmp_path):
    folder, where = corpus_of_files
    root = str(tmp_path / "index")
    id_index.build_index(spark, str(folder), root, "1")
    wanted = [7, "30-33", 399, 12345, -4]
    ids = {7, 30, 31, 32, 399}
    found = id_index.indexed_playlists(spark, root, wanted)
    assert {r["pid"] for r in found.collect()} == ids
    assert names(found.inputFiles()) == {where[pid] for pid in ids}
    shown = tools.show(spark, str(folder), wanted, index=root)
    assert names(shown.inputFiles()) == {where[pid] for pid in ids}
    assert sorted(map(tuple, shown.collect())) == sorted(map(tuple, tools.show(spark, str(folder), wanted).collect()))
    assert id_index.indexed_playlists(spark, root, [5000]).count() == tools.show(spark, str(folder), [5000], index=root).count() == 0
    assert tools.show(spark, str(folder), start="3", end="5", index=root).select("pid").distinct().count() == 2


def test_ids_are_sorted_and_filters_reach_the_scan(spark, corpus_of_files, tmp_path):
    folder, _ = corpus_of_files
    root = str(tmp_path / "index")
    id_index.build_index(spark, str(folder), root, "1")
    index = id_index.read_newest(spark, root)
    parts = index.groupBy(F.input_file_name()).agg(F.min("pid").alias("low"), F.max("pid").alias("high")).orderBy("low").collect()
    assert all(one["high"] <= two["low"] for one, two in zip(parts, parts[1:]))
    plan = index.filter("pid in (3, 4)")._jdf.queryExecution().executedPlan().toString()
    assert "In(pid, [3,4])" in plan


def test_a_refresh_reads_new_and_changed_files_alone(spark, corpus_of_files, tmp_path):
    folder, where = corpus_of_files
    root = str(tmp_path / "index")
    id_index.build_index(spark, str(folder), root, "1")
    written(folder, "mpd.slice.new.json", [playlist(1000, [1, 2, 3]), playlist(7, [1, 2, 3])])
    written(folder, where[8], [playlist(2000 + k, [1, 2, 3]) for k in range(50)])
    with pytest.raises(ValueError, match="changed since it was indexed"):
        id_index.files_with(spark, root, [8])
    (folder / where[9]).rename(tmp_path / "gone.json") if where[9] != where[8] else None
    assert names(id_index.refresh_index(spark, str(folder), root, "2")) == {"mpd.slice.new.json", where[8]}
    assert names(id_index.files_with(spark, root, [7, 2003])) == {"mpd.slice.new.json", where[7], where[8]} - ({where[7]} if where[7] in (where[8], where[9]) else set())
    assert id_index.files_with(spark, root, [8]) == []
    assert id_index.refresh_index(spark, str(folder), root, "3") == []


# --- frequent values ----------------------------------------------------------


def skewed(spark, seed, n, values):
    rng = random.Random(seed)
    rows = [(None if v == 3 else f"v{v}", k) for k, v in enumerate(min(int(rng.paretovariate(0.7)), values) for _ in range(n))]
    return spark.createDataFrame(rows, "word string, place int").repartition(6)


@pytest.mark.parametrize("capacity", [20, 100, 5000])
def test_counters_bound_true_counts(spark, capacity):
    df = skewed(spark, 10, 8000, 3000)
    true = {r["word"]: r["count"] for r in df.groupBy("word").count().collect()}
    rows = frequent.summaries(df, F.col("word"), capacity).collect()
    error = sum(r["error"] for r in rows if r["low"] is None)
    low = {}
    for r in rows:
        if r["low"] is not None:
            low[r["value"]] = low.get(r["value"], 0) + r["low"]
    assert all(low[v] <= true[v] <= low[v] + error for v in low)
    assert all(n <= error for v, n in true.items() if v not in low)
    assert len(low) <= 6 * capacity and (error == 0) == (capacity == 5000)


@pytest.mark.parametrize(("capacity", "n"), [(20, 5), (100, 10), (100, 4000), (5000, 20)])
def test_top_histogram_is_exact(spark, capacity, n):
    df = skewed(spark, 11, 8000, 3000).persist()
    mine = frequent.top_histogram(df, "word", "word", n, ["place"], capacity).collect()
    assert mine == stats.histogram(df, "word", "word", n, ["place"]).collect()
    assert [tuple(r) for r in frequent.top_histogram(df, "word", "word", n, None, capacity).collect()] == [
        tuple(r) for r in stats.histogram(df, "word", "word", n).collect()
    ]
    df.unpersist()


def test_few_values_are_shuffled_where_the_bound_tells(spark):
    df = skewed(spark, 12, 8000, 3000)
    few = frequent.candidates(df, F.col("word"), 5, 200)
    assert 5 <= few.count() < 60
    flat = spark.range(5000).select((F.col("id") % 2500).cast("string").alias("word"))
    assert frequent.candidates(flat, F.col("word"), 5, 50) is None
    assert frequent.top_histogram(flat, "word", "word", 5, None, 50).count() == 5
    assert frequent.top_histogram(flat.limit(0), "word", "word", 5).count() == 0


# --- one pass -----------------------------------------------------------------


def test_one_pass_gives_the_histograms_and_totals(spark, slice_dir):
    playlists = playlists_in_file_order(read_slices(spark, slice_dir)).persist()
    entries = entries_of(playlists)
    of_playlists, of_entries = stats.playlist_values(playlists, ["seen_at"]), stats.entry_values(entries, ["seen_at", "ordinal"])
    assert stats.totals_of(of_playlists, of_entries).collect() == stats.corpus_totals(playlists, entries).select(stats.totals_of(of_playlists, of_entries).columns).collect()
    for by_first, seen in ((True, ["seen_at"]), (False, None)):
        assert stats.histogram_of(of_playlists, "num_tracks", "num_tracks", kind="bigint", by_first=by_first).collect() == stats.length_counts(playlists, seen=seen).collect()
        mine = stats.histogram_of(of_playlists, "name", "title", None, normalize_name, by_first=by_first)
        assert mine.collect() == stats.normalized_titles(playlists, None, seen).collect()
    mine = stats.histogram_of(of_entries, "track", "track")
    assert mine.collect() == stats.track_counts(entries, seen=["seen_at", "ordinal"]).collect()
    playlists.unpersist()
    nothing = playlists.limit(0)
    assert stats.totals_of(stats.playlist_values(nothing), stats.entry_values(entries_of(nothing))).first()["playlists"] == 0


def test_errors_are_added_up_while_rows_are_written(spark, slice_dir):
    raw = read_raw_slices(spark, slice_dir, damaged="report")
    playlists = playlists_in_file_order(read_slices(spark, slice_dir))
    every = quality.all_violations(playlists, 20, raw)
    found, summary = quality.written_with_summary(every)
    assert sorted(summary.collect()) == sorted(quality.summary(found).collect())
    assert found.count() == every.count() and {r["rule"] for r in summary.collect()} <= set(quality.RULES)
    with pytest.raises(AssertionError, match="missing in RULES"):
        quality.written_with_summary(found.withColumn("rule", F.lit("new")))


# --- joins in place -----------------------------------------------------------


@pytest.mark.parametrize("hot", [False, True])
def test_joins_of_buckets_move_no_rows(spark, monkeypatch, hot):
    rng = random.Random(13)
    rows = {(rng.randrange(400), f"spotify:track:{min(int(rng.paretovariate(0.6)), 900)}") for _ in range(6000)}
    pairs = staged(spark.createDataFrame([*rows, (None, "spotify:track:1"), (3, None)], "playlist_id long, track_uri string"), "pairs")
    wanted = sorted(map(tuple, etl.build_interactions(pairs.dropna())[0].collect()))
    if hot:
        monkeypatch.setattr(colocated, "hot_keys_from_counts", lambda df, key, n: ["spotify:track:1", "spotify:track:2"] if key == "track_uri" else [])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    written = []
    plain = colocated.write_bucketed

    def watched(df, *rest):
        written.append(df)
        return plain(df, *rest)

    monkeypatch.setattr(colocated, "write_bucketed", watched)
    try:
        coded = colocated.encode_colocated(pairs, buckets=6)
        assert sorted(map(tuple, coded.collect())) == wanted
        # the pairs with track indices, as they are written by playlist, and the last join
        for joined in (written[2], coded):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Bucketed: true" in plan
            assert "Exchange" not in plan.replace("BroadcastExchange", "") if hot else "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("mixloom_")]
