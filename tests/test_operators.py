import collections
import random

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from mixloom.operators import cards, flatten, indexing, quality, ranking, skew, split, stats
from mixloom.sources import slices


def plain(df):
    return sorted(tuple(row) for row in df.collect())


# --- skew ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows, a third of them in group 7."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("g"),
        (F.col("id") * 7919 % 3001).alias("v"),
    )


def test_dense_numbers_equal_the_global_window(spark, skewed):
    keys = skewed.select(F.concat(F.lit("k"), "v").alias("k")).distinct()
    wanted = keys.withColumn("n", F.row_number().over(Window.orderBy("k")) - 1)
    for partitions in (1, 3, 11):
        got = skew.dense_numbers(keys.repartition(partitions), ["k"], "n")
        assert plain(got.select("k", F.col("n").cast("int"))) == plain(wanted)


def test_group_numbers_equal_the_group_window(spark, skewed):
    wanted = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v")) - 1)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        # Without coalescing, group 7 lies over several range partitions.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = skew.numbers_in_group(skewed.repartition(5), ["g"], ["v"], "n")
        assert plain(got.select("g", "v", F.col("n").cast("int"))) == plain(wanted)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_hot_keys_are_found(spark, skewed):
    assert skew.hot_keys(skewed, "g", limit=10, min_rows=1) == [7]
    assert skew.hot_keys(skewed, "g") == []
    counts = skewed.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    assert skew.hot_keys_from_counts(counts, "g", "n", 10, 1) == [7]
    assert skew.hot_keys_from_counts(counts.limit(0), "g", "n") == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_the_plain_join(spark, skewed, how):
    with_null = skewed.unionByName(spark.sql("select cast(null as int) as g, 1L as v"))
    names = spark.range(45).select(F.col("id").cast("int").alias("g"), F.concat(F.lit("n"), "id").alias("name"))
    wanted = with_null.join(names, "g", how)
    for hot in ([], [7], [7, 49, 3]):
        got = skew.skew_join(with_null, names, "g", hot, how)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))
    with pytest.raises(ValueError):
        skew.skew_join(with_null, names, "g", [], "full")


def test_join_small_beyond_its_limit(spark, skewed):
    right = spark.range(20).select(F.col("id").cast("int").alias("g"))
    wanted = plain(skewed.join(right, "g", "left_semi"))
    assert plain(skew.join_small(skewed, right, ["g"], "left_semi")) == wanted
    assert plain(skew.join_small(skewed, right, ["g"], "left_semi", max_rows=5)) == wanted


# --- dictionaries -------------------------------------------------------------


def test_dictionary_is_dense_in_key_order(spark, skewed):
    texts = skewed.select(F.concat(F.lit("spotify:track:"), "v").alias("track_uri"))
    wanted = texts.distinct().withColumn("track_idx", F.dense_rank().over(Window.orderBy("track_uri")) - 1)
    assert plain(indexing.dictionary(texts, "track_uri", "track_idx")) == plain(wanted)


def test_encode_with_and_without_hot_keys(spark, skewed, monkeypatch):
    pairs = skewed.select(
        F.col("g").cast("bigint").alias("playlist_id"), F.concat(F.lit("t"), "v").alias("track_uri")
    ).distinct()
    lists = indexing.counted_dictionary(pairs, "playlist_id", "playlist_idx")
    tracks = indexing.counted_dictionary(pairs, "track_uri", "track_idx")
    wanted = plain(
        pairs.join(lists, "playlist_id").join(tracks, "track_uri").select("playlist_idx", "track_idx", F.lit(1))
    )
    assert plain(indexing.encode_interactions(pairs, lists, tracks)) == wanted
    monkeypatch.setattr(indexing, "hot_keys_from_counts", lambda counts, key, n: [7] if key == "playlist_id" else ["t5"])
    assert plain(indexing.encode_interactions(pairs, lists, tracks)) == wanted


def test_too_many_keys_fail_loudly(spark, skewed, monkeypatch):
    monkeypatch.setattr(indexing, "LARGEST", 100)
    with pytest.raises(Exception, match="distinct values of v"):
        indexing.dictionary(skewed, "v", "i").collect()


# --- splits -------------------------------------------------------------------


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5"])
def test_split_is_disjoint_complete_and_independent_of_partitions(spark, skewed, algorithm):
    results = []
    for partitions in (1, 4, 9):
        marked = split.mark_test(skewed.repartition(partitions), ["g", "v"], 0.1, 42, algorithm)
        results.append((plain(split.train_rows(marked)), plain(split.heldout_rows(marked))))
    assert results[0] == results[1] == results[2]
    train, test = results[0]
    assert sorted(train + test) == plain(skewed)
    assert 0.07 < len(test) / 3000 < 0.13
    by_group = split.mark_test(skewed, ["g"], 0.5, 42, algorithm)
    sides = by_group.groupBy("g").agg(F.count_distinct("is_test").alias("n"))
    assert {row.n for row in sides.collect()} == {1}
    with pytest.raises(ValueError):
        split.key_hash(["g"], algorithm="crc")


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5"])
def test_a_small_share_gets_its_rows(spark, algorithm):
    rows = spark.range(50_000)
    for share, least, most in ((0.0004, 6, 40), (0.9996, 49_960, 49_994)):
        held = split.heldout_rows(split.mark_test(rows, ["id"], share, 42, algorithm)).count()
        assert least <= held <= most


def test_the_tail_share_holds_over_short_playlists(spark):
    lists = spark.range(2000).select(F.col("id").alias("pid"), F.expr("transform(sequence(1, 1 + int(id % 6)), i -> struct(string(i) as track_uri))").alias("tracks"))
    row = split.split_summary(split.hold_out_tail(lists, 0.1)).first()
    assert row.test_share == pytest.approx(0.1, abs=0.01)


def test_split_changes_with_the_seed(skewed):
    one, two = (plain(split.heldout_rows(split.mark_test(skewed, ["v"], seed=seed))) for seed in (1, 2))
    assert one != two


def test_split_summary_and_tail(spark, slice_dir):
    playlists = flatten.playlists_of(slices.read_slices(spark, slice_dir))
    tail = split.hold_out_tail(playlists, 0.4)
    held = [row.ordinal for row in tail.filter("is_test and pid = 1").collect()]
    assert sorted(held) == [3, 4]
    row = split.split_summary(tail).first()
    assert row.total_rows == tail.count() == row.train_rows + row.test_rows
    assert row.test_share == pytest.approx(row.test_rows / row.total_rows)


# --- statistics ---------------------------------------------------------------


@pytest.fixture(scope="module")
def seen_playlists(spark, slice_dir):
    return flatten.playlists_in_file_order(slices.read_slices(spark, slice_dir)).persist()


def test_totals(spark, seen_playlists):
    entries = flatten.entries_of(seen_playlists)
    row = stats.corpus_totals(seen_playlists, entries).first()
    assert (row.playlists, row.entries, row.with_description) == (14, 57, 2)
    assert (row.titles, row.tracks, row.albums, row.artists) == (13, 11, 10, 10)
    assert row.mean_length == pytest.approx(57 / 14)
    about = stats.approximate_totals(seen_playlists, entries).first()
    assert (about.titles, about.tracks, about.entries) == (13, 11, 57)
    none = stats.corpus_totals(seen_playlists.limit(0), entries.limit(0)).first()
    assert (none.playlists, none.entries, none.mean_length) == (0, 0, None)


def test_first_seen_breaks_ties_as_a_counter_does(spark):
    draw = random.Random(3)
    values = [draw.choice("abcdefgh") for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(values)), "at int, value string").repartition(6)
    for n in (3, None):
        got = [(row.value, row["count"]) for row in stats.histogram(rows, "value", n=n, seen=["at"]).collect()]
        assert got == collections.Counter(values).most_common(n)
    by_value = [(row.value, row["count"]) for row in stats.histogram(rows, "value", n=None).collect()]
    assert by_value == sorted(collections.Counter(values).items(), key=lambda one: (-one[1], one[0]))


def test_histograms_over_slices(spark, seen_playlists):
    entries = flatten.entries_of(seen_playlists, ["track_name", "artist_name"])
    top = stats.track_counts(entries, 2, seen=["seen_at", "ordinal"]).collect()
    assert [row.track for row in top] == ["Song 1 by Artist 1", "Song 2 by Artist 2"]
    assert sum(row["count"] for row in stats.track_counts(entries, None).collect()) == 57
    assert sum(row["count"] for row in stats.artist_counts(entries, None).collect()) == 57
    titles = {row.title: row["count"] for row in stats.normalized_titles(seen_playlists, None).collect()}
    assert titles["list 0"] == 2 and titles[""] == 1
    assert {row.title for row in stats.lowered_titles(seen_playlists).collect()} == set(titles)
    described = {row.description: row["count"] for row in stats.description_counts(seen_playlists).collect()}
    assert described == {"Road trip!!  2017": 1, "": 1}
    normal = {row.description for row in stats.description_counts(seen_playlists, normalized=True).collect()}
    assert normal == {"road trip 2017", ""}
    assert {row.num_edits for row in stats.edit_counts(seen_playlists).collect()} == {1, 0, None}
    assert dict(stats.length_counts(seen_playlists).collect())[9] == 1
    assert dict(stats.follower_counts(seen_playlists).collect()) == {1: 13, 0: 1}


def test_dates_may_repeat(spark):
    rows = spark.createDataFrame([(1509494400,), (1509494401,), (1509494401,)], "modified_at bigint")
    got = stats.modified_counts(rows).collect()
    assert [(row.date, row["count"]) for row in got] == [("2017-11-01", 2), ("2017-11-01", 1)]


def test_one_label_from_two_name_pairs(spark):
    rows = spark.createDataFrame([("a by b", "c"), ("a", "b by c")], "track_name string, artist_name string")
    assert plain(stats.track_counts(rows)) == [("a by b by c", 2)]


# --- data quality -------------------------------------------------------------


def errors(df):
    return collections.Counter({row.rule: row.errors for row in quality.summary(df).collect()})


def test_every_rule_is_reported(spark, slice_dir):
    playlists = flatten.playlists_of(slices.read_slices(spark, slice_dir))
    raw = slices.read_raw_slices(spark, slice_dir)
    found = errors(quality.all_violations(playlists, 15, raw))
    assert found == collections.Counter(
        {
            "empty_name": 1,
            "few_tracks": 3,
            "few_followers": 1,
            "few_edits": 1,
            "changed_late": 1,
            "few_artists": 3,
            "few_albums": 2,
            "num_albums": 1,
            "num_artists": 1,
            "num_tracks": 1,
            "duration": 1,
            "repeated_pid": 1,
            "missing_pid": 2,
            "pid_count": 1,
            "position": 2,
            "track_uri": 1,
            "track_name": 1,
            "album_name": 1,
            "extra_info_field": 1,
            "missing_info_field": 1,
            "extra_playlist_field": 1,
            "missing_playlist_field": 1,
            "extra_track_field": 1,
            "missing_track_field": 1,
        }
    )


def test_details_name_the_culprit(spark, slice_dir):
    playlists = flatten.playlists_of(slices.read_slices(spark, slice_dir))
    assert plain(quality.position_rule(playlists)) == [
        ("position", 5, 1, "1 <> 2", 1),
        ("position", 5, 2, "2 <> 1", 1),
    ]
    assert plain(quality.entry_rules(playlists)) == [("track_uri", 6, 0, "spotify:local:1", 1)]
    names = quality.name_mismatches(playlists).filter("rule = 'track_name'")
    assert plain(names) == [("track_name", 7, 3, "Song four <> Song 4", 1)]
    raw = quality.field_rules(slices.read_raw_slices(spark, slice_dir))
    got = {(row.rule, row.pid, row.pos, row.detail) for row in raw.collect()}
    assert got == {
        ("extra_info_field", None, None, "licence"),
        ("missing_info_field", None, None, "version"),
        ("extra_playlist_field", 3, None, "colour"),
        ("missing_playlist_field", 4, None, "num_edits"),
        ("extra_track_field", 6, 1, "note"),
        ("missing_track_field", 12, 4, "album_name"),
    }


def test_repeats_and_counts(spark):
    rows = spark.createDataFrame([(0,), (0,), (0,), (2,)], "pid bigint")
    assert plain(quality.repeated_pids(rows).select("pid", "errors")) == [(0, 2)]
    assert [row.pid for row in quality.missing_pids(rows, 3).collect()] == [1]
    assert quality.pid_count(rows, 2).count() == 0
    assert quality.pid_count(rows, 3).first().detail == "2 <> 3"


# --- ranking ------------------------------------------------------------------


@pytest.fixture(scope="module")
def lists(spark):
    draw = random.Random(11)
    ranked, truth = [], []
    for playlist in range(60):
        for rank, item in enumerate(draw.sample(range(40), 12), 1):
            if playlist % 7:
                ranked.append((playlist, rank, item))
        for item in draw.sample(range(40), draw.randrange(0, 9)):
            truth.append((playlist, item))
    return (
        spark.createDataFrame(ranked, "playlist_idx int, rank int, track_idx int").repartition(5).persist(),
        spark.createDataFrame(truth, "playlist_idx int, track_idx int").repartition(5).persist(),
        ranked,
        truth,
    )


@pytest.mark.parametrize("k", [1, 5, 500])
@pytest.mark.parametrize("missing", ["drop", "zero"])
def test_both_score_forms_equal_plain_python(lists, k, missing):
    ranked, truth, ranked_rows, truth_rows = lists
    predicted, actual = collections.defaultdict(list), collections.defaultdict(set)
    for playlist, rank, item in sorted(ranked_rows):
        predicted[playlist].append(item)
    for playlist, item in truth_rows:
        actual[playlist].add(item)
    wanted = {}
    for playlist, items in actual.items():
        if missing == "zero" or playlist in predicted:
            hits = [i for i, item in enumerate(predicted[playlist][:k], 1) if item in items]
            wanted[playlist] = sum(n / i for n, i in enumerate(hits, 1)) / min(len(items), k)
    for form in (ranking.scores, ranking.scores_by_array):
        got = {row.playlist_idx: row.map_score for row in form(ranked, truth, k, missing).collect()}
        assert got == pytest.approx(wanted)
    row = ranking.score_summary(ranking.scores(ranked, truth, k, missing)).first()
    assert row.num_playlists == len(wanted)
    assert row.mean_ap == pytest.approx(sum(wanted.values()) / len(wanted))
    assert (row.min_ap, row.max_ap) == pytest.approx((min(wanted.values()), max(wanted.values())))


def test_scores_agree_with_the_ranking_evaluator(lists):
    ranked, truth, _, _ = lists
    predicted = ranking.collect_ranked(ranked, "track_idx", "prediction", 5)
    relevant = truth.groupBy("playlist_idx").agg(F.collect_list("track_idx").alias("label"))
    both = predicted.join(relevant, "playlist_idx").select(
        F.col("prediction").cast("array<double>"), F.col("label").cast("array<double>")
    )
    theirs = RankingEvaluator(metricName="meanAveragePrecisionAtK", k=5).evaluate(both)
    mine = ranking.score_summary(ranking.scores(ranked, truth, 5)).first().mean_ap
    assert mine == pytest.approx(theirs)


def test_unknown_missing_mode(lists):
    with pytest.raises(ValueError):
        ranking.scores(lists[0], lists[1], 5, "maybe")


def test_seeds_are_removed_and_ranks_closed(lists):
    ranked, _, rows, _ = lists
    seeds = ranked.filter("rank in (1, 3, 4)").select("playlist_idx", "track_idx")
    got = ranking.without_seeds(ranked, seeds, 6).collect()
    by_playlist = collections.defaultdict(list)
    for row in sorted(got):
        by_playlist[row.playlist_idx].append(row.track_idx)
    for playlist, items in by_playlist.items():
        wanted = [item for p, rank, item in sorted(rows) if p == playlist and rank not in (1, 3, 4)][:6]
        assert items == wanted


def test_chunks_hold_every_value_once(spark, skewed):
    whole = skewed.distinct()
    one = ranking.collect_chunks(whole, "g", "v", "vs")
    assert {row.chunk for row in one.collect()} == {0}
    cut = ranking.collect_chunks(whole, "g", "v", "vs", max_len=50).collect()
    assert max(len(row.vs) for row in cut) == 50
    joined = collections.defaultdict(list)
    for row in sorted(cut):
        joined[row.g] += row.vs
    assert {row.g: row.vs for row in one.collect()} == joined


def test_decode_and_submission(spark, lists):
    ranked, _, rows, _ = lists
    known = [(item, f"spotify:track:{item}") for item in range(40) if item % 5]
    tracks = spark.createDataFrame(known, "track_idx int, track_uri string")
    playlists = spark.range(59).select(F.col("id").cast("int").alias("playlist_idx"), (F.col("id") + 1000).alias("playlist_id"))
    left = ranking.decode(ranked, tracks, "track_idx", "left")
    inner = ranking.decode(ranked, tracks, "track_idx", "inner", hot=[1, 2, 5])
    assert left.count() == len(rows)
    assert inner.count() == sum(1 for _, _, item in rows if item % 5)
    got = ranking.submission(ranked, tracks, playlists, 10).collect()
    # every playlist of the dictionary has a row, with an empty list where nothing was recommended
    assert sorted(row.playlist_id for row in got) == list(range(1000, 1059))
    assert len([row for row in got if row.recommended_track_uris]) == len({playlist for playlist, _, _ in rows if playlist < 59})
    for row in got:
        mine = sorted((rank, item) for playlist, rank, item in rows if playlist + 1000 == row.playlist_id)
        wanted = [f"spotify:track:{item}" for rank, item in mine if rank <= 10 and item % 5]
        assert row.recommended_track_uris == ",".join(wanted)


def test_ranked_rows(spark):
    rows = spark.sql(
        "select 4 as playlist_idx, array(struct(9 as track_idx, 0.9F as rating), struct(2 as track_idx, 0.5F as rating)) as recommendations"
    )
    assert plain(ranking.ranked_rows(rows)) == [(4, 1, 9), (4, 2, 2)]


# --- lookup and cards ---------------------------------------------------------


def text_of(df, pid):
    return [row.text for row in df.filter(F.col("pid") == pid).orderBy("line_no").collect()]


def test_cards(spark, slice_dir):
    playlists = flatten.playlists_of(slices.read_slices(spark, slice_dir))
    head = ["=== 8 ===", "List 8", "  followers 1", "  modified 2017-07-14", "  edits 1", ""]
    assert text_of(cards.compact_cards(playlists), 8) == head
    songs = [f"{place:3d} Song {place + 1} - Album {place + 1}" for place in range(5)]
    assert text_of(cards.pretty_cards(playlists), 8) == [*head, *songs, ""]
    assert text_of(cards.full_cards(playlists), 9) == [
        "===== 9 ====",
        "name:           ",
        "last_modified:  2017-11-01 00:00:01",
        "num edits:  0",
        "num followers:  0",
        "num artists:  2",
        "num albums:  2",
        "num tracks:  2",
        "",
        "     1 Song 1 - Album 1 - Artist 1",
        "     2 Song 2 - Album 2 - Artist 2",
        "",
    ]
    assert len(text_of(cards.pretty_cards(playlists), 10)) == 7
    raw = cards.raw_cards(playlists).filter("pid = 3").first()
    assert raw.json.startswith("{\n") and '"name" : "List 3"' in raw.json


def test_lookup(spark, slice_dir):
    playlists = flatten.playlists_of(slices.read_slices(spark, slice_dir)).filter("pid > 0")

    def pids(df):
        return sorted(row.pid for row in df.select("pid").collect())

    assert pids(cards.lookup_pids(playlists, [5, 7, -1, 1_000_000, 500])) == [5, 7]
    assert pids(cards.lookup_pids(playlists)) == list(range(1, 13))
    assert pids(cards.lookup_pid_range(playlists, "3", "6")) == [3, 4, 5]
    assert pids(cards.lookup_pid_range(playlists, 6, 6)) == []
    for start, end in ((6, 3), (-1, 3), (0, 1_000_001)):
        assert pids(cards.lookup_pid_range(playlists, start, end, 1_000_000)) == []
    assert pids(cards.lookup_pid_range(playlists, 3, 1_000_001)) == list(range(3, 13))
    with pytest.raises(ValueError, match="bad pid"):
        cards.lookup_pid_range(playlists, "a", 3)
