import json

import numpy as np
import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from mixloom.operators import ranking, scoring, split
from mixloom.plans import model, report, run, tuning
from tests.conftest import INFO, playlist


@pytest.fixture(scope="module")
def planted(spark):
    """Four groups of playlists, each with its own thirty tracks."""
    rows = [
        (playlist, track + 30 * (playlist % 4), 1)
        for playlist in range(120)
        for track in range(30)
        if (playlist * 31 + track * 17) % 10 < 6
    ]
    interactions = spark.createDataFrame(rows, "playlist_idx int, track_idx int, count int").persist()
    marked = split.mark_test(interactions, ["playlist_idx", "track_idx"], 0.2)
    train, test = split.train_rows(marked).persist(), split.heldout_rows(marked).persist()
    fitted = model.fit(train, rank=8, maxIter=5, numUserBlocks=4, numItemBlocks=4)
    return train, test, fitted


def test_input_is_cleaned(spark):
    rows = spark.createDataFrame(
        [("1", "2", "1"), ("x", "2", "1"), ("1", None, "1"), ("1", "2", "many")],
        "playlist_idx string, track_idx string, count string",
    )
    clean = model.als_input(rows)
    assert [tuple(row) for row in clean.collect()] == [(1, 2, 1.0)]
    assert dict(clean.dtypes) == {"playlist_idx": "int", "track_idx": "int", "count": "float"}
    clean.unpersist()


def test_empty_input_is_rejected(spark):
    empty = spark.createDataFrame([], "playlist_idx int, track_idx int, count int")
    with pytest.raises(ValueError):
        model.fit(empty)


def test_parameters():
    als = model.make_als()
    assert als.getImplicitPrefs() and als.getNonnegative() and als.getColdStartStrategy() == "drop"
    assert (als.getRank(), als.getMaxIter(), als.getRegParam(), als.getAlpha()) == (32, 10, 0.08, 20.0)
    assert model.make_als(rank=4).getRank() == 4


def test_model_beats_popularity(planted):
    train, test, fitted = planted
    unseen = model.recommend_unseen(fitted, train.select("playlist_idx", "track_idx"), 10)
    mine = ranking.score_summary(ranking.scores(unseen, test, 10)).first().mean_ap
    # The ten most frequent tracks that a playlist does not have.
    counts = train.groupBy("track_idx").agg(F.count(F.lit(1)).alias("n"))
    popular = ranking.first_k(counts.withColumn("one", F.lit(1)), "one", [F.desc("n"), "track_idx"], 60)
    everyone = train.select("playlist_idx").distinct().withColumn("one", F.lit(1))
    walk = everyone.join(popular, "one").select("playlist_idx", "rank", "track_idx")
    baseline = ranking.without_seeds(walk, train.select("playlist_idx", "track_idx"), 10)
    theirs = ranking.score_summary(ranking.scores(baseline, test, 10)).first().mean_ap
    assert mine > 2 * theirs


def test_lists_are_short_unique_and_fresh(planted):
    train, _, fitted = planted
    seeds = train.select("playlist_idx", "track_idx")
    got = model.recommend_unseen(fitted, seeds, 10)
    assert got.join(seeds, ["playlist_idx", "track_idx"]).count() == 0
    sizes = got.groupBy("playlist_idx").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("track_idx").alias("u"))
    assert {(row.n, row.u) for row in sizes.collect()} == {(10, 10)}


def test_few_seeds_and_many_seeds_reach_the_same_depth(planted):
    """A playlist with far more seeds than k still gets its best k unseen tracks."""
    train, _, fitted = planted
    seeds = train.select("playlist_idx", "track_idx")
    got = {(r.playlist_idx, r.rank): r.track_idx for r in model.recommend_unseen(fitted, seeds, 3).collect()}
    whole = ranking.without_seeds(model.recommend_all(fitted, 200), seeds, 3)
    assert got == {(r.playlist_idx, r.rank): r.track_idx for r in whole.collect()}


def test_subset_equals_its_part_of_all(planted):
    _, _, fitted = planted
    wanted = fitted.userFactors.select(F.col("id").alias("playlist_idx")).filter("id in (1, 5)")
    some = sorted(tuple(row) for row in model.recommend_subset(fitted, wanted, 5).collect())
    whole = model.recommend_all(fitted, 5).filter("playlist_idx in (1, 5)")
    assert some == sorted(tuple(row) for row in whole.collect())


def test_factors_solve_their_equations(planted):
    train, _, fitted = planted
    errors = [r.error for r in model.normal_equation_errors(fitted, train).collect()]
    assert len(errors) == train.select("playlist_idx").distinct().count() and max(errors) < 0.01
    other = model.normal_equation_errors(fitted, train.withColumn("track_idx", (F.col("track_idx") + 37) % 120))
    assert other.agg(F.max("error")).first()[0] > 0.2


def test_saved_versions(spark, planted, tmp_path):
    _, _, fitted = planted
    root = str(tmp_path / "models")
    model.save_version(spark, fitted, root, "20240101_000000")
    again = model.load_newest(spark, root)
    assert again.rank == 8
    assert again.itemFactors.count() == fitted.itemFactors.count()


def test_evaluate_and_submit(spark, planted, tmp_path):
    train, test, fitted = planted
    seeds = train.select("playlist_idx", "track_idx")
    with_seeds = report.evaluate(fitted, test, 10).first()
    fresh = report.evaluate(fitted, test, 10, seeds).first()
    assert fresh.num_playlists == with_seeds.num_playlists > 0
    assert fresh.mean_ap > with_seeds.mean_ap
    tracks = fitted.itemFactors.select(F.col("id").alias("track_idx"), F.concat(F.lit("spotify:track:"), "id").alias("track_uri"))
    playlists = fitted.userFactors.select(F.col("id").alias("playlist_idx"), F.col("id").cast("bigint").alias("playlist_id"))
    rows = report.submit(fitted, seeds, tracks, playlists, str(tmp_path / "s"), 10, "gzip").collect()
    assert len(rows) == 120
    assert {len(row.recommended_track_uris.split(",")) for row in rows} == {10}
    # A wanted playlist without factors or seeds has an empty row; no other is scored.
    unknown = spark.createDataFrame([(900, 900)], "playlist_idx int, playlist_id bigint")
    wanted = spark.createDataFrame([(3,), (900,), (77777,)], "playlist_id bigint")
    some = report.submit(fitted, seeds, tracks, playlists.unionByName(unknown), str(tmp_path / "w"), 10, None, wanted)
    whole = {row.playlist_id: row.recommended_track_uris for row in rows}
    assert {row.playlist_id: row.recommended_track_uris for row in some.collect()} == {3: whole[3], 900: ""}
    assert with_seeds.num_left_out == 0


def test_grid_orders_by_quality(planted):
    train, test, _ = planted
    grid = [
        {"rank": 2, "maxIter": 1, "numUserBlocks": 2, "numItemBlocks": 2},
        {"rank": 8, "maxIter": 4, "numUserBlocks": 2, "numItemBlocks": 2},
    ]
    rows = model.grid_search(train, test, grid, 10).collect()
    assert len(rows) == 2 and rows[0].mean_ap >= rows[1].mean_ap


def test_train_summary(spark, planted):
    train, _, _ = planted
    rows = model.als_input(train, 7)
    row = model.train_summary(rows, model.make_als(), "now").first()
    assert (row.timestamp, row.num_interactions, row.rank, row.num_blocks) == ("now", train.count(), 32, 7)
    rows.unpersist()
    assert (model.blocks_for(10), model.blocks_for(50_000_000)) == (16, 50)


def test_best_tracks_equal_sorted_products(spark):
    """Several blocks of both sides, ties, negative scores, own tracks, a playlist that has all."""
    rng = np.random.default_rng(2)
    users, items = rng.integers(-2, 3, (9, 3)).astype(float), rng.integers(-2, 3, (40, 3)).astype(float)
    own = {(p, int(t)) for p in range(8) for t in rng.integers(0, 40, 6)} | {(8, t) for t in range(40)}
    frames = [
        spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], f"{name} int, features array<float>")
        for matrix, name in ((users, "playlist_idx"), (items, "track_idx"))
    ]
    seeds = spark.createDataFrame([*own, (99, 1), (1, 99)], "playlist_idx int, track_idx int")
    for left_out, frame in ((own, seeds), (set(), None)):
        wanted = [
            (p, rank, t)
            for p in range(9)
            for rank, t in enumerate(sorted((t for t in range(40) if (p, t) not in left_out), key=lambda t: (-(users[p] @ items[t]), t))[:7], start=1)
        ]
        for lane in (5, 32_768):
            got = scoring.best_scored_tracks(*frames, 7, frame, lane).collect()
            assert sorted(tuple(row)[:3] for row in got) == wanted
            assert all(row.score == users[row.playlist_idx] @ items[row.track_idx] for row in got)


def test_the_bound_ends_the_search_and_keeps_lists_exact(spark):
    """Norms that fall as those of popularity do: most tracks are never scored."""
    rng = np.random.default_rng(6)
    users = rng.integers(0, 8, (50, 8)).astype(float)
    items = np.floor(rng.random((9000, 8)) * 200 / np.sqrt(1 + np.arange(9000))[:, None])
    frames = [
        spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], f"{name} int, features array<float>")
        for matrix, name in ((users, "playlist_idx"), (items, "track_idx"))
    ]
    own = {(p, int(t)) for p in range(50) for t in rng.integers(0, 300, 100)}
    seeds = spark.createDataFrame([*own], "playlist_idx int, track_idx int")
    got = {}
    for row in scoring.best_scored_tracks(*frames, 20, seeds).collect():
        got.setdefault(row.playlist_idx, []).append((row.rank, row.track_idx))
    for p in range(50):
        order = np.lexsort((np.arange(9000), -(items @ users[p])))
        wanted = [int(t) for t in order if (p, int(t)) not in own][:20]
        assert sorted(got[p]) == list(enumerate(wanted, start=1))
    shares = scoring.scored_shares(*frames, 20, seeds).collect()
    assert len(shares) == 50 and max(row.share for row in shares) < 0.5 and min(row.scored for row in shares) >= 20


def test_lists_of_no_tracks_no_playlists_and_values_that_are_no_numbers(spark):
    schema = "{} int, features array<float>"
    users = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 0.0])], schema.format("playlist_idx"))
    items = spark.createDataFrame([(5, [1.0, 1.0]), (3, [float("nan"), 1.0]), (4, [1.0, float("inf")])], schema.format("track_idx"))
    assert sorted(tuple(r) for r in scoring.best_tracks(users, items, 3).collect()) == [(1, 1, 5), (2, 1, 5)]
    assert scoring.best_tracks(users, items.limit(0), 3).count() == scoring.best_tracks(users.limit(0), items, 3).count() == 0


GRID = [{"rank": 4, "maxIter": 2}, {"rank": 8, "maxIter": 4}, {"rank": 2, "maxIter": 1}]


def test_a_grid_side_by_side_gives_the_same_figures(planted):
    train, test, _ = planted
    blocks = {"numUserBlocks": 4, "numItemBlocks": 4}
    grid = [{**one, **blocks} for one in GRID]
    one_by_one = model.grid_search(train, test, grid, 10).collect()
    together = tuning.grid_scores(train, test, grid, 10, at_once=3, leave_out_seen=False).collect()
    assert [(r.rank, r.num_playlists, round(r.mean_ap, 9)) for r in together] == [(r.rank, r.num_playlists, round(r.mean_ap, 9)) for r in one_by_one]
    fresh = tuning.grid_scores(train, test, grid, 10).first()
    assert fresh.mean_ap > one_by_one[0].mean_ap


def test_estimator_and_evaluator_work_in_a_split_of_spark_ml(planted):
    train, test, _ = planted
    ranker, evaluator = tuning.PlaylistRanker(k=10), tuning.MapAtK(10)
    grid = ParamGridBuilder().addGrid(ranker.rank, [2, 8]).addGrid(ranker.maxIter, [3]).build()
    chosen = TrainValidationSplit(estimator=ranker, estimatorParamMaps=grid, evaluator=evaluator, trainRatio=0.8, parallelism=2, seed=1).fit(train)
    assert len(chosen.validationMetrics) == 2 and chosen.bestModel.als.rank == (2, 8)[int(np.argmax(chosen.validationMetrics))]
    judged = chosen.transform(test)
    own = judged.join(train, ["playlist_idx", "track_idx"]).count()
    assert own == 0 and evaluator.evaluate(judged) > 0.2


def test_the_evaluator_agrees_with_the_ranking_evaluator(planted):
    train, test, _ = planted
    judged = tuning.PlaylistRanker(k=12, rank=4, maxIter=2).fit(train).transform(test)
    lists = judged.groupBy("playlist_idx").agg(F.array_sort(F.collect_list(F.struct("rank", "track_idx"))).alias("ranked"))
    truth = test.groupBy("playlist_idx").agg(F.collect_list(F.col("track_idx").cast("double")).alias("label"))
    arrays = lists.join(truth, "playlist_idx").select(F.transform("ranked", lambda one: one["track_idx"].cast("double")).alias("prediction"), "label")
    theirs = RankingEvaluator(metricName="meanAveragePrecisionAtK", k=12).evaluate(arrays)
    assert tuning.MapAtK(12).evaluate(judged) == pytest.approx(theirs, abs=1e-12)
    assert tuning.MapAtK(12).evaluate(judged.limit(0)) == 0.0 and tuning.MapAtK().isLargerBetter()


def test_run_all(spark, slice_dir, tmp_path):
    out = str(tmp_path / "run")
    for stamp in ("20240101_000000", "20240102_000000"):
        history = run.run_all(
            spark, slice_dir, out, stamp, k=5, test_share=0.4, rank=2, maxIter=1, numUserBlocks=2, numItemBlocks=2
        )
    rows = history.orderBy("timestamp").collect()
    assert [row.timestamp for row in rows] == ["20240101_000000", "20240102_000000"]
    assert all(row.num_playlists > 0 and row.training_time > 0 for row in rows)
    newest = run.load_run(spark, out)
    lists = run.read_submission(spark, out, "20240102_000000").collect()
    assert {row.playlist_id for row in lists} == {row.playlist_id for row in newest["playlist_indexer"].collect()}
    uris = [one for row in lists for one in row.recommended_track_uris.split(",") if one]
    assert uris and all(one.startswith("spotify:track:") for one in uris)
    assert newest["model"].rank == 2


def test_an_older_run_keeps_its_own_dictionaries(spark, tmp_path):
    """A later run over another corpus must not change how an older model decodes."""
    out = str(tmp_path / "out")
    for stamp, first in (("1", 0), ("2", 500)):
        folder = tmp_path / f"slices{stamp}"
        folder.mkdir()
        lists = [playlist(pid, [first + (pid + j) % 12 for j in range(6)]) for pid in range(10)]
        (folder / "mpd.slice.0-999.json").write_text(json.dumps({"info": INFO, "playlists": lists}))
        run.run_all(spark, str(folder), out, stamp, k=3, test_share=0.3, rank=2, maxIter=1, numUserBlocks=2, numItemBlocks=2)
    for stamp, first in (("1", 0), ("2", 500)):
        older = run.load_run(spark, out, stamp)
        ranked = model.recommend_all(older["model"], 12)
        uris = {row.track_uri for row in ranking.decode(ranked, older["track_indexer"], "track_idx", hot=[]).collect()}
        assert uris == {f"spotify:track:{n}" for n in range(first, first + 12)}
    assert run.load_run(spark, out)["track_indexer"].first().track_uri.startswith("spotify:track:5")


@pytest.mark.parametrize("lost_in", ["submit", "evaluate", "run_split"])
def test_a_run_that_is_lost_leaves_the_older_one_whole(spark, slice_dir, tmp_path, monkeypatch, lost_in):
    out, small = str(tmp_path / "run"), {"k": 5, "test_share": 0.4, "rank": 2, "maxIter": 1, "numUserBlocks": 2, "numItemBlocks": 2}
    run.run_all(spark, slice_dir, out, "1", **small)
    before = run.load_run(spark, out)
    wanted = sorted(map(tuple, before["track_indexer"].collect())), sorted(map(tuple, run.read_submission(spark, out, "1").collect()))

    def lost(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(run, lost_in, lost)
    for run_id in ("2", "1"):
        with pytest.raises(KeyboardInterrupt):
            run.run_all(spark, slice_dir, out, run_id, **small)
        newest = run.load_run(spark, out)
        assert wanted == (sorted(map(tuple, newest["track_indexer"].collect())), sorted(map(tuple, run.read_submission(spark, out, "1").collect())))
        assert newest["model"].rank == 2 and newest["interactions"].count() == before["interactions"].count()


def test_wanted_playlists_alone_are_submitted(spark, slice_dir, tmp_path):
    out = str(tmp_path / "wanted")
    wanted = spark.createDataFrame([(0,), (7,), (4321,)], "playlist_id bigint")
    run.run_all(spark, slice_dir, out, "1", k=5, test_share=0.4, wanted=wanted, rank=2, maxIter=1, numUserBlocks=2, numItemBlocks=2)
    assert {row.playlist_id for row in run.read_submission(spark, out, "1").collect()} == {0, 7}
