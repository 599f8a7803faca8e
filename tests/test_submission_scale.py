"""A submission moves its rows once, and is counted list by list."""

from catalog.queries import _submission_sizes
from mixloom.operators import ranking


def test_listed_uris_are_broadcast(spark, monkeypatch):
    ranked = spark.createDataFrame([(1, 1, 7), (1, 2, 8), (2, 1, 9), (2, 2, 7), (2, 3, 8)], "playlist_idx int, rank int, track_idx int")
    tracks = spark.createDataFrame([(n, f"t{n}") for n in (7, 8, 10, 11)], "track_idx int, track_uri string")
    playlists = spark.createDataFrame([(1, 11), (2, 12), (3, 13)], "playlist_idx int, playlist_id long")
    wanted = [(11, "t7,t8"), (12, "t7"), (13, "")]
    monkeypatch.setattr(ranking, "LISTED_TRACKS", 2)  # of four tracks two are listed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = ranking.submission(ranked, tracks, playlists, 2)
        assert "Exchange hashpartitioning(track_idx" not in made._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, made.collect())) == wanted
        monkeypatch.setattr(ranking, "LISTED_TRACKS", 1)
        assert sorted(map(tuple, ranking.submission(ranked, tracks, playlists, 2).collect())) == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lists_move_as_lists_to_be_decoded(spark, monkeypatch):
    lists = spark.createDataFrame([(1, [7, 8, 9]), (2, [9, 7, 8]), (4, [7]), (5, [])], "playlist_idx int, track_idxs array<int>")
    tracks = spark.createDataFrame([(n, f"t{n}") for n in (7, 8, 10, 11)], "track_idx int, track_uri string")
    playlists = spark.createDataFrame([(1, 11), (2, 12), (3, 13), (5, 15)], "playlist_idx int, playlist_id long")
    wanted = [(11, "t7,t8"), (12, "t7"), (13, ""), (15, "")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = ranking.submission_of_lists(lists, tracks, playlists, 2)
        shown = made._jdf.queryExecution().executedPlan().toString()
        assert shown.count("Exchange hashpartitioning(playlist_idx") == 2  # the lists and the playlists
        assert shown.index("Generate posexplode") < shown.index("REPARTITION_BY_NUM")  # rows are made after the move
        assert sorted(map(tuple, made.collect())) == wanted
        monkeypatch.setattr(ranking, "LISTED_TRACKS", 1)
        assert sorted(map(tuple, ranking.submission_of_lists(lists, tracks, playlists, 2).collect())) == wanted
        nothing = lists.filter("playlist_idx > 9")
        assert {row.recommended_track_uris for row in ranking.submission_of_lists(nothing, tracks, playlists, 2).collect()} == {""}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sizes_of_lists(spark):
    rows = spark.createDataFrame([(1, "a,b,b"), (2, ""), (3, "c"), (3, "c,d")], "playlist_id long, recommended_track_uris string")
    own = spark.createDataFrame([(1, "b"), (1, "x"), (2, "a"), (3, "d"), (4, "c")], "playlist_id long, track_uri string")
    found = _submission_sizes(rows, own)
    assert "Generate explode" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(1, 3, 2, 2), (2, 0, 0, 0), (3, 3, 2, 1), (3, 3, 2, 1)]
