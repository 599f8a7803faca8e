"""What the search of best tracks does for a pair, and how often a lane is read."""

import numpy as np
import pytest

from mixloom.operators import scoring


@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e18, 1e25])
def test_few_pairs_are_scored_in_full_and_the_lists_are_exact(monkeypatch, scale):
    full = []
    scores = scoring.BestSoFar._scores
    monkeypatch.setattr(scoring.BestSoFar, "_scores", lambda self, row, *rest: full.append(len(row)) or scores(self, row, *rest))
    random = np.random.default_rng(5)
    x = (random.random((30, 8)) * scale).astype(np.float32).astype(float)
    y = random.random((6000, 8)).astype(np.float32).astype(float)
    y[3000:4000] = y[:1000]  # ties
    norms = np.sqrt((y**2).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    own = np.array([(p, t) for p in range(30) for t in np.argsort(-(y @ x[p]))[: p % 5].tolist()], np.int64)
    best = scoring.BestSoFar(np.arange(30), x, own, 20)
    for begin in range(0, 6000, 500):
        some = order[begin : begin + 500]
        best.add(some, y[some], norms[some[0]])
    (playlists, _, tracks, *_), = best.lists()
    for p in range(30):
        mine = {t for q, t in own.tolist() if q == p}
        exact = (y @ x[p]).astype(np.float32)
        assert tracks[playlists == p].tolist() == sorted((t for t in range(6000) if t not in mine), key=lambda t: (-exact[t], t))[:20]
    assert 0 < sum(full) < 30 * 6000 / 10


def test_a_lane_is_read_once_a_block(spark, monkeypatch):
    users = spark.createDataFrame([(p, [float(p), 1.0]) for p in range(40)], "playlist_idx int, features array<float>")
    items = spark.createDataFrame([(t, [float(t % 3), float(t)]) for t in range(20)], "track_idx int, features array<float>")
    for blocks in (1, 3):
        monkeypatch.setattr(scoring, "blocks_of", lambda n, cores, blocks=blocks: blocks)
        lists = scoring.best_lists(users, items, 4)
        assert lists.rdd.getNumPartitions() == blocks
        assert lists.count() == 40
