"""What the search of best tracks writes: the tracks once, however many blocks there are."""

import numpy as np
import pyarrow as pa
import pytest

from mixloom.operators import scoring


def tables(spark, playlists: int, tracks: int):
    random = np.random.default_rng(3)
    x, y = random.integers(0, 6, (playlists, 3)).astype(float), random.integers(0, 6, (tracks, 3)).astype(float)
    users = spark.createDataFrame([(k, row) for k, row in enumerate(x.tolist())], "playlist_idx int, features array<float>")
    items = spark.createDataFrame([(k, row) for k, row in enumerate(y.tolist())], "track_idx int, features array<float>")
    return users, items, x @ y.T


def test_tracks_are_shuffled_once_for_any_number_of_blocks(spark, monkeypatch):
    users, items, _ = tables(spark, 60, 300)
    for blocks in (2, 12):
        monkeypatch.setattr(scoring, "blocks_of", lambda n, cores, blocks=blocks: blocks)
        plan = scoring.best_lists(users, items, 5)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 2 and "CartesianProduct" in plan
        assert "Generate" not in plan[plan.rindex("Exchange") :]  # nothing multiplies the tracks before they are shuffled


@pytest.mark.parametrize("lane", [50, 5000])
@pytest.mark.parametrize("blocks", [1, 5])
def test_lists_are_exact_in_any_blocks_and_lanes(spark, monkeypatch, blocks, lane):
    users, items, scores = tables(spark, 23, 170)
    own = [(p, t) for p in range(23) for t in np.argsort(-scores[p])[: p % 4].tolist()]
    monkeypatch.setattr(scoring, "blocks_of", lambda n, cores: blocks)
    seeds = spark.createDataFrame(own + [(3, None), (None, 2), (99, 1)], "playlist_idx int, track_idx int")
    found = {r.playlist_idx: (r.track_idxs, r.scores) for r in scoring.best_lists(users, items, 6, seeds, lane).collect()}
    for p in range(23):
        order = sorted((t for t in range(170) if (p, t) not in own), key=lambda t: (-scores[p, t], t))[:6]
        assert found[p] == (order, [scores[p, t] for t in order])
    assert len(found) == 23


def test_rows_of_a_block_are_put_together_batch_by_batch():
    rows = [(0, 0, [1], [1.0, 2.0]), (0, 0, [2], [3.0, 4.0]), (0, 1, [1, 7], []), (0, 2, [], []), (3, 0, [5], [5.0, 6.0])]
    types = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float32())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["g", "kind", "ids", "features"])
    found = [tuple(r.values()) for part in scoring._packed(iter([batch.slice(0, 0), batch.slice(1), batch.slice(0, 2)])) for r in part.to_pylist()]
    assert found == [(0, 0, [2], [3.0, 4.0]), (0, 1, [1, 7], []), (0, 2, [], []), (3, 0, [5], [5.0, 6.0]), (0, 0, [1, 2], [1.0, 2.0, 3.0, 4.0])]
