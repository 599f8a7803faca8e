"""The LSH forest, against all pairs in plain Python."""

import random

import numpy as np
import pytest

from mixloom.llm import forest as lf


def shingles(text, k):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def all_components(rows, k, percent):
    """doc_id, size and smallest document reachable, by comparing every pair."""
    sets = [shingles(text, k) for _, text in rows]
    parent = {doc: doc for doc, _ in rows if doc is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is not None and b is not None and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                one, two = sorted((root(a), root(b)))
                parent[two] = one
    out = []
    for (doc, _), s in zip(rows, sets, strict=True):
        out.append((doc, len(s), None if doc is None else root(doc) if s else doc))
    return sorted(out, key=repr)


def copies(seed, families, changes):
    """Documents, each with near copies of growing distance."""
    rng = random.Random(seed)
    rows, doc = [], 0
    for _ in range(families):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(4, 160))]
        for _ in range(rng.randrange(1, 7)):
            own = list(words)
            for _ in range(rng.randrange(changes)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(3000)}"
            rows.append((doc * 7919 % 100_003, rng.choice([" ", "\n", " \t"]).join(own)))
            doc += 1
    return rows


def components_of(spark, rows, partitions=4, k=3, percent=85, **sizes):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, rep string, at int")
    return sorted(map(tuple, lf.forest_components(frame.repartition(partitions), k, percent, **sizes).collect()), key=repr)


@pytest.mark.parametrize("partitions", [1, 7])
def test_components_equal_all_pairs(spark, partitions):
    rows = copies(1, 60, 8)
    rows += [(200_000, None), (200_001, ""), (200_002, "one"), (200_003, "ONE"), (200_004, "two words"), (200_005, "two  words"), (None, rows[0][1])]
    assert components_of(spark, rows, partitions) == all_components(rows, 3, 85)


def test_other_parameters(spark):
    rows = copies(2, 30, 12)
    assert components_of(spark, rows, 3, 5, 80) == all_components(rows, 5, 80)


def test_a_large_group_of_near_copies_and_small_blocks(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(400)]
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(150)]  # all similar to all
    rows += [(1000 + i, " ".join(w if rng.random() > 0.06 else f"x{rng.randrange(99)}" for w in base)) for i in range(40)]
    rows += [(2000 + i, rows[0][1]) for i in range(30)]
    assert components_of(spark, rows, region=6, block=16) == all_components(rows, 3, 85)


def test_rows_that_share_an_id(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(5, one), (5, two), (6, one), (4, two), (7, " ".join(f"c{i}" for i in range(50)))]
    found = {r[0]: r[2] for r in components_of(spark, rows)}
    assert found == {4: 4, 5: 4, 6: 4, 7: 7}


def test_empty_table_and_long_text(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lf.forest_components(empty).count() == 0
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(3, long), (2, long + " end"), (1, " " * 1_200_000), (0, "x" * 1_200_000)]
    assert {r[0]: r[2] for r in components_of(spark, rows, 2)} == {0: 0, 1: 1, 2: 2, 3: 2}


def test_values_agree_as_often_as_sets_do():
    rng = np.random.default_rng(4)
    common = rng.integers(0, 1 << 63, 850, np.uint64)
    agreed = []
    for _ in range(40):
        sides = [np.concatenate([common, rng.integers(0, 1 << 63, 75, np.uint64)]) for _ in range(2)]
        one, two = lf.signatures(sides, int(rng.integers(1 << 30)))
        agreed.append((one == two).mean())
    assert abs(np.mean(agreed) - 0.85) < 0.01


def test_regions_get_deeper_where_many_share_a_prefix():
    values = np.array([[1, 1, 1, 5] + [0] * 8] * 2 + [[1, 1, 1, 6] + [0] * 8] * 3 + [[2] * 12] * 5 + [[3, 0, 0] + [i] * 9 for i in range(3)], np.uint16)
    lcp = lf.common_prefixes(np.zeros(len(values), int), values)
    begin, end, wide = lf.regions(lcp, 3)
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [(0, 2)] * 2 + [(2, 5)] * 3 + [(5, 10)] * 5 + [(10, 13)] * 3
    assert wide.tolist() == [False] * 5 + [True] * 5 + [False] * 3
    one, two = lf.region_pairs(begin, end, np.flatnonzero(~wide))
    assert sorted(zip(one.tolist(), two.tolist(), strict=True)) == [(0, 1), (2, 3), (2, 4), (3, 4), (10, 11), (10, 12), (11, 12)]
