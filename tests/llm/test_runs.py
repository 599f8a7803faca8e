"""Periodic runs, against direct comparison of words."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mixloom.llm import runs as rn


def lyndon_by_suffixes(ranks):
    out = []
    for i in range(len(ranks)):
        k = i + 1
        while k < len(ranks) and ranks[k:] > ranks[i:]:
            k += 1
        out.append(k - i)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60))
def test_grouping_gives_the_lyndon_array(ranks):
    assert rn.lyndon_array([*ranks, 0])[:-1] == lyndon_by_suffixes([*ranks, 0])[:-1]


def test_borders_cut_lyndon_words():
    parts = [[1, 2, 2], [3], [1, 1, 2, 1, 2, 2], [2, 1]]
    joined = [x for part in parts for x in (*part, 0)]
    found = rn.lyndon_array(joined)
    at = 0
    for part in parts:
        assert found[at : at + len(part)] == lyndon_by_suffixes([*part, 0])[:-1]
        at += len(part) + 1


def all_runs(words, min_length, min_exponent):
    """By trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_exponent * q):
                smallest = next(p for p in range(1, q + 1) if all(words[x] == words[x + p] for x in range(i, i + length - p)))
                if smallest == q:
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out)


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(seed, n):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(0, 6)):
            part = [f"w{rng.randrange(rng.choice([2, 3, 60]))}" for _ in range(rng.randrange(1, 9))]
            words += part * rng.choice([1, 1, 2, 3, 4, 9]) + part[: rng.randrange(len(part))]
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(words))
    return texts


@pytest.mark.parametrize(("min_length", "min_exponent"), [(24, 3), (6, 3), (8, 4)])
def test_runs_equal_brute_force(min_length, min_exponent):
    for seed in range(60):
        texts = periodic_texts(seed, 8)
        runs, left = rn._runs_batch([t.encode() for t in texts], min_length, min_exponent)
        for text, found, rest in zip(texts, runs, left, strict=True):
            wanted = all_runs(text.split(), min_length, min_exponent)
            assert found == wanted
            assert rest.decode() == collapsed(text.split(), wanted)


def test_strings_rich_in_runs():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    thue = "a"
    while len(thue) < 600:
        thue += thue.translate(str.maketrans("ab", "ba"))
    for letters in (fibonacci[-1], thue, "a" * 500, "ab" * 300 + "c" * 40 + "ab" * 30):
        runs, _ = rn._runs_batch([" ".join(letters).encode()], 6, 3)
        assert runs[0] == all_runs(list(letters), 6, 3)


def test_stretches_hold_every_word_often_enough():
    words = np.array([1, 1, 1, 2, 5, 5, 5, 5, 9, 7, 7, 7])
    begin, end = rn.stretches(words, np.array([0] * 8 + [1] * 4), 3, 3)
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [(0, 3), (4, 8), (9, 12)]


@pytest.mark.parametrize("partitions", [1, 6])
def test_rows_of_every_kind(spark, partitions):
    rows = [(i, t) for i, t in enumerate(periodic_texts(5, 40))]
    rows += [(None, "x " * 30), (3, "y z " * 20), (3, "y z " * 20), (90, None), (91, ""), (92, " \t\n"), (93, "one")]
    frame = spark.createDataFrame([(*r, [1], "clash") for r in rows], "doc_id long, text string, runs array<int>, start string")
    found = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rn.periodic_runs(frame.repartition(partitions)).collect()]
    wanted = []
    for doc, text in rows:
        words = (text or "").split()
        runs = all_runs(words, 24, 3)
        wanted.append((doc, runs, collapsed(words, runs)))
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert sum(map(len, (f[1] for f in found))) > 10


def test_empty_table_long_texts_and_wrong_parameters(spark):
    assert rn.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(1, "same " * 300_000), (2, " " * 1_500_000), (3, "x" * 1_500_000), (4, "a b c " * 60_000 + "d")]
    found = {r["doc_id"]: r for r in rn.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in found[1]["runs"]] == [(0, 300_000, 1)] and found[1]["collapsed"] == "same"
    assert [tuple(r) for r in found[4]["runs"]] == [(0, 180_000, 3)] and found[4]["collapsed"] == "a b c d"
    assert found[2]["runs"] == [] and found[2]["collapsed"] == "" and len(found[3]["collapsed"]) == 1_500_000
    with pytest.raises(ValueError, match="three periods"):
        rn.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"), min_exponent=2)
