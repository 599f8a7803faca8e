"""Substring dedup and the n-gram join, against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mixloom.llm import components as cc
from mixloom.llm import ngram_join as nj
from mixloom.llm import substring as sub


def kept_words(rows, k):
    """Brute force: (doc_id, n_words, kept words) per row."""
    holders: dict = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - k + 1):
            if doc is not None:
                key = tuple(words[i : i + k])
                holders[key] = min(holders.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - k + 1):
            if doc is not None and holders[tuple(words[i : i + k])] < doc:
                gone |= set(range(i, i + k))
        out.append((doc, len(words), b" ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def passages(seed, docs, k):
    rng = random.Random(seed)
    shared = [" ".join(f"s{rng.randrange(6)}" for _ in range(rng.randrange(k - 2, 3 * k))) for _ in range(12)]
    rows = []
    for doc in range(docs):
        parts = [rng.choice(shared) if rng.random() < 0.6 else " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 25))) for _ in range(rng.randrange(0, 6))]
        rows.append((doc * 3 % (2 * docs), rng.choice([" ", "\n", "\t\x0b "]).join(parts)))
    return rows


def digests(spark, rows, k, partitions):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, block string, n_words int")
    found = sub.repeat_digests(frame.repartition(partitions), k).collect()
    return sorted((repr(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found)


@pytest.mark.parametrize(("seed", "k", "partitions"), [(1, 13, 5), (2, 13, 1), (3, 4, 3)])
def test_substrings_against_brute_force(spark, seed, k, partitions):
    rows = passages(seed, 80, k) + [(None, "s1 " * 40), (5, None), (6, ""), (7, "s1 " * 40), (7, "s1 " * 40), (900, "s1 " * 40), (901, "é é " * 20), (902, "é é " * 20)]
    wanted = [(repr(d), n, n - len(w.split(b" ")) if w else n, hashlib.sha256(w).hexdigest()) for d, n, w in kept_words(rows, k)]
    assert digests(spark, rows, k, partitions) == sorted(wanted)


def test_a_passage_in_most_documents_and_a_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} {passage} b{i}") for i in range(400)] + [(1000, " ".join(f"long{i % 5000}" for i in range(60_000)))]
    found = {r[0]: r[2] for r in digests(spark, rows, 13, 4)}
    assert found["0"] == 0 and all(found[str(i)] == 60 for i in range(1, 400)) and found["1000"] == 0


def test_remove_repeats_keeps_the_rest(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(1, f"keep\tas  it is {passage}", "en", 1.5, [1]), (2, f"x {passage} y", None, None, None), (3, None, "de", 2.0, []), (None, passage, "fr", 0.0, [2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, payload string, number double, list array<int>")
    left = {r["doc_id"]: r for r in sub.remove_repeats(docs).collect()}
    assert left[1]["text"] == rows[0][1] and left[2]["text"] == "x y" and left[3]["text"] is None and left[None]["text"] == passage
    assert (left[1]["payload"], left[1]["number"], left[1]["list"]) == ("en", 1.5, [1])
    assert sub.remove_repeats(docs).schema == docs.schema
    assert sub.remove_repeats(docs.limit(0)).collect() == []


def test_a_wrong_source_stops_the_job():
    class Fake:
        words = type("W", (), {"ids": np.zeros(20)})
        valid = np.ones(8, bool)

        def digest(self, start, windows):
            return b"own"

    with pytest.raises(ValueError, match="source"):
        sub._removed(Fake(), [{"start": 0, "windows": 2, "source_doc": 1, "digest": b"other"}], 13)


def shingles(text, n=5):
    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    words = (text or "").encode().translate(low).split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((d, len(s), root(d)) for (d, _), s in zip(rows, sets, strict=True))


def near_copies(seed, base_words, copies, changes, first=0):
    rng = random.Random(seed)
    base = [f"{seed}v{rng.randrange(3000)}" for _ in range(base_words)]
    rows = []
    for c in range(copies):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((first + c, " ".join(words).title() if c % 5 == 0 else " ".join(words)))
    return rows


def joined(spark, rows, partitions=4):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, rep string")
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nj.ngram_components(frame.repartition(partitions)).collect())


def test_join_against_brute_force(spark):
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One  TWO"), (4, "one two three"), (5, " "), (6, "a b c d e"), (7, "A b c d e"), (8, "a b c d e f")]
    for size in (6, 9, 10, 14, 25, 60, 200):
        rows += near_copies(size, size, 12, max(1, size // 30), first=1000 * size)
    rng = random.Random(5)
    rows += [(9000 + i, " ".join(f"z{rng.randrange(4)}" for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    assert joined(spark, rows) == brute_components(rows)


def test_a_large_star(spark):
    """Many near copies, few of them similar to the first: the star alone does not join them."""
    rows = near_copies(77, 150, 150, 9, first=10) + near_copies(77, 150, 40, 3, first=400)
    wanted = brute_components(rows)
    assert len({c for _, _, c in wanted}) > 3
    assert joined(spark, rows) == wanted


def test_rows_without_an_id_and_with_one_twice(spark):
    text = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"o{i}" for i in range(30))
    rows = [(5, text), (5, other), (7, text), (8, other), (None, text), (None, None)]
    found = joined(spark, [r for r in rows if r[0] is not None])
    assert [r[2] for r in found] == [5, 5, 5, 5]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    null = sorted((r["n_shingles"], r["component_id"]) for r in nj.ngram_components(frame).filter("doc_id is null").collect())
    assert null == [(0, None), (26, None)]
    assert nj.ngram_components(frame.limit(0)).collect() == []
    left = sorted((r["doc_id"] or 0, r["text"] or "") for r in nj.near_duplicates_dropped(frame).collect())
    assert left == sorted([(0, text), (0, ""), (5, text), (5, other)])


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 2**32), st.booleans())
def test_similar_sets_share_a_key(size, seed, shrink):
    """The pigeonhole holds at the very edge of the similarity."""
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
    similar = nj.Similarity(80)
    if shrink:
        y = x[rng.permutation(len(x))[: similar.smallest_partner(len(x))]]
    else:
        change = next(c for c in range(len(x), -1, -1) if similar.holds(len(x) - c, 2 * len(x)))
        y = np.concatenate([x[rng.permutation(len(x))[change:]], rng.integers(0, 2**63, change, dtype=np.uint64)])
    y = np.unique(y)
    assert similar.holds(len(np.intersect1d(x, y)), len(x) + len(y))
    large, small = (x, y) if len(x) >= len(y) else (y, x)
    signatures = nj.Signatures(80)
    keys, uncovered = signatures.probe(large)
    assert nj.band_of(len(small))[0] in uncovered or len(np.intersect1d(keys, signatures.index(small)))
    assert nj.sketch_distance(nj.odd_sketch(x).tobytes(), nj.odd_sketch(y).tobytes()) <= len(np.setxor1d(x, y)) <= similar.most_different(len(x) + len(y))


def test_allocation_reaches_its_units():
    assert nj.allocation((3, 2, 0), 3, True) is not None
    assert nj.allocation((9, 0, 0), 3, True) is None
    for sizes in ((5, 3, 2, 1), (4, 4, 0, 0), (8, 1, 1, 0)):
        chosen = nj.allocation(sizes, 3, True)
        assert sum(v + 1 for v in chosen) >= 3 and all(size or v < 0 for size, v in zip(sizes, chosen, strict=True))


def test_a_partner_without_the_only_shingle_of_a_segment():
    """12 shared shingles of 15 in all, the rest in the largest segment and the single one's."""
    assert nj.allocation((13, 1, 0, 0, 0), 4, True) is None
    low, high = nj.band_of(13)
    numbers = np.random.default_rng(3).integers(0, 2**63, 5000, dtype=np.uint64)
    segment = nj.mix(numbers) % np.uint64(nj.segments_of(low, high, 80))
    many, single = numbers[segment == 0][:14], numbers[segment == 1][:1]
    large, small = np.unique(np.concatenate([many[:13], single])), np.unique(many[1:])
    assert nj.Similarity(80).holds(len(np.intersect1d(large, small)), len(large) + len(small))
    signatures = nj.Signatures(80)
    keys, uncovered = signatures.probe(large)
    assert low in uncovered or len(np.intersect1d(keys, signatures.index(small)))


class Uncovering(nj.Signatures):
    """Says of every third set that its segments cover none of its bands."""

    def probe(self, shingles):
        keys, uncovered = super().probe(shingles)
        if int(shingles[0]) % 3:
            return keys, uncovered
        low, high = nj.band_of(self.similar.smallest_partner(len(shingles)))
        bands = []
        while low <= len(shingles):
            bands.append(low)
            low, high = nj.band_of(high + 1)
        return keys[:0], bands


def test_uncovered_sets_meet_their_band(spark):
    rows = [row for size in (6, 20, 90) for row in near_copies(size, size, 15, max(1, size // 20), first=1000 * size)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = nj.ngram_components(frame.repartition(3), keys=Uncovering).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(rows)


def test_no_keys_meet():
    none = np.array([], np.int64)
    assert [len(c) for c in nj._meet(none, none, none, none)] == [0, 0, 0]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, j) for j in range(501, 540)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    label: dict = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    wanted = {n: v for n, v in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    rng.shuffle(edges)
    got = cc.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == wanted
    assert cc.components(spark.createDataFrame([], "a long, b long")).collect() == []
