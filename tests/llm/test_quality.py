"""Certified quality rules, against plain Python."""

import re
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from mixloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", "  \n\t ", "one", "a b c d e f g h i j", "a b c d e a b c d e", "x " * 40, "line one\nline one\n\nline two\nline one\n \n",
    "#tag $5 & <b> | % *", "a b éÉ \x85 x\x0by\x0cz\rw", "aa bb cc dd ee ff aa bb cc dd ee gg aa bb cc dd ee", "a b a b a b a b a b a b a b",
    "SHOUT!! AT!! ALL!! OF!! YOU!! FOR!! AS!! LONG!! AS!! IT!! TAKES!!", "q" * 5000, " ".join(str(i % 700) for i in range(3000)),
]


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows: dict = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
    }


def frame(spark, texts=TEXTS):
    rows = [(k, t, "en" if k % 2 else None, "clash", 7) for k, t in enumerate(texts)] + [(None, "no id", "en", "x", 1), (1, "", "en", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, w string, level int")


def test_measures(spark):
    rows = quality.judged(quality.measured(frame(spark))).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        wanted = measures("no id" if row["doc_id"] is None else TEXTS[row["doc_id"]])
        assert {name: row[name] for name in wanted} == wanted, row["doc_id"]
        assert row["base_failed"] == (wanted["n_words"] < 10 or 100 * wanted["n_repeat_words"] > 20 * wanted["n_words"])


@pytest.mark.parametrize(("n", "k", "risk"), [(10, 0, 0.3), (50, 3, 0.2), (400, 1, 0.02), (1000, 15, 0.02), (5, 5, 0.5), (1, 0, 0.02)])
def test_binomial_tail(spark, n, k, risk):
    got = spark.range(1).select(quality.binomial_tail(F.lit(n), F.lit(k), risk).alias("p")).first()["p"]
    r = Fraction(risk)
    exact = float(sum(comb(n, i) * r**i * (1 - r) ** (n - i) for i in range(k + 1))) if k < n * risk else 1.0
    assert got == pytest.approx(exact, rel=1e-8)


def test_large_tail(spark):
    row = spark.range(1).select(quality.binomial_tail(F.lit(10_000_000), F.lit(199_000), 0.02).alias("p")).first()
    assert row["p"] == pytest.approx(0.01197, rel=0.02)  # the normal value at z = -2.259


def corpus(spark, bad_among_good):
    """300 labelled good documents, the first of them with capitals only, and 50 unlabelled."""
    plain, loud = " ".join(f"word{i}" for i in range(30)), " ".join(f"LOUD{chr(65 + i)}" for i in range(25))
    rows = [(i, loud if i < bad_among_good or i >= 300 else plain, "en") for i in range(350)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(999, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_levels_are_certified_or_not(spark):
    docs, labels = corpus(spark, 0)
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs, labels).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 350))
    docs, labels = corpus(spark, 20)  # more than the risk among the good: nothing is certified
    assert all(r["kept"] for r in quality.quality_rules(docs, labels).collect())


def test_conflicting_labels_and_few_labels(spark):
    docs, labels = corpus(spark, 0)
    spoiled = labels.unionByName(labels.withColumn("quality", F.lit(0)))
    assert all(r["kept"] for r in quality.quality_rules(docs, spoiled).collect())
    assert all(r["kept"] for r in quality.quality_rules(docs, labels.limit(20)).collect())
    assert quality.quality_rules(docs.limit(0), labels).collect() == []
    assert all(r["kept"] for r in quality.quality_rules(docs, labels.limit(0)).collect())


def test_null_stratum_is_one(spark):
    docs, labels = corpus(spark, 0)
    docs = docs.withColumn("lang", F.lit(None).cast("string"))
    assert not any(r["kept"] for r in quality.quality_rules(docs, labels).filter("doc_id >= 300").collect())


def test_rejected_rows_go(spark):
    docs, labels = corpus(spark, 0)
    docs = docs.unionByName(spark.createDataFrame([(None, "", "en"), (301, "a b c d e f g h i j k l", "en")], docs.schema)).withColumn("kept", F.lit("clash"))
    left = quality.rejected_dropped(docs, labels)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted([*range(300), 301, 301]) and None in ids
