"""Quality rules whose cutoffs are certified on labelled documents.

Four shares are measured for every document: symbols and capital letters among its word
characters, repeated lines among its lines, words in repeated five-word windows among its
words. ``LEVELS`` is a path of cutoffs for them, from lenient to strict; a document is
rejected at a level when one of its shares exceeds that level's cutoff, so what one level
rejects, all stricter ones reject too.

How far along the path a stratum (a language) goes is decided by its labelled good documents.
At each level ``k`` of its ``n`` good documents would be rejected, and the exact binomial tail
P(Bin(n, risk) <= k) is the p-value of "more than ``risk`` of the good ones are rejected". The
levels are tested in their fixed order up to the first that is not certified, which needs no
correction inside the path; across strata the error level is divided by their number
(Bonferroni). So with probability ``1 - error`` no stratum rejects more than ``risk`` of its
good documents. A stratum with too few labels certifies nothing and only the base rules apply.

Everything is built of DataFrame functions. A document's windows are compared inside its own
row, by 64-bit hashes; documents without a repeated window never sort theirs.

Defined results: a null or empty text has no words and fails the base rules; a null language
is a stratum of its own; a document with several labels is good if none of them says 0, and
null labels do not count; repeated rows are judged, and counted, row by row; null ids match no
label; empty tables give empty results; other columns are not read.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.operators.skew import join_small
from mixloom.storage import staged

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
CAPITALS = r"\p{Lu}"
WINDOW = 5
#: Percentages: symbols and capitals per word character, repeated lines, words in repeated windows.
LEVELS = [
    (40, 95, 90, 20),
    (30, 90, 80, 18),
    (25, 80, 70, 17),
    (20, 70, 60, 16),
    (15, 60, 50, 15),
    (12, 50, 45, 14),
    (10, 45, 40, 13),
    (8, 40, 35, 12),
]


def _removed(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` the pattern takes away."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _repeated_words(rows: DataFrame) -> DataFrame:
    """``rows`` with ``n_repeat_words``: words that a five-word window covers which the text
    holds twice or more."""
    n = F.size("w")
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))
    rows = rows.withColumn("h", F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    rows = rows.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), placed).otherwise(none))

    def repeated(x, i):
        before = F.when(i > 0, F.get("s", i - 1).getField("h") == x["h"])
        return F.coalesce(before, F.lit(False)) | F.coalesce(F.get("s", i + 1).getField("h") == x["h"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("s", repeated), lambda x: x["i"]))
    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
    covered = F.aggregate(
        starts,
        zero,
        lambda a, x: F.struct((a["words"] + x + WINDOW - F.greatest(a["end"], x)).alias("words"), (x + WINDOW).alias("end")),
        lambda a: a["words"],
    )
    return rows.withColumn("n_repeat_words", covered.cast("long")).drop("h", "s")


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_capitals) of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("stratum"), text.alias("t"))
    rows = rows.withColumns(
        {
            "w": F.filter(F.split("t", SPACE), lambda x: x != ""),
            "lines": F.filter(F.split("t", "\n"), lambda x: x.rlike(NOT_SPACE)),
        }
    )
    rows = _repeated_words(rows)
    return rows.select(
        "doc_id",
        "stratum",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _removed(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        _removed(F.col("t"), CAPITALS).cast("long").alias("n_capitals"),
    )


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` with ``base_failed`` and ``level``, the first level that rejects the document
    (the number of levels where none does)."""
    shares = [("n_symbols", "word_chars"), ("n_capitals", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words")]
    passed = []
    for k, (part, whole) in enumerate(shares):
        within = [(F.col(part) * 100 <= F.col(whole) * cutoffs[k]).cast("int") for cutoffs in LEVELS]
        passed.append(sum(within[1:], within[0]))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return rows.withColumns({"base_failed": failed, "level": F.least(*passed)})


def _log_gamma(x: Column) -> Column:
    """ln Γ(x) for x >= 1: Stirling's series eight steps up, and back."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    steps = x
    for k in range(1, 8):
        steps = steps * (x + k)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k), exact to rounding; 1 where k is not below the mean, where no
    level is ever certified. The terms are added from k downwards, each from the one before;
    those 40 standard deviations below k add nothing and are left out."""
    n, k = n.cast("double"), k.cast("double")
    log_term = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(risk) + (n - k) * math.log1p(-risk)
    terms = F.least(k, F.ceil(40 * F.sqrt(n * risk * (1 - risk))) + 100).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), terms),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct((a["term"] * (k - j) / (n - k + j + 1) * ((1 - risk) / risk)).alias("term"), (a["sum"] + a["term"]).alias("sum")),
        lambda a: a["sum"],
    )
    return F.when(k < n * risk, F.exp(log_term) * total).otherwise(1.0)


def certified_levels(rows: DataFrame, labels: DataFrame, risk: float, error: float) -> DataFrame:
    """(stratum, n_good, certified): how many levels of the path hold in each stratum that
    has labelled good documents."""
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    seen = rows.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    counts = [F.sum((F.col("level") <= j).cast("int")).alias(f"k{j}") for j in range(len(LEVELS))]
    by_stratum = seen.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *counts)
    strata = staged(by_stratum, "quality-strata")
    allowed = error / max(1, strata.count())
    p_values = F.array(*[binomial_tail(F.col("n_good"), F.col(f"k{j}"), risk) for j in range(len(LEVELS))])
    fails = F.array_position(F.transform(p_values, lambda p: p > allowed), F.lit(True)).cast("int")
    return strata.select("stratum", "n_good", F.when(fails == 0, len(LEVELS)).otherwise(fails - 1).alias("certified"))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.1) -> DataFrame:
    """The measures and verdict of every document: ``kept`` is false where a base rule fails
    or a certified level of the document's stratum rejects it."""
    rows = staged(judged(measured(docs)), "quality-measures")
    levels = certified_levels(rows, labels, risk, error)
    key, none = F.coalesce(F.concat(F.lit("="), F.col("stratum")), F.lit("")), F.lit(0)
    found = join_small(rows.withColumn("_key", key), levels.select(key.alias("_key"), "certified"), ["_key"], "left")
    kept = ~F.col("base_failed") & (F.col("level") >= F.coalesce("certified", none))
    return found.withColumn("kept", kept).drop("_key")


def rejected_dropped(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.1) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang and others) without those of ids whose every row
    is rejected. Rows with a null id stay."""
    judged_rows = quality_rules(docs, labels, risk, error).filter("doc_id is not null")
    rejected = judged_rows.groupBy("doc_id").agg(F.max("kept").alias("any")).filter("not any").select("doc_id")
    return join_small(docs, staged(rejected, "quality-rejected"), ["doc_id"], "left_anti")
