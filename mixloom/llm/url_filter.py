"""URL verdicts: fixed rules first, a ratio of character language models for the rest.

Two smoothed variable-order Markov models over the characters of a URL, one of the URLs
that the rules accept and one of those they reject. The probability of a character after
its context of up to ``order`` characters is interpolated (Witten-Bell) from the longest
context the model has seen down to a uniform start. A URL's score is the difference of its
two log-likelihoods divided by its characters; it is accepted at the calibrated cutoff and
above.

Training takes at most ``max_per_class`` distinct URLs of each class, those with the
smallest hashes outside the calibration fold and of at most ``max_chars``
characters; that bounds the models, which go to the executors. Every URL is scored whole;
scores, the calibration (all rule-judged URLs of the fold) and verdicts cover every row.
The cutoff is the one with the highest sum of the two classes' rates of right
verdicts over a fixed grid of scores; of equal ones, the lowest.

Defined results: a null url, or one without ``://``, has an empty host and path and no
rule; with no rule the model judges what there is, and an empty url scores 0. Where one
class has no URL to learn from, all scores are 0 and the cutoff is 0, so that URLs without
a rule are allowed. Repeated rows and null ids give a row each; other columns are not read.
"""

import math
import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.storage import staged

#: (verdict, host, path)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
FOLDS = 5
GRID = 100  # steps of the cutoff for one unit of score
REACH = 20  # scores beyond plus or minus this count as this
REMEMBERED = 200_000


def split_url(rows: DataFrame) -> DataFrame:
    """``rows`` with the host and path of the column ``url``, both empty without ``://``."""
    has, rest = F.expr("instr(url, '://') > 0"), F.expr("substr(url, instr(url, '://') + 3)")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return rows.withColumns({"host": F.when(has, host).otherwise(""), "path": F.when(has, path).otherwise("")})


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, url, host, path, rule, rule_verdict); both last are null where no rule fits."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    rows = split_url(rows)
    best = sorted(rules, key=lambda r: len(r[1] + r[2]), reverse=True)
    rule = verdict = F.lit(None).cast("string")
    for says, host, path in reversed(best):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rows.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"))


def _in_fold() -> Column:
    return F.pmod(F.xxhash64("url", F.lit("calibration")), F.lit(FOLDS)) == 0


def training_urls(judged: DataFrame, max_per_class: int, max_chars: int) -> DataFrame:
    """At most ``max_per_class`` distinct URLs of each class, of the smallest hashes, of at most
    ``max_chars`` characters; dealt out again, as the cut leaves them in one partition."""
    usable = (F.col("url") != "") & (F.char_length("url") <= max_chars)
    labelled = judged.filter(F.col("rule_verdict").isNotNull() & usable & ~_in_fold())
    distinct = labelled.select("url", "rule_verdict").distinct()
    by_hash = [F.xxhash64("url", F.lit("training")), F.col("url")]
    classes = [distinct.filter(F.col("rule_verdict") == c).orderBy(*by_hash).limit(max_per_class) for c in ("allow", "block")]
    return classes[0].unionByName(classes[1]).repartition("url")


def gram_counts(urls: DataFrame, order: int) -> DataFrame:
    """(rule_verdict, gram, n): each run of 1 to ``order`` + 1 characters, the last one
    following the others; a URL is led in by ``order`` marks that no URL holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for url, verdict in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = "\n" * order + url
                for at in range(order, len(text)):
                    for back in range(order + 1):
                        found[verdict, text[at - back : at + 1]] += 1
        keys = list(found)
        columns = [[k[0] for k in keys], [k[1] for k in keys], list(found.values())]
        types = [pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["rule_verdict", "gram", "n"])

    counted = urls.mapInArrow(run, "rule_verdict string, gram string, n long")
    return counted.groupBy("rule_verdict", "gram").agg(F.sum("n").alias("n"))


class MarkovModel:
    """Interpolated probabilities from gram counts; unseen contexts are passed over."""

    def __init__(self, counts: dict[str, int], alphabet: int):
        self.counts, self.start = counts, 1.0 / (alphabet + 1)
        self.after: dict[str, list[int]] = {}
        for gram, n in counts.items():
            seen = self.after.setdefault(gram[:-1], [0, 0])
            seen[0] += n
            seen[1] += 1

    def log_probability(self, gram: str) -> float:
        p = self.start
        for back in range(len(gram)):
            tail = gram[len(gram) - 1 - back :]
            seen = self.after.get(tail[:-1])
            if seen is None:
                break
            p = (self.counts.get(tail, 0) + seen[1] * p) / (seen[0] + seen[1])
        return math.log(p)


class RatioScorer:
    """Length-normalised log-likelihood difference of the accepted and rejected models."""

    def __init__(self, allow: dict[str, int], block: dict[str, int], order: int):
        self.order, self.known = order, bool(allow and block)
        alphabet = len({g for g in [*allow, *block] if len(g) == 1})
        self.models = MarkovModel(allow, alphabet), MarkovModel(block, alphabet)
        self.kept: dict[str, float] = {}

    def _difference(self, gram: str) -> float:
        got = self.kept.get(gram)
        if got is None:
            got = self.models[0].log_probability(gram) - self.models[1].log_probability(gram)
            if len(self.kept) >= REMEMBERED:
                self.kept.clear()
            self.kept[gram] = got
        return got

    def score(self, url: str) -> float:
        if not self.known or not url:
            return 0.0
        text, order = "\n" * self.order + url, self.order
        return math.fsum(self._difference(text[at : at + order + 1]) for at in range(len(url))) / len(url)


def learn(judged: DataFrame, order: int, max_per_class: int, max_chars: int) -> dict[str, dict[str, int]]:
    """Gram counts by class: at most 2 * ``max_per_class`` * ``max_chars`` * (``order`` + 1)."""
    found: dict[str, dict[str, int]] = {"allow": {}, "block": {}}
    for row in gram_counts(training_urls(judged, max_per_class, max_chars), order).toLocalIterator():
        found[row["rule_verdict"]][row["gram"]] = row["n"]
    return found


def calibrated_cutoff(scored: DataFrame) -> float:
    """The cutoff that judges the rule-judged URLs of the calibration fold best."""
    step = F.floor(F.greatest(F.least(F.col("score"), F.lit(REACH)), F.lit(-REACH)) * GRID)
    fold = scored.filter(F.col("rule_verdict").isNotNull() & (F.col("url") != "") & _in_fold())
    bins = {(r["step"], r["rule_verdict"]): r["n"] for r in fold.groupBy(step.alias("step"), "rule_verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = {c: sum(n for (_, v), n in bins.items() if v == c) for c in ("allow", "block")}
    if not all(total.values()):
        return 0.0
    best, cutoff, passed, stopped = -1.0, 0.0, total["allow"], 0
    for at in sorted({s for s, _ in bins}):
        rate = passed / total["allow"] + stopped / total["block"]
        if rate > best:
            best, cutoff = rate, at / GRID
        passed -= bins.get((at, "allow"), 0)
        stopped += bins.get((at, "block"), 0)
    return cutoff


def filter_urls(pages: DataFrame, rules=RULES, order: int = 4, max_per_class: int = 10_000, max_chars: int = 2048) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, cutoff) of every page. The models are fitted on
    at most ``max_per_class`` distinct URLs of each class of at most ``max_chars`` characters;
    every URL is scored whole, and all of the calibration fold decide on the cutoff."""
    spark = pages.sparkSession
    judged = judged_by_rules(pages, rules)
    learned = spark.sparkContext.broadcast(learn(judged, order, max_per_class, max_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = RatioScorer(learned.value["allow"], learned.value["block"], order)
        for batch in batches:
            scores = pa.array([scorer.score(url) for url in batch.column("url").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    schema = "page_id long, url string, host string, path string, rule string, rule_verdict string, score double"
    scored = staged(judged.mapInArrow(run, schema), "url-scores")
    cutoff = F.lit(calibrated_cutoff(scored))
    by_model = F.when(F.col("score") >= cutoff, "allow").otherwise("block")
    verdict = F.coalesce("rule_verdict", by_model)
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", cutoff.alias("cutoff"))
