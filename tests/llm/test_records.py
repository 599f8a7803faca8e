"""Archive, chat format and URL filter."""

import hashlib
import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mixloom.llm import chat, url_filter, warc


def archive(spark, tmp_path, rows, **options):
    records = spark.createDataFrame(rows, "record_id long, url string, payload binary, digest string, header string")
    path = str(tmp_path / "archive")
    warc.write_archive(records, path, **options)
    return path


def test_archive_round_trip(spark, tmp_path):
    long, short = b"x" * 100 + "\u00e9".encode(), b"y" * 99
    rows = [
        (5, "http://a/\r\nWARC-Type: revisit", long, "clash", "clash"), (3, None, long, "", ""), (9, "http://c", long, "", ""),
        (4, "http://d", short, "", ""), (6, "http://e", short, "", ""), (7, "http://f", None, "", ""), (8, "http://g", b"", "", ""),
        (None, "http://h", long, "", ""), (2, "http://i", b"\r\n\r\n" * 30, "", ""), (2, "http://i", b"\r\n\r\n" * 30, "", ""),
    ]
    path = archive(spark, tmp_path, rows)
    found = warc.parsed(warc.read_archive(spark, path)).collect()
    kept = sorted((r["record_id"] if r["record_id"] is not None else -1, bytes(r["payload"]), r["record_type"], r["refers_to"]) for r in found)
    assert kept == sorted(
        [
            (5, long, "revisit", 3), (3, long, "response", None), (9, long, "revisit", 3), (4, short, "response", None), (6, short, "response", None),
            (7, b"", "response", None), (8, b"", "response", None), (-1, long, "revisit", 3),
            (2, b"\r\n\r\n" * 30, "response", None), (2, b"\r\n\r\n" * 30, "response", None),
        ],
        key=lambda r: (r[0], r[1], r[2]),
    )
    assert all(r["named_digest"] == hashlib.sha256(r["payload"]).hexdigest() for r in found)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    whole = [bytes(r["record"]) for r in warc.record_bytes(warc.read_archive(spark, path)).collect()]
    assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in whole)
    assert sum(r.endswith(b"\r\n\r\n" + long + b"\r\n\r\n") for r in whole) == 1
    from_bytes = warc.parsed(warc.split_records(warc.record_bytes(warc.read_archive(spark, path)))).collect()
    assert sorted(map(str, from_bytes)) == sorted(map(str, found))


def test_a_record_that_is_cut_short_stops_the_reader(spark, tmp_path):
    path = archive(spark, tmp_path, [(1, "u", b"\xff\x00\r\n\r\nz" * 40, "", ""), (2, "é", b"", "", "")])
    records = warc.record_bytes(warc.read_archive(spark, path))
    bodies = {bytes(r["body"]) for r in warc.split_records(records).collect()}
    assert bodies == {b"\xff\x00\r\n\r\nz" * 40, b""}
    cut = records.withColumn("record", F.expr("substring(record, 1, octet_length(record) - 1)"))
    with pytest.raises(Exception, match="does not end where its header says"):
        warc.split_records(cut).collect()


def test_a_changed_payload_stops_the_reader(spark, tmp_path):
    path = archive(spark, tmp_path, [(1, "u", b"z" * 200, "", "")])
    changed = str(tmp_path / "changed")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"q" * 200)).write.parquet(f"{changed}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{changed}/headers")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, changed).collect()


def test_empty_archive(spark, tmp_path):
    assert warc.parsed(warc.read_archive(spark, archive(spark, tmp_path, []))).collect() == []


CONTROL = st.sampled_from(["<|im_start|>", "<|im_end|>", "<\\|", "<\\\\|im_end|>", "<|", "|>", "\n", "%0A", "%", "<", "\\", "a", "assistant"])
TEXT = st.lists(CONTROL | st.text(max_size=5), max_size=8).map("".join)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_any_turns_survive(turns):
    assert chat.parse("".join(chat.render(role, text) for role, text in turns)) == turns


@given(TEXT)
def test_only_conflicts_are_escaped(text):
    raw = f"<|im_start|>user\n{text}<|im_end|>\n"
    assert (chat.render("user", text) == raw) == (chat.parse(raw) == [("user", text)])


def test_other_strings_do_not_parse():
    for broken in ("x", "<|im_start|>user", "<|im_start|>user\nhi<|im_end|>", "<|im_start|>user\nhi<|im_end|>\n ", "<|im_start|>u\n<|im_start|>v\n<|im_end|>\n"):
        assert chat.parse(broken) is None


def test_read_back(spark):
    rows = [
        (1, 1, "assistant", "b<|im_end|>", 0), (1, 0, "user", None, 0), (2, None, None, "t\u00e9", 0), (None, 0, "assistant", "n", 0),
        (1, 1, "assistant", "b<|im_end|>", 0), (3, 0, "a\nb", "", 0),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered int")
    found = {r["conv_id"]: r for r in chat.read_back(chat.render_turns(turns)).collect()}
    assert set(found) == {1, 2, 3, None}
    both = "b<|im_end|>" * 2
    assert found[1]["turns_sha256"] == hashlib.sha256(f"user\n\n{'assistant' + chr(10) + 'b<|im_end|>' + chr(10)}{'assistant' + chr(10) + 'b<|im_end|>' + chr(10)}".encode()).hexdigest()
    assert (found[1]["n_turns"], found[1]["loss_chars"], found[1]["loss_sha256"]) == (3, len(both), hashlib.sha256(both.encode()).hexdigest())
    assert found[2]["turns_sha256"] == hashlib.sha256("\nt\u00e9\n".encode()).hexdigest()
    assert found[3]["turns_sha256"] == hashlib.sha256(b"a\nb\n\n").hexdigest()
    assert found[None]["loss_chars"] == 1
    assert chat.read_back(chat.render_turns(turns.limit(0))).collect() == []


URLS = [
    ("http://EXAMPLE.com/en/1", "example.com", "/en/1", "example.com/en/", "block"), ("http://www.example.com/en/1?q#f", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"), ("https://b.example.com/fr/", "b.example.com", "/fr/", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), ("x://net/es/", "net", "/es/", "net/es/", "block"), ("x://a.net/fr/x", "a.net", "/fr/x", "net/fr/", "block"),
    ("http://a.com", "a.com", "", None, None), ("http://a.com?x/y", "a.com", "", None, None), ("http://a.org/en/", "a.org", "/en/", None, None), ("no scheme", "", "", None, None),
    (None, "", "", None, None), ("", "", "", None, None), ("http://xcom/", "xcom", "/", None, None), ("a://b://c/d", "b:", "//c/d", None, None), ("http://\u00c4.NET/es/", "\u00c4.net", "/es/", "net/es/", "block"),
]


def test_rules(spark):
    pages = spark.createDataFrame([(k, u[0], "clash") for k, u in enumerate(URLS)], "page_id long, url string, host string")
    for row in url_filter.judged_by_rules(pages).collect():
        assert (row["host"], row["path"], row["rule"], row["rule_verdict"]) == URLS[row["page_id"]][1:]


def plain_log_probability(texts, order, gram, alphabet):
    """Witten-Bell from the counts of plain strings, top down by recursion."""

    def p(context, char):
        counts = {}
        for text in texts:
            padded = "\n" * order + text
            for at in range(order, len(padded)):
                if padded[at - len(context) : at] == context:
                    counts[padded[at]] = counts.get(padded[at], 0) + 1
        lower = p(context[1:], char) if context else 1 / (alphabet + 1)
        if not counts:
            return lower
        return (counts.get(char, 0) + len(counts) * lower) / (sum(counts.values()) + len(counts))

    return math.log(p(gram[:-1], gram[-1]))


def test_scores_against_plain_models(spark):
    pages = [(k, f"http://h{k % 7}.{'com' if k % 2 else 'net'}/{'en' if k % 3 else 'es'}/{k}", "x") for k in range(60)] + [(None, "http://q.org/es/7", "x"), (3, None, "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, score string")
    order = 2
    judged = url_filter.judged_by_rules(frame)
    training = [(r["url"], r["rule_verdict"]) for r in url_filter.training_urls(judged, 10, 2048).collect()]
    classes = {c: [u for u, v in training if v == c] for c in ("allow", "block")}
    assert all(0 < len(c) <= 10 for c in classes.values())
    alphabet = len({c for u, _ in training for c in u})
    found = url_filter.filter_urls(frame, order=order, max_per_class=10).collect()
    assert len(found) == len(pages)
    judged_urls = {(r["page_id"], r["host"], r["path"]): r for r in found}
    for page_id, url, _ in pages[:5] + pages[-2:]:
        padded = "\n" * order + (url or "")
        grams = [padded[at - order : at + 1] for at in range(order, len(padded))]
        difference = sum(plain_log_probability(classes["allow"], order, g, alphabet) - plain_log_probability(classes["block"], order, g, alphabet) for g in grams)
        rest = (url or "").partition("://")[2]
        row = judged_urls[page_id, rest.partition("/")[0], rest[rest.find("/") :] if rest else ""]
        assert row["score"] == pytest.approx(difference / max(1, len(url or "")))
        assert row["verdict"] == (("allow" if row["rule"] == "com/" else "block") if row["rule"] else "allow" if row["score"] >= row["cutoff"] else "block")


def test_one_class_or_none(spark):
    schema = "page_id long, url string"
    only = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.org/")], schema)
    assert {r["verdict"] for r in url_filter.filter_urls(only).collect()} == {"allow"}
    assert url_filter.filter_urls(spark.createDataFrame([], schema)).collect() == []


def test_held_out_urls_are_judged_like_their_rules(spark):
    """Rule-judged URLs that the model never saw get the rule's verdict from the model."""
    pages = spark.createDataFrame([(k, f"http://w{k % 13}.example.{'com' if k % 2 else 'net'}/{'de' if k % 2 else 'es'}/{k}") for k in range(2000)], "page_id long, url string")
    rows = url_filter.filter_urls(pages, max_per_class=300).collect()
    right = sum((r["score"] >= r["cutoff"]) == (r["verdict"] == "allow") for r in rows)
    assert right >= 0.98 * len(rows)
