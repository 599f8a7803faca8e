import datetime
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mixloom.functions.arrays import average_precision, ids_of
from mixloom.functions.text import DROPPED, date_text, normalize_name, time_text


def normalized(text):
    kept = "".join(" " if one in DROPPED else one for one in text.lower())
    return " ".join(kept.split())


TITLES = [
    "  Road   Trip! ", "a\tb", "a b", "a　 b", "a\x1cb\x1fc", "a\x85b", "it's -?&+ fine", DROPPED,
    "ÀÉÎ Öß", "ΟΔΟΣ", "", "   ", "x" + DROPPED + "y", " line ", "ночь / день",
]


def test_normalize_name_equals_plain_python(spark):
    rows = spark.createDataFrame([(one,) for one in TITLES], "t string")
    got = rows.select("t", normalize_name("t").alias("n")).collect()
    assert {row.t: row.n for row in got} == {one: normalized(one) for one in TITLES}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_characters="İ"), max_size=30), min_size=40, max_size=60))
def test_normalize_name_on_random_text(spark, texts):
    rows = spark.createDataFrame([(one,) for one in texts], "t string")
    got = [(row.t, row.n) for row in rows.select("t", normalize_name("t").alias("n")).collect()]
    assert got == [(one, normalized(one)) for one in texts]


def test_times_do_not_depend_on_the_session_zone(spark):
    seconds = [0, 1509494400, 1509494399, 951782400, 1700000000]
    rows = spark.createDataFrame([(one,) for one in seconds], "s bigint")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Ho_Chi_Minh", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = rows.select("s", date_text("s").alias("d"), time_text("s").alias("t")).collect()
            for row in got:
                moment = datetime.datetime.fromtimestamp(row.s, datetime.UTC)
                assert row.d == moment.strftime("%Y-%m-%d")
                assert row.t == moment.strftime("%Y-%m-%d %H:%M:%S")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert rows.filter("s = 0").select(time_text("s", "Asia/Tokyo")).first()[0] == "1970-01-01 09:00:00"


def plain_ap(predicted, actual, k):
    if not predicted or not actual:
        return 0.0
    places = [place for place, item in enumerate(predicted[:k], 1) if item in set(actual)]
    return sum(number / place for number, place in enumerate(places, 1)) / min(len(actual), k)


CASES = [
    ([1, 2, 3, 4], [2, 4, 9], 1 / 3, 0.25),
    ([1, 1, 2], [1], 2.0, 2.0),
    ([], [1], 0.0, 0.0),
    (None, [1], 0.0, 0.0),
    ([1], None, 0.0, 0.0),
    ([5], [6], 0.0, 0.0),
    ([7, 8], [8, 8, 7], 2 / 3, 1.0),
]


def test_average_precision_cases(spark):
    rows = spark.createDataFrame([(i, p, a) for i, (p, a, _, _) in enumerate(CASES)], "i int, p array<int>, a array<int>")
    got = rows.select("i", average_precision("p", "a", 500).alias("x"), average_precision("p", "a", 2).alias("y"))
    for row in got.collect():
        assert row.x == pytest.approx(CASES[row.i][2])
        assert row.y == pytest.approx(CASES[row.i][3])


def test_average_precision_on_random_lists(spark):
    draw = random.Random(5)
    lists = [
        (i, [draw.randrange(12) for _ in range(draw.randrange(9))], [draw.randrange(12) for _ in range(draw.randrange(9))])
        for i in range(300)
    ]
    rows = spark.createDataFrame(lists, "i int, p array<int>, a array<int>")
    for k in (1, 3, 500):
        for row in rows.select("i", average_precision("p", "a", k).alias("x")).collect():
            assert row.x == pytest.approx(plain_ap(lists[row.i][1], lists[row.i][2], k))


def test_ids_keep_the_order(spark):
    rows = spark.sql("select array(struct(3 as id, 0.9 as r), struct(1 as id, 0.5 as r)) as recs")
    assert rows.select(ids_of("recs", "id").alias("x")).first().x == [3, 1]
    assert rows.select(F.size("recs").alias("n")).first().n == 2
