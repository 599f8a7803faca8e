"""Every registered query at the smallest scale, against its SQL where it has one."""

import os

import pytest

import __spark_entry__ as entry
from tools.check_oracle import database, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return database(SF)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_workers_get_the_path_of_the_package(spark):
    QUERIES["hist_edits"](spark, SF)
    assert entry.HERE in spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if name in ORACLES:
        assert differences(df, rows, duck, ORACLES[name]) == []
