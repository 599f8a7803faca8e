"""One identity of a playlist in all views, also for an order that is cut into several."""

import os

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from catalog import views
from catalog.oracles import oracle_sql
from catalog.queries import REGISTRY
from mixloom.operators import stats
from mixloom.operators.flatten import entries_of
from tools.check_oracle import TABLES, database, differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def long_order(tmp_path_factory):
    """The smallest tables, with 600 lines put into one order and 260 into another."""
    folder = tmp_path_factory.mktemp("long")
    for name in TABLES.split():
        rows = pq.read_table(f"{SF}/{name}.parquet")
        if name == "lineitem":
            number = pa.array(range(len(rows)), pa.int32())
            keys = pc.if_else(pc.less(number, 600), 1, pc.if_else(pc.less(number, 860), 5, rows["l_orderkey"]))
            rows = rows.set_column(rows.schema.get_field_index("l_orderkey"), "l_orderkey", keys.cast(pa.int64()))
            rows = rows.set_column(rows.schema.get_field_index("l_linenumber"), "l_linenumber", number)
        pq.write_table(rows, folder / f"{name}.parquet")
    return str(folder)


def test_totals_of_entries_and_of_nested_playlists_agree(spark, long_order):
    nested = views.nested_playlists(spark, long_order)
    over_nested = stats.corpus_totals(nested, entries_of(nested)).first()
    assert over_nested == REGISTRY["corpus_totals"](spark, long_order).first() or over_nested.asDict() == pytest.approx(
        REGISTRY["corpus_totals"](spark, long_order).first().asDict()
    )
    assert nested.filter("pid % 1000000000000 = 1").count() == 3
    assert nested.selectExpr("max(size(tracks)) as most").first().most == 250


@pytest.mark.parametrize(
    "name",
    ["flatten_entries", "corpus_totals", "hist_lengths", "hist_edits", "dict_playlists", "etl_roundtrip", "dq_playlist_rules", "dq_position", "dq_name_mismatch", "lookup_pids", "cards_pretty", "hist_descriptions"],
)
def test_queries_over_a_long_order(spark, long_order, name):
    df = REGISTRY[name](spark, long_order)
    assert differences(df, df.collect(), database(long_order), oracle_sql()[name]) == []
