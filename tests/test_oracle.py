"""Every registered query against its SQL oracle (DuckDB) on the smallest
generated data set; the driver repeats this at sf0.01."""

import pytest

import __spark_entry__ as entry
from marlstone.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck, rows_of_duck

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(results, name):
    res = results[name]
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


# Spark type -> DuckDB type name of the oracle's column.
_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
         "boolean": "BOOLEAN", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(entry.oracle_sql()[name])
    oracle = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for col, dtype in df.dtypes:
        assert _TYPE[dtype] == oracle[col], (name, col, dtype, oracle[col])


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_id", "product_name", "total_units_sold",
                          "gross_revenue_usd", "total_refund_usd", "net_profit_usd"]
    assert df.count() > 0


def test_oracle_counts_are_whole_tables():
    con = duck(SF_SMALL)
    _, rows, _ = rows_of_duck(con, entry.oracle_sql()["bronze_extract_counts"])
    counts = {r[1]: r[0] for r in rows}
    events = con.execute("SELECT COUNT(*) FROM events").fetchall()[0][0]
    assert counts["staging_website_sessions"] == events
    assert counts["staging_orders"] == con.execute("SELECT COUNT(*) FROM orders").fetchall()[0][0]


def test_registered_data_reach_the_branches():
    """Channels without orders, rates over 100 %, items without an order,
    facts without a session, items with several refunds."""
    con = duck(SF_SMALL)
    sql = entry.oracle_sql()
    mart = con.sql(sql["mart_session_conversion"]).df()
    assert (mart.total_orders == 0).any() and (mart.conversion_rate_percent > 100).any()
    fact = con.sql(sql["fact_order_items"]).df()
    assert fact.website_session_id.isna().any()
    assert fact.groupby("website_session_id").order_id.nunique().max() > 1
    assert fact.duplicated(["order_item_id", "order_id"]).any()
    items = con.sql(sql["silver_order_items"]).df()
    assert (~items.order_id.isin(con.sql(sql["silver_orders"]).df().order_id)).any()
