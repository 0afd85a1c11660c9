"""Gold chain on generated Silver inputs against the rules written as plain SQL.

The fact (inner plus anti join of the refunds), the product mart (pre-aggregated before the
dimension join) and the conversion mart (two-phase distinct count) are
restructured for scale; here they must equal the straightforward SQL of the
rules for any input, including the cases the sample data never has:
duplicate ids in both dimensions, NULL ids and NULL channel keys, refunds of
missing items, several refunds per item, items of unknown orders and products.
The SQL runs in DuckDB on the same rows.
"""

from datetime import datetime
import math

import duckdb
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marlstone.operators import (
    dim_products, dim_website_sessions, fact_order_items,
    mart_product_performance, mart_session_conversion)
from marlstone.plans.oracle import gold_sql
from marlstone.schemas import GOLD, SILVER

T0 = datetime(2024, 1, 1, 9, 0, 0)

# small id ranges and lists of some length, so that keys collide and repeat
# in every example
ids = {
    "order": st.sampled_from([1, 2, 3, 4, None]),
    "item_order": st.sampled_from([1, 2, 3, 5]),    # 5: an order that never exists
    "item": st.sampled_from([1, 2, 3, 4, 5, None]),
    "refund_item": st.sampled_from([1, 2, 3, 6, None]),  # 6: an item that never exists
    "product": st.sampled_from([1, 2, 3, None]),
    "session": st.sampled_from([1, 2, 3, None]),
}
money = st.sampled_from([0.0, 1.25, 9.0, 19.99, 20.0, 0.1, 0.2, 1e6 + 0.01, None])
channel = st.sampled_from(["gsearch", "bsearch", None])
flag = st.sampled_from([True, False, None])

orders = st.lists(st.tuples(ids["order"], ids["session"], money, money),
                  min_size=3, max_size=6)
items = st.lists(st.tuples(ids["item"], ids["item_order"], ids["product"], flag, money, money),
                 min_size=5, max_size=10)
refunds = st.lists(st.tuples(ids["refund_item"], money), min_size=2, max_size=6)
products = st.lists(st.tuples(ids["product"], st.sampled_from(["Bear", "Fuzzy"])),
                    min_size=2, max_size=6)
sessions = st.lists(st.tuples(ids["session"], channel, channel, channel),
                    min_size=3, max_size=8)


def silver_rows(o, oi, r, p, s):
    return {
        "orders": [(oid, T0, sid, 7, 1, 1, price, cogs) for oid, sid, price, cogs in o],
        "order_items": [(iid, T0, oid, pid, f, price, cogs)
                        for iid, oid, pid, f, price, cogs in oi],
        "order_item_refunds": [(n, T0, iid, None, amount)
                               for n, (iid, amount) in enumerate(r)],
        "products": [(pid, T0, name) for pid, name in p],
        "website_sessions": [(sid, T0, 7, False, src, camp, "none", dev, "direct")
                             for sid, src, camp, dev in s],
    }


def _arrow_schema(struct):
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(),
             "boolean": pa.bool_(), "string": pa.string(),
             "timestamp_ntz": pa.timestamp("us")}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in struct.fields])


RULES = f"WITH {gold_sql()}\n"


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def _close(a, b):
    if a is None or b is None or not isinstance(a, float):
        return a == b
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)


@settings(max_examples=20, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(orders, items, refunds, products, sessions)
def test_gold_equals_rule_sql(spark, o, oi, r, p, s):
    rows = silver_rows(o, oi, r, p, s)
    con = duckdb.connect()
    frames = {}
    for table, data in rows.items():
        schema = SILVER[table]
        frames[table] = spark.createDataFrame(data, schema)
        arrow = pa.Table.from_pylist([dict(zip(schema.names, row)) for row in data],
                                     schema=_arrow_schema(schema))
        con.register(table, arrow)

    fact = fact_order_items(frames["order_items"], frames["orders"],
                            frames["order_item_refunds"])
    assert fact.columns == GOLD["fact_order_items"].names
    want_fact = _sorted(con.sql(RULES + "SELECT * FROM fact_order_items").fetchall())
    # same association order of the subtraction, so doubles are bit-equal
    assert _sorted([tuple(x) for x in fact.collect()]) == want_fact
    mart = mart_product_performance(dim_products(frames["products"]), fact)
    assert mart.columns == GOLD["mart_product_performance"].names
    got = _sorted([tuple(x) for x in mart.collect()])
    want = _sorted(con.sql(RULES + "SELECT * FROM mart_product_performance").fetchall())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(_close(a, b) for a, b in zip(g, w)), (g, w)

    conv = mart_session_conversion(dim_website_sessions(frames["website_sessions"]), fact)
    assert conv.columns == GOLD["mart_session_conversion"].names
    assert (_sorted([tuple(x) for x in conv.collect()])
            == _sorted(con.sql(RULES + "SELECT * FROM mart_session_conversion").fetchall()))
