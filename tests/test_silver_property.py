"""Silver cleaners on generated Bronze rows against the cleaning rules written
as plain SQL, run by DuckDB on the same rows (P1-P6, F1, F2, X1-X7).

Prices include NULL, negative, zero and the extremes of the source type;
flags include values other than 0 and 1; text includes NULL, blank, padded
and mixed-case values with no-break spaces, tabs and special case letters.
"""

from datetime import datetime
from decimal import Decimal

import duckdb
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marlstone.operators import CLEANERS
from marlstone.plans.oracle import silver_sql
from marlstone.schemas import BRONZE, BRONZE_TO_SILVER

ints = st.sampled_from([1, 2, 7, 0, -3, 2147483647, None])
flags = st.sampled_from([0, 1, 2, -1, None])
times = st.sampled_from([datetime(2024, 1, 1, 9, 0), datetime(1999, 12, 31, 23, 59, 59),
                         None])
money = st.sampled_from([Decimal("19.99"), Decimal("0.00"), Decimal("-0.01"),
                         Decimal("9999999999.99"), Decimal("-9999999999.99"),
                         Decimal("0.10"), None])
texts = st.sampled_from([None, "", "  ", " GSearch ", " Mobile\t", "direct",
                         "ΣΑΣ ", "İstanbul", "Www.Site.COM/Path "])

ROWS = {
    "staging_products": st.tuples(ints, times, texts),
    "staging_website_sessions": st.tuples(ints, times, ints, flags, texts, texts, texts,
                                          texts, texts),
    "staging_website_pageviews": st.tuples(ints, times, ints, texts),
    "staging_orders": st.tuples(ints, times, ints, ints, ints, ints, money, money),
    "staging_order_items": st.tuples(ints, times, ints, ints, flags, money, money),
    "staging_order_item_refunds": st.tuples(ints, times, ints, ints, money),
}

def _arrow_schema(struct):
    def kind(dt):
        name = dt.simpleString()
        if name.startswith("decimal"):
            return pa.decimal128(dt.precision, dt.scale)
        return {"int": pa.int32(), "string": pa.string(),
                "timestamp_ntz": pa.timestamp("us")}[name]
    return pa.schema([(f.name, kind(f.dataType)) for f in struct.fields])


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.fixed_dictionaries({t: st.lists(s, min_size=1, max_size=8)
                              for t, s in ROWS.items()}))
def test_silver_equals_rule_sql(spark, tables):
    con = duckdb.connect()
    for table, rows in tables.items():
        schema = BRONZE[table]
        arrow = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows],
                                     schema=_arrow_schema(schema))
        con.register("t", arrow)
        want = con.sql(silver_sql(BRONZE_TO_SILVER[table], "t"))
        got = CLEANERS[table](spark.createDataFrame(rows, schema))
        assert got.columns == want.columns, table
        assert (_sorted([tuple(r) for r in got.collect()])
                == _sorted(want.fetchall())), (table, rows)
        con.unregister("t")
