"""Adapters: the driver's generated tables -> Bronze-shaped web-shop tables.

The generated data (``/root/testdata/sf*/``) has TPC-H-like tables and an
event log but no web-shop tables, so each Bronze table is *derived* from one
of them by a deterministic, row-wise rule. Every row of the input becomes a
row, but for refunds, which are the returned lines. The rules decide values,
introducing the cases the cleaners and joins exist for: NULLs, blank and
padded text (including no-break space and tab), mixed case, NULL / negative
prices, negative refunds, several refunds per item, items without an order or
of unknown products, unsold products, orders without a session, sessions with
several orders, channels without orders and channels with more orders than
sessions. (orderkey, linenumber) repeats in the generated lines, so item ids
repeat too, as in an unclean source.

The same rules are written in SQL in ``plans.oracle`` so an independent engine
can recompute every registered query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.schemas import MONEY

NBSP = "\u00a0"
TAB = "\t"


# Declared schemas of the generated tables the adapters read: no footer
# inference at read time, and a changed input type fails loudly.
INPUT_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, "
              "event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
                "l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
            "p_size int, p_retailprice double",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    schema = INPUT_SCHEMAS.get(table)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


# Each adapter is one projection written as SQL expressions: a row-wise
# rule per column, one plan node per table, and one call into the JVM per
# projection rather than one per sub-expression.

_MONEY = f"DECIMAL({MONEY.precision},{MONEY.scale})"
_ITEM_KEY = "l_orderkey * 10 + l_linenumber"


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{expr} AS {name}" for name, expr in columns.items()))


def staging_website_sessions(events: DataFrame) -> DataFrame:
    return _project(events, {
        "website_session_id": "CAST(event_id AS INT)",
        "created_at": "CAST(ts AS TIMESTAMP_NTZ)",
        "user_id": "CAST(user_id AS INT)",
        "is_repeat_session": "CAST(event_id % 2 AS INT)",
        "utm_source": "CASE WHEN event_type = 'signup' THEN CAST(NULL AS STRING)"
                      " WHEN event_type = 'error' THEN '  '"
                      " ELSE concat('  ', upper(event_type), ' ') END",
        "utm_campaign": "CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS STRING)"
                        " ELSE concat(' Camp', CAST(event_id % 4 AS STRING), ' ') END",
        "utm_content": "CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS STRING)"
                       f" WHEN event_id % 5 = 1 THEN ' Banner{NBSP}'"
                       f" WHEN event_id % 5 = 2 THEN 'Banner{TAB}'"
                       " ELSE 'Banner ' END",
        "device_type": "CASE WHEN event_id % 3 = 0 THEN ' Desktop'"
                       " WHEN event_id % 3 = 1 THEN 'MOBILE'"
                       " ELSE CAST(NULL AS STRING) END",
        "http_referer": "CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS STRING)"
                        " ELSE concat(' https://Www.Site', CAST(event_id % 7 AS STRING),"
                        " '.com ') END",
    })


def staging_website_pageviews(events: DataFrame) -> DataFrame:
    return _project(events, {
        "website_pageview_id": "CAST(event_id AS INT)",
        "create_at": "CAST(ts AS TIMESTAMP_NTZ)",
        "website_session_id": "CAST(event_id AS INT)",
        "pageview_url": "CASE WHEN event_id % 9 = 0 THEN CAST(NULL AS STRING)"
                        " ELSE concat(' /', upper(event_type), ' ') END",
    })


def staging_orders(orders: DataFrame) -> DataFrame:
    return _project(orders, {
        "order_id": "CAST(o_orderkey AS INT)",
        "create_at": "CAST(o_orderdate AS TIMESTAMP_NTZ)",
        # eight neighbouring orders share a session, so the sessions of three
        # campaigns in four have none; some orders have no session
        "website_session_id": "CASE WHEN o_orderkey % 11 = 5 THEN CAST(NULL AS INT)"
                              " ELSE CAST(o_orderkey - o_orderkey % 8 AS INT) END",
        "user_id": "CAST(o_custkey AS INT)",
        "primary_product_id": "CAST(o_custkey AS INT)",
        "items_purchased": "1",
        "price_usd": "CAST(CASE WHEN o_orderkey % 50 = 0 THEN CAST(NULL AS DOUBLE)"
                     " WHEN o_orderkey % 40 = 0 THEN -o_totalprice"
                     f" ELSE o_totalprice END AS {_MONEY})",
        # whole dollars: a half-cent double -> decimal cast is engine-specific
        "cogs_usd": f"CAST(floor(o_totalprice / 2) AS {_MONEY})",
    })


def staging_order_items(lineitem: DataFrame) -> DataFrame:
    return _project(lineitem, {
        "order_item_id": f"CAST({_ITEM_KEY} AS INT)",
        "create_at": "CAST(l_shipdate AS TIMESTAMP_NTZ)",
        # some items belong to an order that does not exist
        "order_id": f"CAST(CASE WHEN ({_ITEM_KEY}) % 17 = 3 THEN -l_orderkey"
                    " ELSE l_orderkey END AS INT)",
        # every tenth part number is re-pointed to a product that does not
        # exist: those parts stay unsold, those items have no product
        "product_id": "CAST(CASE WHEN l_partkey % 10 = 3 THEN -(l_partkey + 1)"
                      " ELSE l_partkey END AS INT)",
        "is_primary_item": "CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END",
        "price_usd": f"CAST(CASE WHEN ({_ITEM_KEY}) % 101 = 0 THEN CAST(NULL AS DOUBLE)"
                     f" ELSE l_extendedprice - 2000 END AS {_MONEY})",
        "cogs_usd": f"CAST(l_quantity * 10 AS {_MONEY})",
    })


def staging_products(part: DataFrame) -> DataFrame:
    return _project(part, {
        "product_id": "CAST(p_partkey AS INT)",
        "create_at": "TIMESTAMP_NTZ '2024-01-01 09:00:00'",
        "product_name": "concat(' ', p_name, ' ')",
    })


def staging_order_item_refunds(lineitem: DataFrame) -> DataFrame:
    """Returned lines are refunds; an item can have several (fan-out in the
    fact)."""
    refunded = lineitem.where("l_returnflag = 'R'")
    return _project(refunded, {
        "order_item_refund_id": f"CAST({_ITEM_KEY} AS INT)",
        "create_at": "CAST(l_shipdate AS TIMESTAMP_NTZ)",
        "order_item_id": f"CAST({_ITEM_KEY} AS INT)",
        "order_id": "CAST(l_orderkey AS INT)",
        "refund_amount_usd": f"CAST(CASE WHEN ({_ITEM_KEY}) % 13 = 0 THEN -l_extendedprice"
                             f" ELSE l_extendedprice END AS {_MONEY})",
    })


# Bronze table -> (generated table it is derived from, adapter)
ADAPTERS = {
    "staging_website_sessions": ("events", staging_website_sessions),
    "staging_website_pageviews": ("events", staging_website_pageviews),
    "staging_orders": ("orders", staging_orders),
    "staging_order_items": ("lineitem", staging_order_items),
    "staging_products": ("part", staging_products),
    "staging_order_item_refunds": ("lineitem", staging_order_item_refunds),
}


def bronze_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    source, adapter = ADAPTERS[table]
    return adapter(load(spark, sf_dir, source))


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: bronze_table(spark, sf_dir, t) for t in ADAPTERS}
