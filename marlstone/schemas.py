"""Declared schemas of every zone.

Zone reads check the files' own schema against these: Bronze, which keeps the
source's types and any further columns, by name and kind of type; Silver and
Gold exactly, and every Silver / Gold operator ends in a projection that
produces the matching struct.
"""

from __future__ import annotations

from pyspark.sql import types as T

INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
BOOL = T.BooleanType()
STR = T.StringType()
TS = T.TimestampNTZType()  # source TIMESTAMP has no zone
# Money at the source is NUMERIC; the test adapters use (12,2) because their
# amounts exceed the (10,2) of the shop DDL. Readers accept any decimal.
MONEY = T.DecimalType(12, 2)


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# --- Bronze: the relational source as extracted (SELECT *) ------------------

BRONZE = {
    "staging_products": _struct(
        ("product_id", INT), ("create_at", TS), ("product_name", STR)),
    "staging_website_sessions": _struct(
        ("website_session_id", INT), ("created_at", TS), ("user_id", INT),
        ("is_repeat_session", INT), ("utm_source", STR), ("utm_campaign", STR),
        ("utm_content", STR), ("device_type", STR), ("http_referer", STR)),
    "staging_website_pageviews": _struct(
        ("website_pageview_id", INT), ("create_at", TS),
        ("website_session_id", INT), ("pageview_url", STR)),
    "staging_orders": _struct(
        ("order_id", INT), ("create_at", TS), ("website_session_id", INT),
        ("user_id", INT), ("primary_product_id", INT), ("items_purchased", INT),
        ("price_usd", MONEY), ("cogs_usd", MONEY)),
    "staging_order_items": _struct(
        ("order_item_id", INT), ("create_at", TS), ("order_id", INT),
        ("product_id", INT), ("is_primary_item", INT),
        ("price_usd", MONEY), ("cogs_usd", MONEY)),
    "staging_order_item_refunds": _struct(
        ("order_item_refund_id", INT), ("create_at", TS),
        ("order_item_id", INT), ("order_id", INT),
        ("refund_amount_usd", MONEY)),
}

# Source primary keys: used to split parallel JDBC reads.
PRIMARY_KEYS = {
    "staging_products": "product_id",
    "staging_website_sessions": "website_session_id",
    "staging_website_pageviews": "website_pageview_id",
    "staging_orders": "order_id",
    "staging_order_items": "order_item_id",
    "staging_order_item_refunds": "order_item_refund_id",
}

# Extraction order of the source tables.
SOURCE_TABLES = [
    "staging_website_sessions",
    "staging_website_pageviews",
    "staging_orders",
    "staging_order_items",
    "staging_products",
    "staging_order_item_refunds",
]

# --- Silver: cleaned, create_at renamed to created_at ------------------------

SILVER = {
    "website_sessions": _struct(
        ("website_session_id", INT), ("created_at", TS), ("user_id", INT),
        ("is_repeat_session", BOOL), ("utm_source", STR), ("utm_campaign", STR),
        ("utm_content", STR), ("device_type", STR), ("http_referer", STR)),
    "website_pageviews": _struct(
        ("website_pageview_id", INT), ("created_at", TS),
        ("website_session_id", INT), ("pageview_url", STR)),
    "orders": _struct(
        ("order_id", INT), ("created_at", TS), ("website_session_id", INT),
        ("user_id", INT), ("primary_product_id", INT), ("items_purchased", INT),
        ("price_usd", DOUBLE), ("cogs_usd", DOUBLE)),
    "order_items": _struct(
        ("order_item_id", INT), ("created_at", TS), ("order_id", INT),
        ("product_id", INT), ("is_primary_item", BOOL),
        ("price_usd", DOUBLE), ("cogs_usd", DOUBLE)),
    "products": _struct(
        ("product_id", INT), ("created_at", TS), ("product_name", STR)),
    "order_item_refunds": _struct(
        ("order_item_refund_id", INT), ("created_at", TS),
        ("order_item_id", INT), ("order_id", INT),
        ("refund_amount_usd", DOUBLE)),
}

# Bronze table -> Silver table.
BRONZE_TO_SILVER = {
    "staging_website_sessions": "website_sessions",
    "staging_website_pageviews": "website_pageviews",
    "staging_orders": "orders",
    "staging_order_items": "order_items",
    "staging_products": "products",
    "staging_order_item_refunds": "order_item_refunds",
}

# --- Gold: star schema and marts --------------------------------------------

GOLD = {
    "fact_order_items": _struct(
        ("order_item_id", INT), ("order_id", INT), ("order_date", TS),
        ("website_session_id", INT), ("user_id", INT), ("product_id", INT),
        ("is_primary_item", BOOL), ("revenue_usd", DOUBLE), ("cogs_usd", DOUBLE),
        ("refund_amount_usd", DOUBLE), ("net_profit_usd", DOUBLE)),
    "dim_products": _struct(
        ("product_id", INT), ("product_name", STR), ("created_at", TS)),
    "dim_website_sessions": _struct(
        ("website_session_id", INT), ("session_start_time", TS), ("user_id", INT),
        ("is_repeat_session", BOOL), ("utm_source", STR), ("utm_campaign", STR),
        ("utm_content", STR), ("device_type", STR), ("http_referer", STR)),
    "mart_product_performance": _struct(
        ("product_id", INT), ("product_name", STR), ("total_units_sold", LONG),
        ("gross_revenue_usd", DOUBLE), ("total_refund_usd", DOUBLE),
        ("net_profit_usd", DOUBLE)),
    "mart_session_conversion": _struct(
        ("utm_source", STR), ("utm_campaign", STR), ("device_type", STR),
        ("total_sessions", LONG), ("total_orders", LONG),
        ("conversion_rate_percent", DOUBLE)),
}

# Gold table -> serving table (K7).
SERVING_TABLES = {
    "fact_order_items": "gold_fact_order_items",
    "dim_products": "gold_dim_products",
    "dim_website_sessions": "gold_dim_website_sessions",
    "mart_product_performance": "gold_mart_product_performance",
    "mart_session_conversion": "gold_mart_session_conversion",
}

ZONES = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}


def same_columns(actual: T.StructType, expected: T.StructType) -> bool:
    """Names and types equal, in order; nullability ignored."""
    return [(f.name, f.dataType) for f in actual.fields] == [
        (f.name, f.dataType) for f in expected.fields]
