"""Bronze -> Silver cleaners.

Each is a pure ``DataFrame -> DataFrame`` function: a narrow projection (and
for orders / order items a filter), so it runs map-only with no shuffle and
scales linearly with the number of input splits. Filters are applied to the
raw decimal column *before* the cast so the parquet reader receives them as
``PushedFilters`` (SURVEY §4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import (
    as_flag_sql, as_int_sql, as_money_sql, as_timestamp_sql, normalize_text_sql)


def _projected(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One projection from SQL text: a single call into the JVM."""
    return df.selectExpr(*(f"{sql} AS {name}" for name, sql in columns.items()))


def valid_price(df: DataFrame, column: str = "price_usd") -> DataFrame:
    """F1 / F2: keep rows with ``price >= 0``; NULL and negative dropped."""
    return df.where(F.col(column) >= F.lit(0))


def clean_website_sessions(bronze: DataFrame) -> DataFrame:
    """Casts, flag -> boolean, defaults for missing marketing fields.

    utm_source / utm_campaign / utm_content / device_type are lower-cased;
    http_referer is trimmed and defaulted but keeps its case.
    """
    return _projected(bronze, {
        "website_session_id": as_int_sql("website_session_id"),
        "created_at": as_timestamp_sql("created_at"),
        "user_id": as_int_sql("user_id"),
        "is_repeat_session": as_flag_sql("is_repeat_session"),
        "utm_source": normalize_text_sql("utm_source", "direct"),
        "utm_campaign": normalize_text_sql("utm_campaign", "none"),
        "utm_content": normalize_text_sql("utm_content", "none"),
        "device_type": normalize_text_sql("device_type", "unknown"),
        "http_referer": normalize_text_sql("http_referer", "direct", lower=False),
    })


def clean_website_pageviews(bronze: DataFrame) -> DataFrame:
    """Casts, rename create_at, lower+trim url (NULL stays NULL)."""
    return _projected(bronze, {
        "website_pageview_id": as_int_sql("website_pageview_id"),
        "created_at": as_timestamp_sql("create_at"),
        "website_session_id": as_int_sql("website_session_id"),
        "pageview_url": normalize_text_sql("pageview_url"),
    })


def clean_orders(bronze: DataFrame) -> DataFrame:
    """P3 + F1: orders with a non-negative price, money as double."""
    return _projected(valid_price(bronze), {
        "order_id": as_int_sql("order_id"),
        "created_at": as_timestamp_sql("create_at"),
        "website_session_id": as_int_sql("website_session_id"),
        "user_id": as_int_sql("user_id"),
        "primary_product_id": as_int_sql("primary_product_id"),
        "items_purchased": as_int_sql("items_purchased"),
        "price_usd": as_money_sql("price_usd"),
        "cogs_usd": as_money_sql("cogs_usd"),
    })


def clean_order_items(bronze: DataFrame) -> DataFrame:
    """P4 + F2: order items with a non-negative price, flag as boolean."""
    return _projected(valid_price(bronze), {
        "order_item_id": as_int_sql("order_item_id"),
        "created_at": as_timestamp_sql("create_at"),
        "order_id": as_int_sql("order_id"),
        "product_id": as_int_sql("product_id"),
        "is_primary_item": as_flag_sql("is_primary_item"),
        "price_usd": as_money_sql("price_usd"),
        "cogs_usd": as_money_sql("cogs_usd"),
    })


def clean_products(bronze: DataFrame) -> DataFrame:
    """P5: trim the name, keep its case, no default."""
    return _projected(bronze, {
        "product_id": as_int_sql("product_id"),
        "created_at": as_timestamp_sql("create_at"),
        "product_name": normalize_text_sql("product_name", lower=False),
    })


def clean_order_item_refunds(bronze: DataFrame) -> DataFrame:
    """Casts only; negative refunds are kept (no filter)."""
    return _projected(bronze, {
        "order_item_refund_id": as_int_sql("order_item_refund_id"),
        "created_at": as_timestamp_sql("create_at"),
        "order_item_id": as_int_sql("order_item_id"),
        "order_id": as_int_sql("order_id"),
        "refund_amount_usd": as_money_sql("refund_amount_usd"),
    })


# Bronze table -> cleaner, in extraction order.
CLEANERS = {
    "staging_website_sessions": clean_website_sessions,
    "staging_website_pageviews": clean_website_pageviews,
    "staging_orders": clean_orders,
    "staging_order_items": clean_order_items,
    "staging_products": clean_products,
    "staging_order_item_refunds": clean_order_item_refunds,
}
