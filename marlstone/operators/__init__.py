"""DataFrame -> DataFrame operators of the Silver and Gold zones."""

from marlstone.operators.clean import (
    CLEANERS, clean_order_item_refunds, clean_order_items, clean_orders,
    clean_products, clean_website_pageviews, clean_website_sessions,
    valid_price)
from marlstone.operators.inspect import (
    describe_columns, preview, schema_inventory, sql_type_name)
from marlstone.operators.marts import (
    CHANNEL_KEYS, mart_product_performance, mart_session_conversion,
    order_metrics, product_fact_totals, session_metrics)
from marlstone.operators.model import (
    dim_products, dim_website_sessions, fact_order_items)

__all__ = [
    "CHANNEL_KEYS", "CLEANERS", "clean_order_item_refunds", "clean_order_items",
    "clean_orders", "clean_products", "clean_website_pageviews",
    "clean_website_sessions", "describe_columns", "dim_products",
    "dim_website_sessions", "fact_order_items", "mart_product_performance",
    "mart_session_conversion", "order_metrics", "preview",
    "product_fact_totals", "schema_inventory", "session_metrics",
    "sql_type_name", "valid_price",
]
