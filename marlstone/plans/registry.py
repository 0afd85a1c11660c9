"""Registered end-to-end queries; their SQL oracle is in ``plans.oracle``.

Each query derives the Bronze tables from the generated test tables
(``marlstone.sources.testdata``), runs the library operators on them lazily
as one Spark plan, and returns a DataFrame. Those of ``plans.runs`` write a whole lake
and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import (
    clean_order_item_refunds, clean_order_items, clean_orders, clean_products,
    clean_website_pageviews, clean_website_sessions, dim_products,
    dim_website_sessions, fact_order_items, mart_product_performance,
    mart_session_conversion, order_metrics, session_metrics)
from marlstone.plans.oracle import ORACLE_SQL  # noqa: F401  (part of the registry)
from marlstone.plans.runs import RUN_QUERIES
from marlstone.sources.testdata import ADAPTERS, bronze_table

Query = Callable[[SparkSession, str], DataFrame]


def _silver(name: str, cleaner) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cleaner(bronze_table(spark, sf_dir, name))
    return run


silver_website_sessions = _silver("staging_website_sessions", clean_website_sessions)
silver_website_pageviews = _silver("staging_website_pageviews", clean_website_pageviews)
silver_orders = _silver("staging_orders", clean_orders)
silver_order_items = _silver("staging_order_items", clean_order_items)
silver_products = _silver("staging_products", clean_products)
silver_order_item_refunds = _silver("staging_order_item_refunds",
                                    clean_order_item_refunds)


def bronze_extract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of each Bronze table as the adapters derive it. It checks
    the adapters' rows, not an extract or its read-back (those are tested with
    the pipeline)."""
    parts = [bronze_table(spark, sf_dir, t)
             .agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count")
             for t in ADAPTERS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_order_items(silver_order_items(spark, sf_dir),
                            silver_orders(spark, sf_dir),
                            silver_order_item_refunds(spark, sf_dir))


def q_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_products(silver_products(spark, sf_dir))


def q_dim_website_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_website_sessions(silver_website_sessions(spark, sf_dir))


def q_mart_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_product_performance(q_dim_products(spark, sf_dir),
                                    q_fact_order_items(spark, sf_dir))


def q_session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_metrics(q_dim_website_sessions(spark, sf_dir))


def q_order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_metrics(q_dim_website_sessions(spark, sf_dir),
                         q_fact_order_items(spark, sf_dir))


def q_mart_session_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_session_conversion(q_dim_website_sessions(spark, sf_dir),
                                   q_fact_order_items(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "bronze_extract_counts": bronze_extract_counts,
    "silver_website_sessions": silver_website_sessions,
    "silver_website_pageviews": silver_website_pageviews,
    "silver_orders": silver_orders,
    "silver_order_items": silver_order_items,
    "silver_products": silver_products,
    "silver_order_item_refunds": silver_order_item_refunds,
    "fact_order_items": q_fact_order_items,
    "dim_products": q_dim_products,
    "dim_website_sessions": q_dim_website_sessions,
    "session_metrics": q_session_metrics,
    "order_metrics": q_order_metrics,
    "mart_product_performance": q_mart_product_performance,
    "mart_session_conversion": q_mart_session_conversion,
    **RUN_QUERIES,
}
