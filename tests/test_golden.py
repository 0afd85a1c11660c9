"""Golden tests on the shop's sample rows (FIXTURES.md §2)."""

from marlstone.operators import (
    CLEANERS, dim_products, dim_website_sessions, fact_order_items,
    mart_product_performance, mart_session_conversion)
from marlstone.schemas import BRONZE_TO_SILVER, GOLD, SILVER, same_columns
from tests.fixtures import bronze_frames


def _silver(spark):
    bronze = bronze_frames(spark)
    return {BRONZE_TO_SILVER[t]: CLEANERS[t](df) for t, df in bronze.items()}


def _gold(spark):
    s = _silver(spark)
    fact = fact_order_items(s["order_items"], s["orders"], s["order_item_refunds"])
    dp = dim_products(s["products"])
    ds = dim_website_sessions(s["website_sessions"])
    return {
        "fact_order_items": fact,
        "dim_products": dp,
        "dim_website_sessions": ds,
        "mart_product_performance": mart_product_performance(dp, fact),
        "mart_session_conversion": mart_session_conversion(ds, fact),
    }


def test_silver_schemas(spark):
    for name, df in _silver(spark).items():
        assert same_columns(df.schema, SILVER[name]), name


def test_gold_schemas(spark):
    for name, df in _gold(spark).items():
        assert same_columns(df.schema, GOLD[name]), name


def test_fact_rows(spark):
    fact = _gold(spark)["fact_order_items"]
    got = sorted(
        (r.order_item_id, r.order_id, r.website_session_id, r.product_id,
         r.revenue_usd, r.cogs_usd, r.refund_amount_usd, r.net_profit_usd)
        for r in fact.collect())
    assert got == [
        (601, 501, 101, 1, 19.99, 9.0, 0.0, 10.989999999999998),
        (602, 502, 105, 3, 25.0, 10.0, 0.0, 15.0),
        (603, 502, 105, 2, 20.0, 8.0, 20.0, -8.0),
    ]


def test_product_mart(spark):
    mart = _gold(spark)["mart_product_performance"]
    got = sorted(tuple(r) for r in mart.collect())
    assert got == [
        (1, "The Original Mr. Fuzzy", 1, 19.99, 0.0, 10.989999999999998),
        (2, "Mini Mr. Fuzzy", 1, 20.0, 20.0, -8.0),
        (3, "Love Bear", 1, 25.0, 0.0, 15.0),
        (4, "Birthday Bear", 0, None, None, None),
    ]


def test_session_conversion_mart(spark):
    mart = _gold(spark)["mart_session_conversion"]
    got = sorted(tuple(r) for r in mart.collect())
    assert got == [
        ("bsearch", "brand", "desktop", 1, 0, 0.0),
        ("direct", "none", "mobile", 1, 0, 0.0),
        ("gsearch", "nonbrand", "desktop", 2, 1, 50.0),
        ("social", "summer_sale", "mobile", 1, 1, 100.0),
    ]


def test_session_dimension_renames_start_time(spark):
    ds = _gold(spark)["dim_website_sessions"]
    row = ds.where("website_session_id = 102").first()
    assert row.session_start_time.isoformat() == "2026-06-10T10:05:00"
    assert (row.utm_source, row.utm_campaign, row.utm_content) == ("direct", "none", "none")
    assert row.is_repeat_session is False
