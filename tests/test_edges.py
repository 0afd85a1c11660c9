"""Edge cases absent from the sample rows (FIXTURES.md section 3)."""

from datetime import datetime as dt
from decimal import Decimal as D

import pytest

from marlstone.operators import (
    clean_order_items, clean_orders, clean_order_item_refunds, clean_products,
    clean_website_pageviews, clean_website_sessions, dim_products,
    dim_website_sessions, fact_order_items, mart_product_performance,
    mart_session_conversion)
from marlstone.schemas import BRONZE

T0 = dt(2026, 6, 1, 12, 0, 0)


def _df(spark, table, rows):
    return spark.createDataFrame(rows, BRONZE[table])


def _session(sid, src="gsearch", camp="c", dev="desktop", ref="r", flag=0,
             content="x"):
    return (sid, T0, 1, flag, src, camp, content, dev, ref)


def test_price_filter_on_orders(spark):
    orders = _df(spark, "staging_orders", [
        (1, T0, 1, 1, 1, 1, None, D("1.00")),
        (2, T0, 1, 1, 1, 1, D("-0.01"), D("1.00")),
        (3, T0, 1, 1, 1, 1, D("0.00"), D("1.00")),
        (4, T0, 1, 1, 1, 1, D("5.25"), None),
    ])
    got = sorted((r.order_id, r.price_usd) for r in clean_orders(orders).collect())
    assert got == [(3, 0.0), (4, 5.25)]


def test_price_filter_on_items(spark):
    items = _df(spark, "staging_order_items", [
        (10, T0, 1, 1, 1, None, D("1.00")),
        (11, T0, 1, 1, 1, D("-0.01"), D("1.00")),
        (12, T0, 1, 1, 2, D("0.00"), D("1.00")),
    ])
    rows = clean_order_items(items).collect()
    assert [(r.order_item_id, r.is_primary_item) for r in rows] == [(12, True)]


def test_text_defaults_blank_case_and_spaces(spark):
    sessions = _df(spark, "staging_website_sessions", [
        (1, T0, 1, 0, "  ", None, " Banner\u00a0", None, " HTTPS://X "),
        (2, T0, 1, 2, None, "Brand", "Ad\t", "MOBILE", None),
        (3, T0, 1, None, " GSearch ", "\u3000nonbrand\u2003", None, " Desktop", "\u00a0https://Y.com\u00a0"),
    ])
    got = {r.website_session_id: r for r in clean_website_sessions(sessions).collect()}
    assert got[1].utm_source == ""          # blank is not NULL: no default
    assert got[1].utm_campaign == "none"
    assert got[1].utm_content == "banner"   # no-break space trimmed
    assert got[1].device_type == "unknown"
    assert got[1].http_referer == "HTTPS://X"  # trimmed, case kept
    assert got[2].utm_source == "direct"
    assert got[2].utm_content == "ad\t"     # tab is not trimmed
    assert got[2].http_referer == "direct"
    assert got[2].is_repeat_session is True  # flag 2 -> true
    assert got[3].is_repeat_session is None
    assert got[3].utm_source == "gsearch"
    assert got[3].utm_campaign == "nonbrand"
    assert got[3].device_type == "desktop"
    assert got[3].http_referer == "https://Y.com"


def test_pageview_url_null_stays_null(spark):
    pv = _df(spark, "staging_website_pageviews", [
        (1, T0, 1, None), (2, T0, 1, " /Home ")])
    got = dict((r.website_pageview_id, r.pageview_url)
               for r in clean_website_pageviews(pv).collect())
    assert got == {1: None, 2: "/home"}


def test_product_name_trimmed_case_kept(spark):
    p = _df(spark, "staging_products", [(1, T0, "  Love Bear "), (2, T0, None)])
    got = dict((r.product_id, r.product_name) for r in clean_products(p).collect())
    assert got == {1: "Love Bear", 2: None}


def _fact(spark, orders, items, refunds):
    return fact_order_items(
        clean_order_items(_df(spark, "staging_order_items", items)),
        clean_orders(_df(spark, "staging_orders", orders)),
        clean_order_item_refunds(_df(spark, "staging_order_item_refunds", refunds)))


def test_fact_cascade_orphans_and_refund_fanout(spark):
    orders = [
        (1, T0, 100, 7, 1, 2, D("10.00"), D("4.00")),
        (2, T0, 100, 7, 1, 1, D("-1.00"), D("4.00")),   # rejected order
        (3, T0, None, 8, 1, 1, D("3.00"), D("1.00")),   # no session
    ]
    items = [
        (11, T0, 1, 1, 1, D("6.00"), D("2.00")),
        (12, T0, 1, 2, 0, D("4.00"), D("2.00")),
        (21, T0, 2, 1, 1, D("5.00"), D("1.00")),   # order was rejected
        (31, T0, 3, 9, 1, D("3.00"), D("1.00")),   # product unknown
        (41, T0, 4, 1, 1, D("3.00"), D("1.00")),   # order missing
    ]
    refunds = [
        (901, T0, 11, 1, D("1.00")),
        (902, T0, 11, 1, D("2.00")),   # second refund on the same item
        (903, T0, 12, 1, D("-0.50")),  # negative refund is kept
    ]
    fact = _fact(spark, orders, items, refunds)
    got = sorted((r.order_item_id, r.refund_amount_usd, r.net_profit_usd,
                  r.website_session_id) for r in fact.collect())
    assert got == [
        (11, 1.0, 3.0, 100),
        (11, 2.0, 2.0, 100),
        (12, -0.5, 2.5, 100),
        (31, 0.0, 2.0, None),
    ]

    products = dim_products(clean_products(_df(spark, "staging_products", [
        (1, T0, "A"), (2, T0, "B"), (5, T0, "Unsold")])))
    mart = {r.product_id: r for r in mart_product_performance(products, fact).collect()}
    assert set(mart) == {1, 2, 5}              # product 9 is not reported
    assert mart[1].total_units_sold == 2       # fan-out counts the item twice
    assert mart[1].gross_revenue_usd == 12.0
    assert mart[1].total_refund_usd == 3.0
    assert mart[5].total_units_sold == 0
    assert mart[5].gross_revenue_usd is None


def test_conversion_ignores_orders_without_known_session(spark):
    sessions = dim_website_sessions(clean_website_sessions(
        _df(spark, "staging_website_sessions", [_session(100), _session(200, src="other")])))
    orders = [
        (1, T0, 100, 7, 1, 1, D("1.00"), D("1.00")),
        (2, T0, 100, 7, 1, 1, D("1.00"), D("1.00")),   # two orders, one session
        (3, T0, None, 7, 1, 1, D("1.00"), D("1.00")),  # NULL session
        (4, T0, 999, 7, 1, 1, D("1.00"), D("1.00")),   # unknown session
    ]
    items = [(i, T0, i, 1, 1, D("1.00"), D("0.50")) for i in (1, 2, 3, 4)]
    items.append((5, T0, 1, 2, 0, D("1.00"), D("0.50")))  # 2nd item, same order
    fact = _fact(spark, orders, items, [])
    got = sorted(tuple(r) for r in mart_session_conversion(sessions, fact).collect())
    assert got == [
        ("gsearch", "c", "desktop", 1, 2, 200.0),
        ("other", "c", "desktop", 1, 0, 0.0),
    ]


def test_conversion_rate_rounding(spark):
    # 23 orders in 4000 sessions -> 0.575 %, reported 0.57 (scale, then round)
    sessions = dim_website_sessions(spark.range(4000).selectExpr(
        "CAST(id AS INT) AS website_session_id",
        "CAST(NULL AS TIMESTAMP_NTZ) AS session_start_time",
        "1 AS user_id", "false AS is_repeat_session",
        "'a' AS utm_source", "'b' AS utm_campaign", "'c' AS utm_content",
        "'d' AS device_type", "'e' AS http_referer")
        .withColumnRenamed("session_start_time", "created_at"))
    fact = spark.range(23).selectExpr(
        "CAST(id AS INT) AS order_id", "CAST(id AS INT) AS website_session_id")
    mart = mart_session_conversion(sessions, fact).first()
    assert (mart.total_sessions, mart.total_orders) == (4000, 23)
    assert mart.conversion_rate_percent == 0.57


def test_refunds_left_join_equals_left_join(spark):
    """J2 helper: same rows as a plain left join, for any refund
    columns, with repeated, missing and NULL item ids on both sides."""
    from marlstone.operators.model import refunds_left_join
    items = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "c"), (None, "n1"), (None, "n2")],
        "order_item_id int, tag string")
    refunds = spark.createDataFrame(
        [(2, 5.0, 20), (2, 6.0, 21), (3, None, 22), (9, 1.0, 23), (None, 7.0, 24)],
        "order_item_id int, refund_amount_usd double, refund_id int")
    got = refunds_left_join(items, refunds)
    want = items.join(refunds, "order_item_id", "left")
    assert sorted(got.columns) == sorted(want.columns)
    assert got.schema["refund_id"].dataType == want.schema["refund_id"].dataType
    cols = sorted(want.columns)
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0
    assert got.count() == 6
