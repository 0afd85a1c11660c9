"""Hot keys: one key holds a third of all rows.

Results are checked against the rule's direct formulation (join first, then
group), and the executed plans are checked for AQE's skew split of the hot
join partition (thresholds lowered so the effect shows at test size).
"""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from marlstone.operators import (
    fact_order_items, mart_product_performance, mart_session_conversion)

N = 30_000
HOT = 7


def final_plan(df) -> str:
    """Plan after execution (AQE's final plan; test-size results only)."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def forced_smj(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _silver(spark):
    """Silver-shaped inputs; a third of the items sit in order HOT and have
    product HOT; a third of the orders come from session HOT."""
    ids = spark.range(N)
    items = ids.select(
        F.col("id").cast("int").alias("order_item_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 5000)
         .cast("int").alias("order_id"),
        F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 97)
         .cast("int").alias("product_id"),
        (F.col("id") % 2 == 0).alias("is_primary_item"),
        (F.col("id") % 100 + 1).cast("double").alias("price_usd"),
        F.lit(1.0).alias("cogs_usd"))
    orders = spark.range(5000).select(
        F.col("id").cast("int").alias("order_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id")).cast("int")
         .alias("website_session_id"),
        F.lit(1).alias("user_id"))
    refunds = ids.where(F.col("id") % 10 == 0).select(
        F.col("id").cast("int").alias("order_item_id"),
        F.lit(2.0).alias("refund_amount_usd"))
    sessions = spark.range(5000).select(
        F.col("id").cast("int").alias("website_session_id"),
        F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("utm_source"),
        F.lit("c").alias("utm_campaign"),
        F.lit("d").alias("device_type"))
    return items, orders, refunds, sessions


def test_hot_order_fact_is_split_and_exact(spark, forced_smj):
    items, orders, refunds, _ = _silver(spark)
    fact = fact_order_items(items, orders, refunds)
    plan = final_plan(fact)
    assert "skew=true" in plan
    # every item's order exists, refunds are unique per item -> one row each
    assert fact.count() == N
    hot = fact.where(F.col("order_id") == HOT).count()
    assert hot == items.where(F.col("order_id") == HOT).count() >= N // 3


def test_hot_product_mart_matches_direct_formulation(spark, forced_smj):
    items, orders, refunds, _ = _silver(spark)
    fact = fact_order_items(items, orders, refunds)
    products = spark.range(100).select(
        F.col("id").cast("int").alias("product_id"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("product_name"))
    got = {r.product_id: tuple(r)[2:] for r in
           mart_product_performance(products, fact).collect()}
    direct = (products.join(fact, "product_id", "left")
              .groupBy("product_id", "product_name")
              .agg(F.count("order_item_id").alias("u"), F.sum("revenue_usd").alias("r"),
                   F.sum("refund_amount_usd").alias("f"),
                   F.sum("net_profit_usd").alias("p")))
    want = {r.product_id: tuple(r)[2:] for r in direct.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        for a, b in zip(got[k][1:], want[k][1:]):
            assert (a is None and b is None) or abs(a - b) < 1e-6
    assert got[HOT][0] >= N // 3


def test_hot_session_conversion_is_split_and_exact(spark, forced_smj):
    items, orders, refunds, sessions = _silver(spark)
    fact = fact_order_items(items, orders, refunds)
    mart = mart_session_conversion(sessions, fact)
    plan = final_plan(mart)
    assert "skew=true" in plan
    got = {r.utm_source: (r.total_sessions, r.total_orders) for r in mart.collect()}
    # brute force: distinct orders per source through the session map
    pairs = (fact.select("website_session_id", "order_id").distinct()
             .join(sessions, "website_session_id")
             .groupBy("utm_source").agg(F.count_distinct("order_id").alias("n")))
    want = {r.utm_source: r.n for r in pairs.collect()}
    assert {k: v[1] for k, v in got.items()} == want
    assert sum(v[0] for v in got.values()) == 5000


def test_hot_refund_item_is_split_and_exact(spark, forced_smj):
    """A third of all refunds are on one item: the refunds side of J2 is the
    hot one, which a left outer join could not split."""
    items, orders, _, _ = _silver(spark)
    m = 3 * N
    refunds = spark.range(m).select(
        F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % (2 * N))
         .cast("int").alias("order_item_id"),
        (F.col("id") % 7).cast("double").alias("refund_amount_usd"))
    # plus items whose id is NULL: kept once, with no refund
    nulls = spark.range(5).select(
        F.lit(None).cast("int").alias("order_item_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(1).cast("int").alias("order_id"),
        F.lit(1).cast("int").alias("product_id"),
        F.lit(True).alias("is_primary_item"),
        F.lit(3.0).alias("price_usd"),
        F.lit(1.0).alias("cogs_usd"))
    items = items.unionByName(nulls)
    fact = fact_order_items(items, orders, refunds)
    plan = final_plan(fact)
    assert re.search(r"SortMergeJoin\(skew=true\) \[order_item_id#\d+\], "
                     r"\[order_item_id#\d+\], Inner", plan)
    direct = (items.join(refunds, "order_item_id", "left")
              .join(orders.select("order_id"), "order_id"))
    cols = ["order_item_id", "order_id", "refund"]
    got = (fact.select("order_item_id", "order_id",
                       F.col("refund_amount_usd").alias("refund"))
           .groupBy(*cols).count())
    want = (direct.select("order_item_id", "order_id",
                          F.coalesce("refund_amount_usd", F.lit(0.0)).alias("refund"))
            .groupBy(*cols).count())
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    hot = refunds.where(F.col("order_item_id") == HOT).count()
    assert hot >= m // 3
    assert fact.where(F.col("order_item_id") == HOT).count() == hot
    assert fact.where(F.col("order_item_id").isNull()).count() == 5
