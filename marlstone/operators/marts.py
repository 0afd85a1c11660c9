"""Gold marts.

Both marts aggregate the fact, the largest table, down to a few rows per key
*before* anything else touches it:

* product performance aggregates the fact by product_id first (partial
  aggregation on the map side, then one shuffle of at most one row per
  product per map task) and only then joins the product dimension. A hot
  product holding a third of all fact rows therefore never lands in one
  task; the rule's "dimension LEFT JOIN fact, then GROUP BY" is reproduced
  exactly by merging the per-product partials per dimension row.
* session conversion keeps the rule's shape (join, then COUNT DISTINCT); the
  only full-size shuffle is the fact -> session join, whose skewed partitions
  AQE splits. The distinct orders of a channel are counted in bitmaps of id
  buckets that are built before the shuffle, so the few, skewed channels never
  gather a row for each order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import merged_sums, rate_percent, slot_sums

CHANNEL_KEYS = ["utm_source", "utm_campaign", "device_type"]


#: Sum columns of the product mart and the fact columns they add up.
PRODUCT_SUMS = {"gross_revenue_usd": "revenue_usd", "total_refund_usd": "refund_amount_usd",
                "net_profit_usd": "net_profit_usd"}


def product_fact_totals(fact: DataFrame) -> DataFrame:
    """Per-product partial totals of the fact (pre-aggregation for C5): a few rows for each product, one for
    each size its amounts have (see ``functions/exact``)."""
    return slot_sums(fact, ["product_id"], PRODUCT_SUMS,
                     {"units": F.col("order_item_id").isNotNull().cast("long")})


def mart_product_performance(dim_products: DataFrame,
                             fact: DataFrame) -> DataFrame:
    """Every product, with units, revenue, refunds and profit.

    A1: COUNT of fact item ids, so 0 for an unsold product; A2 revenue, A3
    refunds, A4 profit: SUMs that stay NULL for an unsold product; J3: fact rows whose product is not in
    the dimension are not reported; A5: grouped by (product_id, name). The sums are exact sums of the
    doubles, rounded once: the same at any number of partitions.
    """
    totals = product_fact_totals(fact)
    joined = (dim_products.select("product_id", "product_name")
              .join(totals, on="product_id", how="left"))
    mart = merged_sums(joined, ["product_id", "product_name"], list(PRODUCT_SUMS), ["units"])
    return mart.select("product_id", "product_name",
                       F.coalesce("units", F.lit(0).cast("bigint")).alias("total_units_sold"), *PRODUCT_SUMS)


def session_metrics(dim_sessions: DataFrame) -> DataFrame:
    """Sessions per channel (utm_source, utm_campaign, device_type)."""
    return dim_sessions.groupBy(*CHANNEL_KEYS).agg(
        F.count("website_session_id").alias("total_sessions"))


def distinct_ids(rows: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Exact COUNT(DISTINCT ``column``) of a whole-number column by ``keys``, as ``out``.

    Ids are cut into buckets of 32,768 neighbours. A task turns the ids it has of a key and bucket into one
    bitmap of 4 KB before the shuffle (by sorting, so its memory does not grow with the buckets), bitmaps of a
    bucket are united, and their bits are counted. What is shuffled is a bitmap for each task, key and
    bucket, never a row for each id: a bucket met by many rows costs 4 KB at most, and one with few ids
    compresses to about the size of those. Every id above -2^63 has its place in one bucket; NULL is
    not counted. A key that has NULL ids alone has 0.
    """
    wide = rows.select(*keys, F.col(column).cast("long").alias("_id"))
    at = wide.select(*keys, F.bitmap_bucket_number("_id").alias("_bucket"), F.bitmap_bit_position("_id").alias("_bit"))
    bits = at.groupBy(*keys, "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    # NULL ids are a bucket of their own, without a bit
    n = F.when(F.col("_bucket").isNull(), F.lit(0).cast("long")).otherwise(F.bitmap_count("_bits"))
    return bits.groupBy(*keys).agg(F.sum(n).alias(out))


def order_metrics(dim_sessions: DataFrame, fact: DataFrame) -> DataFrame:
    """J4 + A7: distinct orders per channel; orders without a known session
    (NULL or unknown website_session_id) are not counted."""
    sessions = dim_sessions.select("website_session_id", *CHANNEL_KEYS)
    orders = fact.select("website_session_id", "order_id")
    return distinct_ids(orders.join(sessions, on="website_session_id", how="inner"),
                        CHANNEL_KEYS, "order_id", "total_orders")


def mart_session_conversion(dim_sessions: DataFrame,
                            fact: DataFrame) -> DataFrame:
    """Sessions, orders and conversion rate (%) per channel.

    J5 is a left join on plain equality of the three keys (a NULL key never
    matches); channels without orders get 0 orders and a 0.0 rate. The rate
    can exceed 100 when sessions place several orders.
    """
    sm = session_metrics(dim_sessions)
    om = order_metrics(dim_sessions, fact)
    joined = sm.join(om, on=CHANNEL_KEYS, how="left")
    orders = F.coalesce(F.col("total_orders"), F.lit(0).cast("bigint"))
    return joined.select(
        *CHANNEL_KEYS,
        "total_sessions",
        orders.alias("total_orders"),
        rate_percent(orders, "total_sessions").alias("conversion_rate_percent"),
    )
