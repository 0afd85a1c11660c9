"""Silver -> Gold star schema.

Plan shape: each input is narrowed to the columns the fact needs before the
joins, so the parquet scans read only those columns and the shuffles carry
only them. Physical join strategy is left to the optimizer: with AQE on, a
side whose *measured* size is under the adaptive broadcast threshold is
broadcast at runtime, anything larger is a sort-merge join on the key, and
AQE splits skewed partitions. Nothing is broadcast by hint or by estimate.

J2 (items LEFT JOIN refunds) is, for every size, the union of an inner join
(items with their refunds, one row per refund) and an anti join (items
without any refund). The rows are exactly those of the left join, but the
skew behaviour differs where it matters: an order item id is unique among
items, so the only hot key of J2 is an item with very many refunds, i.e. on
the refunds side. AQE cannot split the right side of a left outer join (a
split would repeat the unmatched left rows); it can split either side of an
inner join. The anti join only needs the *set* of refunded item ids, so its
right side is de-duplicated first, which partial aggregation does on the map
side: a hot item id arrives as one row per map task. The items exchange is
shared by both branches (one scan, one shuffle of the items).

Join order: J2 runs before J1 (items JOIN orders). The two orders give the
same rows, because J2's condition only involves item columns, but the later
exchange then carries the items plus one refund column instead of the items
plus three order columns. J1 is skew-safe as an inner join: AQE splits a hot
order_id on the items side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import net_profit, zero_if_null


def refunds_left_join(items: DataFrame, refunds: DataFrame) -> DataFrame:
    """``items LEFT JOIN refunds ON order_item_id`` as inner plus anti join.

    Same rows and multiplicity as the left join (an item with n refunds
    appears n times, an item without refunds once with a NULL refund, an item
    with a NULL id once with a NULL refund), but skew on the refunds side can
    be split. Both joins read the same non-NULL-id items, so their exchange is
    built once and reused; items with a NULL id (which match nothing) pass
    through a map-only branch whose ``IS NULL`` filter a Parquet source
    answers from row-group statistics.
    """
    key = F.col("order_item_id")
    # the refund columns of an unmatched item: NULL, typed like the refunds
    no_refund = [F.lit(None).cast(f.dataType).alias(f.name)
                 for f in refunds.schema.fields if f.name != "order_item_id"]
    keyed = items.where(key.isNotNull())
    refunded = keyed.join(refunds, on="order_item_id", how="inner")
    refunded_ids = refunds.select("order_item_id").distinct()
    unrefunded = keyed.join(refunded_ids, on="order_item_id", how="left_anti")
    unkeyed = items.where(key.isNull())
    return (refunded
            .unionByName(unrefunded.select("*", *no_refund))
            .unionByName(unkeyed.select("*", *no_refund)))


def fact_order_items(order_items: DataFrame, orders: DataFrame,
                     refunds: DataFrame) -> DataFrame:
    """One row per (order item, matching refund).

    J1 inner join on order_id drops items whose order was rejected by F1 or
    is missing. J2 left join on order_item_id keeps unrefunded items and
    *repeats* an item once per refund it has (its revenue then counts once
    per repeat in the marts), exactly like the rule it reproduces.
    """
    oi = order_items.select(
        "order_item_id", "order_id", "product_id", "is_primary_item",
        "price_usd", "cogs_usd")
    o = orders.select(
        "order_id", F.col("created_at").alias("order_date"),
        "website_session_id", "user_id")
    r = refunds.select("order_item_id", "refund_amount_usd")

    joined = (refunds_left_join(oi, r)
              .join(o, on="order_id", how="inner"))
    return joined.select(
        "order_item_id",
        "order_id",
        "order_date",
        "website_session_id",
        "user_id",
        "product_id",
        "is_primary_item",
        F.col("price_usd").alias("revenue_usd"),
        "cogs_usd",
        zero_if_null("refund_amount_usd").alias("refund_amount_usd"),
        net_profit("price_usd", "cogs_usd", "refund_amount_usd")
        .alias("net_profit_usd"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    """Column order product_id, product_name, created_at."""
    return products.select("product_id", "product_name", "created_at")


def dim_website_sessions(sessions: DataFrame) -> DataFrame:
    """created_at becomes session_start_time; all other columns kept."""
    return sessions.select(
        "website_session_id",
        F.col("created_at").alias("session_start_time"),
        "user_id",
        "is_repeat_session",
        "utm_source",
        "utm_campaign",
        "utm_content",
        "device_type",
        "http_referer",
    )
