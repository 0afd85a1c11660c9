"""The registered queries' results in SQL (DuckDB dialect), a second
formulation of the rules.

Silver is generated from a table of rules, one per output column. The fact gives
each item the list of its refunds and unnests it; the product mart adds up
per-product totals; the conversion mart stacks sessions and (session, order)
pairs and counts both in one grouping. ``silver_sql`` and ``gold_sql`` are also
what the property tests hold the operators against.
"""

from __future__ import annotations

#: output column: (input column, rule). Rules: see ``_COLUMN``.
SILVER_RULES: dict[str, tuple[str, dict[str, tuple[str, str]]]] = {
    "website_sessions": ("staging_website_sessions", {
        "website_session_id": ("website_session_id", "whole"), "created_at": ("created_at", "time"),
        "user_id": ("user_id", "whole"), "is_repeat_session": ("is_repeat_session", "flag"),
        "utm_source": ("utm_source", "lower:direct"), "utm_campaign": ("utm_campaign", "lower:none"),
        "utm_content": ("utm_content", "lower:none"), "device_type": ("device_type", "lower:unknown"),
        "http_referer": ("http_referer", "cased:direct")}),
    "website_pageviews": ("staging_website_pageviews", {
        "website_pageview_id": ("website_pageview_id", "whole"), "created_at": ("create_at", "time"),
        "website_session_id": ("website_session_id", "whole"), "pageview_url": ("pageview_url", "lower")}),
    "orders": ("staging_orders", {
        "order_id": ("order_id", "whole"), "created_at": ("create_at", "time"),
        "website_session_id": ("website_session_id", "whole"), "user_id": ("user_id", "whole"),
        "primary_product_id": ("primary_product_id", "whole"), "items_purchased": ("items_purchased", "whole"),
        "price_usd": ("price_usd", "money"), "cogs_usd": ("cogs_usd", "money")}),
    "order_items": ("staging_order_items", {
        "order_item_id": ("order_item_id", "whole"), "created_at": ("create_at", "time"),
        "order_id": ("order_id", "whole"), "product_id": ("product_id", "whole"),
        "is_primary_item": ("is_primary_item", "flag"), "price_usd": ("price_usd", "money"),
        "cogs_usd": ("cogs_usd", "money")}),
    "products": ("staging_products", {
        "product_id": ("product_id", "whole"), "created_at": ("create_at", "time"),
        "product_name": ("product_name", "cased")}),
    "order_item_refunds": ("staging_order_item_refunds", {
        "order_item_refund_id": ("order_item_refund_id", "whole"), "created_at": ("create_at", "time"),
        "order_item_id": ("order_item_id", "whole"), "order_id": ("order_id", "whole"),
        "refund_amount_usd": ("refund_amount_usd", "money")}),
}
#: Tables whose rows need a price that is known and not negative.
PRICED = ("orders", "order_items")

_COLUMN = {"whole": "{c}::INTEGER", "time": "{c}::TIMESTAMP", "money": "{c}::DOUBLE", "flag": "({c} <> 0)",
           "lower": "lower(trim({c}))", "cased": "trim({c})"}


def _column(source: str, rule: str) -> str:
    kind, _, default = rule.partition(":")
    plain = _COLUMN[kind].format(c=source)
    return f"CASE WHEN {source} IS NULL THEN '{default}' ELSE {plain} END" if default else plain


def silver_sql(table: str, source: str | None = None) -> str:
    """SELECT of a Silver table from its Bronze table, or from ``source``."""
    bronze, rules = SILVER_RULES[table]
    columns = ", ".join(f"{_column(c, rule)} AS {name}" for name, (c, rule) in rules.items())
    kept = " WHERE NOT (price_usd IS NULL OR price_usd < 0)" if table in PRICED else ""
    return f"SELECT {columns} FROM {source or bronze}{kept}"


#: Amounts times this are whole numbers: they are 0.01 or more, or differences of such, so their last bit is 2^-59
#: at the least; below 2^34 they fit 128 bits in any sum of 2^33 rows.
_UNIT = float(1 << 59)


def _scaled(column: str) -> str:
    return f"sum(({column} * {_UNIT!r}::DOUBLE)::HUGEINT)"


def _unscaled(column: str) -> str:
    """The double nearest the exact sum: by way of its digits, since a cast of a wide integer rounds twice."""
    return f"sum({column})::HUGEINT::VARCHAR::DOUBLE / {_UNIT!r}::DOUBLE"


def gold_sql(prefix: str = "") -> str:
    """Common table expressions of the Gold tables over Silver tables named
    ``prefix`` and their name."""
    return f"""
refund_lists AS (
  SELECT order_item_id AS item, list(refund_amount_usd) AS amounts
  FROM {prefix}order_item_refunds GROUP BY ALL
),
item_refunds AS (
  SELECT i.*, unnest(CASE WHEN l.item IS NULL THEN [NULL] ELSE l.amounts END) AS amount
  FROM {prefix}order_items i LEFT JOIN refund_lists l ON l.item = i.order_item_id
),
fact_order_items AS (
  SELECT x.order_item_id, x.order_id, parent.created_at AS order_date, parent.website_session_id,
         parent.user_id, x.product_id, x.is_primary_item, x.price_usd AS revenue_usd, x.cogs_usd,
         ifnull(x.amount, 0::DOUBLE) AS refund_amount_usd,
         (x.price_usd - x.cogs_usd) - ifnull(x.amount, 0::DOUBLE) AS net_profit_usd
  FROM {prefix}orders parent, item_refunds x
  WHERE parent.order_id = x.order_id
),
dim_products AS (FROM {prefix}products SELECT product_id, product_name, created_at),
dim_website_sessions AS (
  FROM {prefix}website_sessions
  SELECT website_session_id, created_at AS session_start_time, * EXCLUDE (website_session_id, created_at)
),
product_totals AS (
  FROM fact_order_items
  SELECT product_id, count(order_item_id) AS units, {_scaled('revenue_usd')} AS gross,
         {_scaled('refund_amount_usd')} AS back, {_scaled('net_profit_usd')} AS profit
  GROUP BY product_id
),
mart_product_performance AS (
  FROM dim_products LEFT JOIN product_totals t USING (product_id)
  SELECT product_id, product_name, ifnull(sum(units), 0)::BIGINT AS total_units_sold,
         {_unscaled('gross')} AS gross_revenue_usd, {_unscaled('back')} AS total_refund_usd,
         {_unscaled('profit')} AS net_profit_usd
  GROUP BY ALL
),
session_orders AS (
  SELECT DISTINCT website_session_id, order_id FROM fact_order_items
),
channel_events AS (
  SELECT utm_source, utm_campaign, device_type, (website_session_id IS NOT NULL)::INTEGER AS visit, NULL AS bought,
         true AS listed
  FROM dim_website_sessions
  UNION ALL
  SELECT utm_source, utm_campaign, device_type, 0, order_id, false
  FROM session_orders JOIN dim_website_sessions USING (website_session_id)
),
channel_counts AS (
  FROM channel_events
  SELECT utm_source, utm_campaign, device_type, sum(visit)::BIGINT AS visits, count(DISTINCT bought) AS orders,
         (utm_source IS NULL OR utm_campaign IS NULL OR device_type IS NULL) AS unnamed
  GROUP BY ALL
),
session_metrics AS (
  FROM channel_counts SELECT utm_source, utm_campaign, device_type, visits AS total_sessions
),
order_metrics AS (
  FROM channel_events SELECT utm_source, utm_campaign, device_type, count(DISTINCT bought) AS total_orders
  WHERE NOT listed GROUP BY ALL
),
mart_session_conversion AS (
  FROM channel_counts
  SELECT utm_source, utm_campaign, device_type, visits AS total_sessions,
         CASE WHEN unnamed THEN 0 ELSE orders END AS total_orders,
         CASE WHEN visits > 0 THEN round(100.0 * (CASE WHEN unnamed THEN 0 ELSE orders END)::DOUBLE / visits, 2) END
           AS conversion_rate_percent
)"""


#: The derivation of the Bronze tables from the generated ones (see
#: ``sources/testdata``).
BRONZE_SQL = """
staging_website_sessions AS (
  SELECT event_id::INTEGER AS website_session_id, ts::TIMESTAMP AS created_at, user_id::INTEGER AS user_id,
         (event_id % 2)::INTEGER AS is_repeat_session,
         CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN '  '
              ELSE concat('  ', upper(event_type), ' ') END AS utm_source,
         CASE WHEN event_id % 4 <> 0 THEN format(' Camp{} ', event_id % 4) END AS utm_campaign,
         [NULL, ' Banner' || chr(160), 'Banner' || chr(9), 'Banner ', 'Banner '][event_id % 5 + 1] AS utm_content,
         [' Desktop', 'MOBILE', NULL][event_id % 3 + 1] AS device_type,
         CASE WHEN event_id % 7 <> 0 THEN format(' https://Www.Site{}.com ', event_id % 7) END AS http_referer
  FROM events
),
staging_website_pageviews AS (
  SELECT event_id::INTEGER AS website_pageview_id, ts::TIMESTAMP AS create_at,
         event_id::INTEGER AS website_session_id,
         CASE WHEN event_id % 9 <> 0 THEN concat(' /', upper(event_type), ' ') END AS pageview_url
  FROM events
),
staging_orders AS (
  SELECT o_orderkey::INTEGER AS order_id, o_orderdate::TIMESTAMP AS create_at,
         CASE WHEN o_orderkey % 11 <> 5 THEN (o_orderkey - o_orderkey % 8)::INTEGER END AS website_session_id,
         o_custkey::INTEGER AS user_id, o_custkey::INTEGER AS primary_product_id, 1 AS items_purchased,
         (CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice * (CASE WHEN o_orderkey % 40 = 0 THEN -1 ELSE 1 END)
          END)::DECIMAL(12,2) AS price_usd,
         floor(o_totalprice / 2)::DECIMAL(12,2) AS cogs_usd
  FROM orders
),
line AS (FROM lineitem SELECT l_orderkey * 10 + l_linenumber AS item, *),
staging_order_items AS (
  SELECT item::INTEGER AS order_item_id, l_shipdate::TIMESTAMP AS create_at,
         (CASE WHEN item % 17 = 3 THEN -l_orderkey ELSE l_orderkey END)::INTEGER AS order_id,
         (CASE WHEN l_partkey % 10 = 3 THEN -1 - l_partkey ELSE l_partkey END)::INTEGER AS product_id,
         (l_linenumber = 1)::INTEGER AS is_primary_item,
         (CASE WHEN item % 101 <> 0 THEN l_extendedprice - 2000 END)::DECIMAL(12,2) AS price_usd,
         (l_quantity * 10)::DECIMAL(12,2) AS cogs_usd
  FROM line
),
staging_products AS (
  SELECT p_partkey::INTEGER AS product_id, TIMESTAMP '2024-01-01 09:00:00' AS create_at,
         concat(' ', p_name, ' ') AS product_name
  FROM part
),
staging_order_item_refunds AS (
  SELECT item::INTEGER AS order_item_refund_id, l_shipdate::TIMESTAMP AS create_at, item::INTEGER AS order_item_id,
         l_orderkey::INTEGER AS order_id,
         (CASE WHEN item % 13 = 0 THEN -l_extendedprice ELSE l_extendedprice END)::DECIMAL(12,2) AS refund_amount_usd
  FROM line WHERE l_returnflag = 'R'
)"""


def _with(select: str) -> str:
    silver = ",\n".join(f"silver_{t} AS ({silver_sql(t)})" for t in SILVER_RULES)
    return f"WITH {BRONZE_SQL},\n{silver},{gold_sql('silver_')}\n{select}"


def _counted(zone: str, name: str, relation: str) -> str:
    return (f"SELECT '{zone}' AS zone, '{name}' AS table_name, count(*) AS observed_rows, count(*) AS counted_rows "
            f"FROM {relation}")


_GOLD = ("fact_order_items", "dim_products", "dim_website_sessions", "mart_product_performance",
         "mart_session_conversion")

ORACLE_SQL: dict[str, str] = {
    "run_row_counts": _with("\nUNION ALL ".join([
        *[_counted("bronze", bronze, bronze) for bronze, _ in SILVER_RULES.values()],
        *[_counted("silver", t, f"silver_{t}") for t in SILVER_RULES], *[_counted("gold", t, t) for t in _GOLD]])),
    **{f"run_{t}": _with(f"SELECT * FROM {t}") for t in ("mart_product_performance", "mart_session_conversion")},
    "bronze_extract_counts": _with("\nUNION ALL ".join(
        f"SELECT '{bronze}' AS table_name, count(*) AS row_count FROM {bronze}" for bronze, _ in SILVER_RULES.values())),
    **{f"silver_{t}": _with(f"SELECT * FROM silver_{t}") for t in SILVER_RULES},
    **{t: _with(f"SELECT * FROM {t}") for t in (
        "fact_order_items", "dim_products", "dim_website_sessions", "session_metrics", "order_metrics",
        "mart_product_performance", "mart_session_conversion")},
}
