"""Sample source rows of the shop.

Used to seed an empty source (``python -m marlstone seed``) and as golden
test input. Fixed values: the sample rows the source is seeded with, in the
column order of the Bronze schemas.
"""

from datetime import datetime as dt
from decimal import Decimal as D

PRODUCTS = [
    (1, dt(2026, 1, 1, 9, 0, 0), "The Original Mr. Fuzzy"),
    (2, dt(2026, 1, 1, 9, 0, 0), "Mini Mr. Fuzzy"),
    (3, dt(2026, 2, 15, 9, 0, 0), "Love Bear"),
    (4, dt(2026, 3, 1, 9, 0, 0), "Birthday Bear"),
]

SESSIONS = [
    (101, dt(2026, 6, 10, 10, 0, 0), 1001, 0, "gsearch", "nonbrand", "bar_code", "desktop", "https://www.google.com"),
    (102, dt(2026, 6, 10, 10, 5, 0), 1002, 0, None, None, None, "mobile", "https://www.bing.com"),
    (103, dt(2026, 6, 11, 11, 0, 0), 1003, 0, "bsearch", "brand", "banner", "desktop", "https://www.bing.com"),
    (104, dt(2026, 6, 11, 14, 0, 0), 1001, 1, "gsearch", "nonbrand", "bar_code", "desktop", "https://www.google.com"),
    (105, dt(2026, 6, 12, 9, 0, 0), 1004, 0, "social", "summer_sale", "ad_post", "mobile", "https://www.facebook.com"),
]

PAGEVIEWS = [
    (201, dt(2026, 6, 10, 10, 0, 5), 101, "/home"),
    (202, dt(2026, 6, 10, 10, 1, 0), 101, "/products"),
    (203, dt(2026, 6, 10, 10, 2, 0), 101, "/cart"),
    (204, dt(2026, 6, 10, 10, 3, 0), 101, "/shipping"),
    (205, dt(2026, 6, 10, 10, 5, 10), 102, "/home"),
    (206, dt(2026, 6, 11, 11, 0, 5), 103, "/home"),
    (207, dt(2026, 6, 12, 9, 0, 5), 105, "/home"),
    (208, dt(2026, 6, 12, 9, 1, 30), 105, "/products"),
]

ORDERS = [
    (501, dt(2026, 6, 10, 10, 3, 30), 101, 1001, 1, 1, D("19.99"), D("9.00")),
    (502, dt(2026, 6, 12, 9, 5, 0), 105, 1004, 3, 2, D("45.00"), D("18.00")),
]

ORDER_ITEMS = [
    (601, dt(2026, 6, 10, 10, 3, 30), 501, 1, 1, D("19.99"), D("9.00")),
    (602, dt(2026, 6, 12, 9, 5, 0), 502, 3, 1, D("25.00"), D("10.00")),
    (603, dt(2026, 6, 12, 9, 5, 0), 502, 2, 0, D("20.00"), D("8.00")),
]

REFUNDS = [
    (701, dt(2026, 6, 13, 14, 0, 0), 603, 502, D("20.00")),
]

SAMPLE_ROWS = {
    "staging_products": PRODUCTS,
    "staging_website_sessions": SESSIONS,
    "staging_website_pageviews": PAGEVIEWS,
    "staging_orders": ORDERS,
    "staging_order_items": ORDER_ITEMS,
    "staging_order_item_refunds": REFUNDS,
}


def bronze_frames(spark, rows=None):
    """Bronze DataFrames from literal rows (declared Bronze schemas)."""
    from marlstone.schemas import BRONZE
    rows = rows or SAMPLE_ROWS
    return {t: spark.createDataFrame(rows.get(t, []), BRONZE[t]) for t in BRONZE}
