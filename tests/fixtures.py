"""Test fixtures: the shop's sample rows (kept in the package for seeding)."""

from marlstone.sources.sample_data import (  # noqa: F401
    ORDER_ITEMS, ORDERS, PAGEVIEWS, PRODUCTS, REFUNDS, SAMPLE_ROWS, SESSIONS,
    bronze_frames)
