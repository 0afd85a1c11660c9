"""End-to-end: catalog source -> Parquet zones -> catalog serving tables."""

import os
import tempfile

import pytest

from marlstone.operators import schema_inventory
from marlstone.plans.pipeline import STAGES, run_pipeline
from marlstone.schemas import GOLD, SERVING_TABLES, SILVER, same_columns
from marlstone.sources.publish import CatalogTarget
from marlstone.sources.relational import CatalogSource, initialize_source
from marlstone.sources.manifest import snapshot
from marlstone.sources.zones import read_table, zone_path
from tests.fixtures import SAMPLE_ROWS


@pytest.fixture(scope="module")
def lake(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_src")
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_bi")
    inserted = initialize_source(spark, SAMPLE_ROWS, database="shop_src")
    root = tempfile.mkdtemp(prefix="lake-", dir=scratch)
    run = run_pipeline(spark, root, source=CatalogSource("shop_src"),
                       target=CatalogTarget("shop_bi"))
    return {"root": root, "run": run, "inserted": inserted}


def test_source_seeded_once(spark, lake):
    assert lake["inserted"] is True
    # second call finds staging_products non-empty and loads nothing
    assert initialize_source(spark, SAMPLE_ROWS, database="shop_src") is False
    assert spark.table("shop_src.staging_products").count() == 4


def test_stage_order_and_counts(lake):
    run = lake["run"]
    assert list(run.stages) == list(STAGES)
    bronze = {r.table: r.row_count for r in run.stages["extract"]}
    assert bronze == {t: len(rows) for t, rows in SAMPLE_ROWS.items()}
    gold = {r.table: r.row_count for r in run.stages["gold"]}
    assert gold == {"fact_order_items": 3, "dim_products": 4,
                    "dim_website_sessions": 5, "mart_product_performance": 4,
                    "mart_session_conversion": 4}


def test_zone_layout_and_schemas(spark, lake):
    root = lake["root"]
    for zone, tables in (("silver", SILVER), ("gold", GOLD)):
        for t, schema in tables.items():
            path = snapshot(spark, root).get(zone, t).path
            assert path.startswith(zone_path(root, zone, t) + "/") and os.path.isdir(path)
            on_disk = spark.read.parquet(path).schema
            assert same_columns(on_disk, schema), (zone, t)


def test_marts_read_from_written_gold(spark, lake):
    mart = read_table(spark, lake["root"], "gold", "mart_session_conversion")
    got = sorted(tuple(r) for r in mart.collect())
    assert got[2] == ("gsearch", "nonbrand", "desktop", 2, 1, 50.0)


def test_publish_creates_then_replaces(spark, lake):
    first = lake["run"].stages["publish"]
    assert [p.serving_table for p in first] == list(SERVING_TABLES.values())
    assert all(p.created for p in first)
    assert spark.table("shop_bi.gold_fact_order_items").count() == 3
    # publish again: tables exist, rows replaced (not appended)
    again = run_pipeline(spark, lake["root"], target=CatalogTarget("shop_bi"),
                         stages=["publish"]).stages["publish"]
    assert not any(p.created for p in again)
    assert [p.row_count for p in again] == [3, 4, 5, 4, 4]
    assert spark.table("shop_bi.gold_fact_order_items").count() == 3
    assert spark.table("shop_bi.gold_mart_product_performance").count() == 4


def test_schema_inventory_lists_serving_tables(spark, lake):
    inv = schema_inventory(spark, "shop_bi")
    tables = {r.table_name for r in inv.collect()}
    assert tables == set(SERVING_TABLES.values())
    cols = [(r.column_name, r.column_type) for r in
            inv.where("table_name = 'gold_mart_session_conversion'").collect()]
    assert ("conversion_rate_percent", "DOUBLE") in cols


def test_schema_inventory_empty_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS empty_db")
    assert schema_inventory(spark, "empty_db").count() == 0


def test_unknown_or_unconfigured_stage(spark, scratch):
    with pytest.raises(ValueError):
        run_pipeline(spark, scratch, stages=["bogus"])
    with pytest.raises(ValueError):
        run_pipeline(spark, scratch, stages=["extract"])


def test_failure_stops_later_stages(spark, scratch):
    root = tempfile.mkdtemp(prefix="empty-lake-", dir=scratch)
    # silver has no bronze to read: the stage raises and gold never runs
    with pytest.raises(Exception):
        run_pipeline(spark, root, stages=["silver", "gold"])
    assert not os.path.exists(zone_path(root, "gold", "fact_order_items"))
