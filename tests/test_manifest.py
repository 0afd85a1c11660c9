"""Versions, manifest and resumed runs: what a reader sees at every step."""

import os
import subprocess
import sys
import tempfile
import textwrap
from datetime import timedelta

import pytest

from marlstone.plans import pipeline
from marlstone.plans.pipeline import bronze_to_silver, run_pipeline, silver_to_gold
from marlstone.schemas import BRONZE, GOLD, SERVING_TABLES, SILVER
from marlstone.sources import zones
from marlstone.sources.manifest import Entry, commit, latest_run, records, snapshot
from marlstone.sources.publish import CatalogTarget, ViewTarget, publish_table
from marlstone.sources.zones import UnreadableTable, expire_versions, read_table, write_table, zone_path
from tests.fixtures import bronze_frames

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def root(scratch):
    return tempfile.mkdtemp(prefix="versions-", dir=scratch)


class Frames:
    """A source that gives the sample rows, and raises or changes where told."""
    def __init__(self, spark, rows=None, broken=()):
        self.frames, self.broken, self.read_tables = {**bronze_frames(spark), **(rows or {})}, set(broken), []

    def read(self, spark, table):
        self.read_tables.append(table)
        if table in self.broken:
            raise OSError(f"lost {table}")
        return self.frames[table]


def orders(spark, root):
    return {r.order_id for r in read_table(spark, root, "bronze", "staging_orders").collect()}


def test_no_commit_no_table(spark, root):
    assert snapshot(spark, root).entries == {}
    with pytest.raises(UnreadableTable):
        read_table(spark, root, "bronze", "staging_orders")


def test_a_write_moves_and_deletes_nothing(spark, root):
    df = bronze_frames(spark)["staging_orders"]
    first = write_table(df, root, "bronze", "staging_orders")
    reader = read_table(spark, root, "bronze", "staging_orders")
    files = sorted(os.listdir(first.path))
    second = write_table(df.limit(1), root, "bronze", "staging_orders")
    assert first.path != second.path and sorted(os.listdir(first.path)) == files
    # a reader that had resolved the old version keeps it, a new one sees the new
    assert reader.count() == 2
    assert read_table(spark, root, "bronze", "staging_orders").count() == 1


@pytest.mark.parametrize("step", ["rows", "count", "commit"])
def test_failure_between_steps_keeps_the_old_rows(spark, root, monkeypatch, step):
    df = bronze_frames(spark)["staging_orders"]
    write_table(df, root, "bronze", "staging_orders")
    before = orders(spark, root)

    def broken(*args, **kwargs):
        raise OSError("killed")
    if step == "commit":
        monkeypatch.setattr(zones, "commit", broken)
    elif step == "count":
        monkeypatch.setattr(zones.Observation, "get", property(broken))
    else:
        df = df.selectExpr("*", "raise_error('killed') AS note")
    with pytest.raises(Exception, match="killed"):
        write_table(df.where("order_id = 501"), root, "bronze", "staging_orders")
    monkeypatch.undo()
    assert orders(spark, root) == before
    assert write_table(bronze_frames(spark)["staging_orders"].limit(1), root, "bronze", "staging_orders").row_count == 1
    assert len(orders(spark, root)) == 1


def test_killed_writer_leaves_the_old_rows(spark, root):
    """The writing process is killed after the rows are written, before the commit."""
    write_table(bronze_frames(spark)["staging_orders"], root, "bronze", "staging_orders")
    before = orders(spark, root)
    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {REPO!r})
        from marlstone.session import build_session
        from marlstone.sources import zones
        from tests.fixtures import bronze_frames
        spark = build_session("local[1]", "killed", conf={{"spark.sql.warehouse.dir": {root!r} + "/warehouse"}})
        zones.commit = lambda *a, **k: os._exit(9)
        zones.write_table(bronze_frames(spark)["staging_orders"].limit(1), {root!r}, "bronze", "staging_orders")
    """)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 9, done.stderr[-2000:]
    assert len(os.listdir(zone_path(root, "bronze", "staging_orders"))) == 2
    assert orders(spark, root) == before


def test_tables_of_a_stage_change_together(spark, root, monkeypatch):
    """A reader beside a second run sees the old tables until all new ones are there, and a reader's
    snapshot stays as it is."""
    source = Frames(spark)
    run_pipeline(spark, root, source, stages=["extract", "silver", "gold"])
    old = snapshot(spark, root)
    fewer = source.frames["staging_orders"].where("order_id = 501")
    seen = []
    write = pipeline.write_version

    def watched(df, root_, zone, table, *args):
        result = write(df, root_, zone, table, *args)
        if zone == "gold":
            seen.append(snapshot(spark, root).entries == {**old.entries, **dict(seen_silver)})
        return result
    run_pipeline(spark, root, Frames(spark, {"staging_orders": fewer}), stages=["extract", "silver"])
    seen_silver = [(k, e) for k, e in snapshot(spark, root).entries.items() if k[0] != "gold"]
    monkeypatch.setattr(pipeline, "write_version", watched)
    silver_to_gold(spark, root, max_jobs=1)
    assert seen == [True] * 5
    new = snapshot(spark, root)

    def gold(which, table):
        return read_table(spark, root, "gold", table, seen=which)
    for which, items, sessions in ((old, 3, 2), (new, gold(new, "fact_order_items").count(), 1)):
        assert gold(which, "fact_order_items").count() == items
        orders_ = gold(which, "mart_session_conversion").agg({"total_orders": "sum"}).first()[0]
        assert orders_ == gold(which, "fact_order_items").select("order_id").distinct().count()
    assert gold(new, "fact_order_items").count() < 3
    # versions of one run lie under one commit
    commits = records(spark, root).where("kind = 'commit' AND stage = 'gold'").collect()
    assert {len(c.entries) for c in commits} == {len(GOLD)}


def test_later_commit_holds(spark, root):
    for n in (1, 2, 3):
        commit(spark, root, [Entry("gold", "x", f"path{n}", n), Entry("gold", f"only{n}", "p", 0)])
    now = snapshot(spark, root)
    assert now.get("gold", "x").path == "path3"
    assert {t for _, t in now.entries} == {"x", "only1", "only2", "only3"}


def written_versions(root):
    return {z: {t: set(os.listdir(zone_path(root, z, t))) for t in os.listdir(f"{root}/{z}")}
            for z in ("bronze", "silver", "gold") if os.path.isdir(f"{root}/{z}")}


@pytest.mark.parametrize("stop", [1, 6, 8, 16, 17])
def test_run_stopped_after_a_table_is_resumed(spark, root, monkeypatch, stop):
    """The run ends after ``stop`` tables; the resumed one writes the others only."""
    write, n = pipeline.write_version, []

    def stops(df, *args):
        if len(n) == stop:
            raise OSError("stopped")
        n.append(args[1:3])
        return write(df, *args)
    monkeypatch.setattr(pipeline, "write_version", stops)
    zones_only = ["extract", "silver", "gold"]
    if stop < 17:
        with pytest.raises(OSError, match="stopped"):
            run_pipeline(spark, root, Frames(spark), stages=zones_only, max_jobs=1)
        assert snapshot(spark, root).zone("gold") == []
    else:
        run_pipeline(spark, root, Frames(spark), stages=zones_only, max_jobs=1)
    monkeypatch.setattr(pipeline, "write_version", write)
    before, run = written_versions(root), latest_run(spark, root)
    source = Frames(spark)
    again = run_pipeline(spark, root, source, stages=zones_only, max_jobs=1, resume=True)
    assert again.run == run
    after = written_versions(root)
    for zone, tables in after.items():
        for table, versions in tables.items():
            assert len(versions) == 1, (zone, table)
            assert before.get(zone, {}).get(table, versions) == versions
    assert len(source.read_tables) == max(0, 6 - stop)
    assert again.resumed == [s for s, last in (("extract", 6), ("silver", 12), ("gold", 17)) if stop >= last]
    assert [len(again.stages[s]) for s in zones_only] == [len(BRONZE), len(SILVER), len(GOLD)]
    assert read_table(spark, root, "gold", "fact_order_items").count() == 3


def test_resumed_stage_keeps_its_inputs(spark, root, monkeypatch):
    """Bronze changes between the stop and the resumption: all Silver tables come from the old one."""
    run_pipeline(spark, root, Frames(spark), stages=["extract"])
    write, n = pipeline.write_version, []

    def stops(df, *args):
        if len(n) == 2:
            raise OSError("stopped")
        n.append(1)
        return write(df, *args)
    monkeypatch.setattr(pipeline, "write_version", stops)
    with pytest.raises(OSError):
        run_pipeline(spark, root, stages=["silver"], max_jobs=1)
    monkeypatch.setattr(pipeline, "write_version", write)
    for name, df in bronze_frames(spark).items():
        write_table(df.limit(0), root, "bronze", name)
    again = run_pipeline(spark, root, stages=["silver"], max_jobs=1, resume=True)
    assert all(r.row_count > 0 for r in again.stages["silver"])
    assert all(r.row_count == 0 for r in bronze_to_silver(spark, root))


def test_publish_is_resumed(spark, root):
    spark.sql("CREATE DATABASE IF NOT EXISTS resumed_bi")
    run_pipeline(spark, root, Frames(spark), stages=["extract", "silver", "gold"])

    class Stops(CatalogTarget):
        def create(self, df, table):
            if table == "gold_dim_website_sessions":
                raise OSError("stopped")
            super().create(df, table)
    with pytest.raises(OSError):
        run_pipeline(spark, root, target=Stops("resumed_bi"), stages=["publish"])
    again = run_pipeline(spark, root, target=CatalogTarget("resumed_bi"), stages=["publish"], resume=True)
    assert [(p.serving_table, p.created) for p in again.stages["publish"]] == list(
        zip(SERVING_TABLES.values(), [False, False, True, True, True]))
    assert [p.row_count for p in again.stages["publish"]] == [3, 4, 5, 4, 4]
    assert run_pipeline(spark, root, target=CatalogTarget("resumed_bi"), stages=["publish"], resume=True).resumed == [
        "publish"]


def test_expired_versions_go(spark, root):
    df = bronze_frames(spark)["staging_products"]
    paths = [write_table(df, root, "bronze", "staging_products").path for _ in range(4)]
    df.write.parquet(f"{root}/bronze/staging_products/20200101T000000-killed")
    assert expire_versions(spark, root, keep=1) == [f"{root}/bronze/staging_products/20200101T000000-killed"]
    gone = expire_versions(spark, root, keep=2, min_age=timedelta(seconds=-5))
    assert sorted(gone) == sorted(paths[:2])
    assert [os.path.isdir(p) for p in paths] == [False, False, True, True]
    assert read_table(spark, root, "bronze", "staging_products").count() == 4


def test_views_are_switched_last(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS view_bi")
    target, df = ViewTarget("view_bi"), bronze_frames(spark)["staging_products"]

    def rows():
        return spark.sql("SELECT count(*) AS n FROM view_bi.gold_p").first()["n"]
    assert publish_table(df, target, "gold_p").created and rows() == 4
    again = publish_table(df.limit(2).select(*reversed(df.columns)), target, "gold_p")
    assert not again.created and again.row_count == 2 and rows() == 2
    assert spark.table("view_bi.gold_p").columns == df.columns
    # rows that cannot be computed, and a switch that fails: the old rows stay
    with pytest.raises(Exception, match="broken"):
        publish_table(df.selectExpr("product_id", "create_at", "raise_error('broken') AS product_name"), target, "gold_p")
    assert rows() == 2
    sql = spark.sql

    def fails(text, *args, **kwargs):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise OSError("lost")
        return sql(text, *args, **kwargs)
    monkeypatch.setattr(type(spark), "sql", lambda self, *a, **k: fails(*a, **k))
    with pytest.raises(OSError, match="lost"):
        publish_table(df, target, "gold_p")
    monkeypatch.undo()
    assert rows() == 2
    for n in (1, 3, 4):
        publish_table(df.limit(n), target, "gold_p")
        assert rows() == n
    # the table shown and one earlier are left
    assert len(target._versions(spark, "gold_p")) == 2


def test_publish_into_views(spark, root):
    spark.sql("CREATE DATABASE IF NOT EXISTS view_gold")
    run = run_pipeline(spark, root, Frames(spark), ViewTarget("view_gold"))
    assert [p.row_count for p in run.stages["publish"]] == [3, 4, 5, 4, 4]
    assert spark.table("view_gold.gold_fact_order_items").count() == 3
