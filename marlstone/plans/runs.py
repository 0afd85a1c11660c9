"""Registered queries that run the zone pipeline over files.

Each writes a lake of its own: Bronze from the adapters' rows, Silver from the written
Bronze, Gold from the written Silver, in a folder that the cluster shares. What
they return is read back from those files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.plans.pipeline import PipelineRun, run_pipeline
from marlstone.sources.manifest import snapshot
from marlstone.sources.testdata import bronze_table
from marlstone.sources.zones import read_table, read_version, scratch_root

ZONES = {"extract": "bronze", "silver": "silver", "gold": "gold"}


class GeneratedSource:
    """The generated tables as a source of the extract."""
    def __init__(self, sf_dir: str):
        self.sf_dir = sf_dir

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return bronze_table(spark, self.sf_dir, table)


def run_zones(spark: SparkSession, sf_dir: str, root: str, resume: bool = False) -> PipelineRun:
    return run_pipeline(spark, root, GeneratedSource(sf_dir), stages=list(ZONES), resume=resume)


def run_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone, table_name, observed_rows, counted_rows: the rows that each write of a run reported (observed while
    it wrote) against those that the files hold."""
    run = run_zones(spark, sf_dir, scratch_root(spark, "run"))
    out = None
    for stage, zone in ZONES.items():
        for r in run.stages[stage]:
            one = (read_version(spark, zone, r.table, r.path).agg(F.count(F.lit(1)).alias("counted_rows"))
                   .select(F.lit(zone).alias("zone"), F.lit(r.table).alias("table_name"),
                           F.lit(r.row_count).cast("long").alias("observed_rows"), "counted_rows"))
            out = one if out is None else out.unionByName(one)
    return out


def _mart(table: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_root(spark, "run")
        # the stages as a scheduler runs them: one at a time, each resuming the run
        for stage in ZONES:
            run_pipeline(spark, root, GeneratedSource(sf_dir), stages=[stage], resume=True)
        return read_table(spark, root, "gold", table, seen=snapshot(spark, root))
    query.__name__ = f"run_{table}"
    query.__doc__ = f"{table} as a run in three resumed steps has written it."
    return query


run_mart_product_performance = _mart("mart_product_performance")
run_mart_session_conversion = _mart("mart_session_conversion")

RUN_QUERIES = {
    "run_row_counts": run_row_counts,
    "run_mart_product_performance": run_mart_product_performance,
    "run_mart_session_conversion": run_mart_session_conversion,
}
