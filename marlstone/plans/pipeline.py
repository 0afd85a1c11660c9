"""Zone-to-zone stages and the pipeline runner.

Every stage reads the previous zone's files and writes new versions of its own
zone's tables, one Spark job per table. It reads the versions that were current when it
began, all through one snapshot, and its own become current together, by one
record, when the last of them is finished: a reader of Gold has the fact, dimensions
and marts of one run, never of two.

Each finished table is recorded, so a run that was interrupted is taken up again
(``resume``) with the inputs it had: committed stages and finished tables are not
computed again.

Within the Silver and Gold stages the table writes that do not depend on
each other are submitted as concurrent Spark jobs (one driver thread each),
so a small table's job does not leave the rest of the cluster idle and the
tail of one job overlaps the next; the scheduler shares the executors. A
stage still fails as a whole: when a write fails, the writes already running
finish, none starts any more, the first error (in table order) is raised and no
later stage runs. Extract and publish stay sequential: they are bound by the database,
and publish keeps the per-table order of its transactions.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

from marlstone.operators import (
    CLEANERS, dim_products, dim_website_sessions, fact_order_items,
    mart_product_performance, mart_session_conversion)
from marlstone.schemas import BRONZE_TO_SILVER, SOURCE_TABLES
from marlstone.sources.manifest import (
    Entry, Stage, begin, committed_stages, latest_run, new_version)
from marlstone.sources.publish import PublishResult, ServingTarget, publish_gold
from marlstone.sources.relational import TableSource
from marlstone.sources.zones import WriteResult, read_table, read_version, write_version

STAGES = ("extract", "silver", "gold", "publish")


def _write(stage: Stage, zone: str, table: str, rows: Callable[[], DataFrame]) -> WriteResult:
    """Write a table of a stage, unless an earlier attempt has finished it."""
    had = stage.finished.get((zone, table))
    if had is not None:
        return WriteResult(had.table, had.path, had.row_count)
    result = write_version(rows(), stage.root, zone, table)
    stage.done(result.entry(zone))
    return result


def extract_to_bronze(spark: SparkSession, source: TableSource, root: str,
                      tables: Sequence[str] = SOURCE_TABLES, run: str | None = None) -> list[WriteResult]:
    """Copy each source table, as is, to ``<root>/bronze/<table>``, all as of
    one moment where the source has a common snapshot. That ends with its transaction, so an
    extract that is taken up again then reads every table anew."""
    stage = begin(spark, root, "extract", run)
    if getattr(source, "common_snapshot", False):
        stage.finished.clear()
    one_moment = source.consistent(spark) if hasattr(source, "consistent") else nullcontext(source)
    with one_moment as seen:
        results = [_write(stage, "bronze", t, lambda t=t: seen.read(spark, t)) for t in tables]
    stage.commit(r.entry("bronze") for r in results)
    return results


def write_concurrently(spark: SparkSession,
                       writes: Sequence[Callable[[], WriteResult]],
                       max_jobs: int) -> list[WriteResult]:
    """Run independent table writes as up to ``max_jobs`` concurrent Spark
    jobs, started in the given order; results in that order. After an error no
    further write starts; those already running finish, then the first error
    (in the given order) is raised.

    The driver threads are ``InheritableThread``s, so each job carries the
    caller's job group, description and other local properties (cancelling
    the caller's job group cancels these jobs too).
    """
    if max_jobs <= 1 or len(writes) <= 1:
        return [w() for w in writes]
    results: list[WriteResult | None] = [None] * len(writes)
    errors: list[BaseException | None] = [None] * len(writes)
    lock, waiting = threading.Lock(), list(range(len(writes)))

    def run() -> None:
        while True:
            with lock:
                if not waiting or any(errors):
                    return
                i = waiting.pop(0)
            try:
                results[i] = writes[i]()
            except BaseException as e:  # re-raised on the calling thread
                errors[i] = e

    threads = [InheritableThread(run, session=spark)
               for _ in range(min(max_jobs, len(writes)))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for e in errors:
        if e is not None:
            raise e
    return results  # type: ignore[return-value]


def bronze_to_silver(spark: SparkSession, root: str,
                     tables: Sequence[str] = SOURCE_TABLES,
                     max_jobs: int = 4, run: str | None = None) -> list[WriteResult]:
    """Clean each Bronze table into its Silver table (map-only jobs,
    up to ``max_jobs`` at a time)."""
    stage = begin(spark, root, "silver", run)

    def clean(bronze: str) -> Callable[[], WriteResult]:
        return lambda: _write(stage, "silver", BRONZE_TO_SILVER[bronze], lambda: CLEANERS[bronze](
            read_table(spark, root, "bronze", bronze, seen=stage.inputs)))
    results = write_concurrently(spark, [clean(t) for t in tables], max_jobs)
    stage.commit(r.entry("silver") for r in results)
    return results


def silver_to_gold(spark: SparkSession, root: str,
                   max_jobs: int = 4, run: str | None = None) -> list[WriteResult]:
    """Fact and dimensions first, then the marts *from the written Gold
    tables* (they read what this stage just wrote, not a recomputation).
    Each of the two waves runs its writes concurrently; the five tables become current together."""
    stage = begin(spark, root, "gold", run)

    def silver(t: str) -> DataFrame:
        return read_table(spark, root, "silver", t, seen=stage.inputs)

    def gold(t: str) -> DataFrame:
        return read_version(spark, "gold", t, stage.finished["gold", t].path)

    def write(t: str, rows: Callable[[], DataFrame]) -> Callable[[], WriteResult]:
        return lambda: _write(stage, "gold", t, rows)

    model = write_concurrently(spark, [
        write("fact_order_items", lambda: fact_order_items(
            silver("order_items"), silver("orders"), silver("order_item_refunds"))),
        write("dim_products", lambda: dim_products(silver("products"))),
        write("dim_website_sessions", lambda: dim_website_sessions(silver("website_sessions"))),
    ], max_jobs)
    marts = write_concurrently(spark, [
        write("mart_product_performance", lambda: mart_product_performance(
            gold("dim_products"), gold("fact_order_items"))),
        write("mart_session_conversion", lambda: mart_session_conversion(
            gold("dim_website_sessions"), gold("fact_order_items"))),
    ], max_jobs)
    stage.commit(r.entry("gold") for r in model + marts)
    return model + marts


def _publish(spark: SparkSession, root: str, target: ServingTarget, run: str) -> list[PublishResult]:
    """C8 of a run: Gold as it was when the stage began, each serving table once."""
    stage = begin(spark, root, "publish", run)

    def done(result: PublishResult) -> None:
        stage.done(Entry("serving", result.gold_table, result.serving_table, result.row_count))
    results = publish_gold(spark, root, target, seen=stage.inputs,
                           finished={t: e.row_count for (_, t), e in stage.finished.items()}, done=done)
    stage.commit(Entry("serving", r.gold_table, r.serving_table, r.row_count) for r in results)
    return results


@dataclass
class PipelineRun:
    """Results per completed stage, in run order; ``run`` names the run in the manifest."""
    stages: dict[str, list[WriteResult] | list[PublishResult]] = field(
        default_factory=dict)
    run: str = ""
    resumed: list[str] = field(default_factory=list)


def run_pipeline(spark: SparkSession, root: str,
                 source: TableSource | None = None,
                 target: ServingTarget | None = None,
                 stages: Sequence[str] = STAGES,
                 max_jobs: int = 4, resume: bool = False) -> PipelineRun:
    """Run the requested stages in the fixed order extract -> silver ->
    gold -> publish; the first failing stage raises and later stages do not
    run. ``extract`` needs ``source``, ``publish`` needs ``target``.
    ``max_jobs`` caps the concurrent table writes of the silver and gold
    stages (1 = one table at a time).

    ``resume`` takes up the lake's last run where it stopped: stages that it committed are
    left as they are (``PipelineRun.resumed`` names them), a stage that it began reads the inputs
    it began with and skips the tables it finished. Without an earlier run it starts one."""
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    if "extract" in stages and source is None:
        raise ValueError("the extract stage needs a source")
    if "publish" in stages and target is None:
        raise ValueError("the publish stage needs a target")
    run = PipelineRun(run=(latest_run(spark, root) if resume else None) or new_version())
    over = committed_stages(spark, root, run.run) if resume else {}
    for stage in STAGES:
        if stage not in stages:
            continue
        if stage in over:
            run.resumed.append(stage)
            run.stages[stage] = [
                PublishResult(e.table, e.path, False, e.row_count) if stage == "publish"
                else WriteResult(e.table, e.path, e.row_count) for e in over[stage]]
        elif stage == "extract":
            run.stages[stage] = extract_to_bronze(spark, source, root, run=run.run)
        elif stage == "silver":
            run.stages[stage] = bronze_to_silver(spark, root, max_jobs=max_jobs, run=run.run)
        elif stage == "gold":
            run.stages[stage] = silver_to_gold(spark, root, max_jobs=max_jobs, run=run.run)
        else:
            run.stages[stage] = _publish(spark, root, target, run.run)
    return run
