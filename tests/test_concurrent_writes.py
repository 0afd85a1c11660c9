"""Concurrent zone writes within a stage (pipeline.write_concurrently)."""

import threading

import pytest

from marlstone.plans.pipeline import write_concurrently


def test_results_in_given_order_and_caller_job_group_inherited(spark):
    sc = spark.sparkContext
    seen, threads = {}, set()
    lock, running, peak = threading.Lock(), [0], [0]

    def write(i):
        def run():
            with lock:
                running[0] += 1
                peak[0] = max(peak[0], running[0])
            threads.add(threading.get_ident())
            seen[i] = sc.getLocalProperty("spark.jobGroup.id")
            spark.range(1000 * (5 - i)).selectExpr("sum(id)").collect()
            with lock:
                running[0] -= 1
            return i
        return run

    sc.setJobGroup("stage-under-test", "concurrent writes")
    try:
        got = write_concurrently(spark, [write(i) for i in range(5)], max_jobs=3)
    finally:
        sc.setJobGroup("", "")
    assert got == [0, 1, 2, 3, 4]
    assert set(seen.values()) == {"stage-under-test"}
    assert threading.get_ident() not in threads
    assert 1 <= peak[0] <= 3


@pytest.mark.parametrize("max_jobs", [1, 2, 5])
def test_no_write_starts_after_an_error(spark, max_jobs):
    started, failed = [], threading.Event()

    def ok(i):
        def run():
            started.append(i)
            failed.wait(30 if max_jobs > 1 else 0)
            spark.range(10).count()
            return i
        return run

    def fails():
        started.append(1)
        failed.set()
        raise ValueError("first")

    writes = [ok(0), fails, *[ok(i) for i in range(2, 12)]]
    with pytest.raises(ValueError, match="first"):
        write_concurrently(spark, writes, max_jobs)
    # the failing write and those that already ran beside it
    assert 1 in started and len(started) <= max_jobs + 1
    assert 11 not in started


def test_first_error_in_the_given_order_is_raised(spark):
    gate = threading.Barrier(2)

    def fails(msg):
        def run():
            gate.wait(30)
            raise ValueError(msg)
        return run

    with pytest.raises(ValueError, match="first"):
        write_concurrently(spark, [fails("first"), fails("second")], max_jobs=2)


def test_one_job_at_a_time_runs_on_the_calling_thread(spark):
    caller = threading.get_ident()
    assert write_concurrently(spark, [lambda: threading.get_ident()] * 2,
                              max_jobs=1) == [caller, caller]


@pytest.mark.parametrize("max_jobs", [1, 4])
def test_silver_stage_stops_at_a_missing_table(spark, scratch, max_jobs):
    """A missing Bronze table fails the stage; tables after it that had not
    started are not written."""
    import os
    import tempfile

    from marlstone.plans.pipeline import bronze_to_silver
    from marlstone.schemas import BRONZE_TO_SILVER
    from marlstone.sources.zones import UnreadableTable, write_table, zone_path
    from tests.fixtures import bronze_frames

    root = tempfile.mkdtemp(prefix="fail-", dir=scratch)
    frames = bronze_frames(spark)
    missing = next(iter(BRONZE_TO_SILVER))
    for table, df in frames.items():
        if table != missing:
            write_table(df, root, "bronze", table)
    with pytest.raises(UnreadableTable):
        bronze_to_silver(spark, root, tables=list(BRONZE_TO_SILVER), max_jobs=max_jobs)
    written = [t for t, silver in BRONZE_TO_SILVER.items()
               if os.path.isdir(zone_path(root, "silver", silver))]
    assert missing not in written
    assert max_jobs > 1 or not written
