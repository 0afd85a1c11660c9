"""Spark session settings for the lakehouse jobs.

The operators do not depend on any of these for *results* (types are cast
explicitly and casts that lose a value raise in any session); the settings are
about execution: AQE re-plans joins and
shuffle sizes from measured statistics, splits skewed join partitions and
coalesces small shuffle partitions.
"""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job of the pipeline wants, cluster or local.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast by sizes measured at run time, never by file sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # zone-less timestamps for CAST(... AS TIMESTAMP) in any SQL a user adds
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    # Building a plan in PySpark otherwise records the Python call site of
    # every column function (several JVM round trips each) for error
    # messages; batch jobs build large plans and do not need it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def scale_conf(shuffle_bytes: int, total_cores: int,
               partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a cluster run that moves about ``shuffle_bytes``
    through its largest exchange (for this pipeline: the fact's join input).
    Pass the result as ``build_session(conf=...)`` or give the command line
    ``--shuffle-gb``.

    Starts AQE from enough partitions that each holds ~``partition_bytes``
    (so a task's share fits in executor memory and spills little), never
    fewer than two per core, and lets AQE coalesce toward the same advisory
    size instead of maximising parallelism on small stages.
    """
    partitions = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    size = f"{partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": size,
    }


def build_session(master: str | None = None, app_name: str = "marlstone",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with ``conf`` on top of what spark-submit set,
    and ``JOB_CONF`` where neither says anything.

    ``master`` is only for local runs and tests; on a cluster leave it None
    and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = {k for k, _ in SparkConf().getAll()}
    wanted = {k: v for k, v in JOB_CONF.items() if k not in submitted}
    for k, v in {**wanted, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark
