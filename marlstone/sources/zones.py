"""Parquet zones: ``<root>/<zone>/<table>/<version>/`` directories of part files
(SURVEY S3, S4, K1, K2).

One Spark job writes a table's rows into a folder of their own, which never changes or
moves; a record in the lake's manifest then makes it the table's current version
(``sources/manifest``). A failed or killed write leaves a folder that no record names, and the old
rows are read as before. A read requires a committed version with every declared column, so an unfinished or
reshaped table stops the next stage instead of looking empty or NULL. The written
table is what the next stage reads, which also cuts the lineage between stages (a
restarted stage starts from files, not from a recomputation of the previous stage).

Only public calls are used, but for ``expire_versions``: Spark has none that deletes files.
"""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.schemas import ZONES, same_columns
from marlstone.sources.manifest import Entry, Snapshot, commit, new_version, records, snapshot


@dataclass(frozen=True)
class WriteResult:
    """Where a table was written and how many rows it got (K2 / K8)."""
    table: str
    path: str
    row_count: int

    def entry(self, zone: str) -> Entry:
        return Entry(zone, self.table, self.path, self.row_count)


def zone_path(root: str, zone: str, table: str) -> str:
    """``<root>/<zone>/<table>``; root may be any Hadoop URI (s3a://, file:)."""
    return f"{root.rstrip('/')}/{zone}/{table}"


def expected_schema(zone: str, table: str) -> T.StructType | None:
    return ZONES.get(zone, {}).get(table)


class UnreadableTable(RuntimeError):
    """A zone table without a committed version, or without a declared column."""


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        return "number"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return kind.simpleString()


def _check_columns(name: str, actual: T.StructType, declared: T.StructType, exact: bool) -> None:
    have = {f.name: f.dataType for f in actual.fields}
    for f in declared.fields:
        if f.name not in have:
            raise UnreadableTable(f"{name}: no column {f.name}")
        same = have[f.name] == f.dataType if exact else _family(have[f.name]) == _family(f.dataType)
        if not same:
            raise UnreadableTable(f"{name}: {f.name} is {have[f.name].simpleString()}, "
                                  f"declared {f.dataType.simpleString()}")


def read_version(spark: SparkSession, zone: str, table: str, path: str,
                 schema: T.StructType | None = None) -> DataFrame:
    """One version of a zone table.

    The files' own schema (one footer) is checked against the declared one: a
    missing column raises, so does another type. Bronze keeps the source's
    types and any further columns, so there only the kind of type has to
    agree; Silver and Gold have exactly the declared columns. Column pruning
    and filter pushdown of later operators reach this scan.
    """
    declared = schema or expected_schema(zone, table)
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        raise UnreadableTable(f"{zone}.{table}: no rows in {path} ({e.getCondition()})") from e
    if declared is None:
        return df
    _check_columns(f"{zone}.{table}", df.schema, declared, exact=zone != "bronze")
    return df if zone == "bronze" else df.select(*declared.names)


def read_table(spark: SparkSession, root: str, zone: str, table: str,
               schema: T.StructType | None = None, seen: Snapshot | None = None) -> DataFrame:
    """S3: read the current version of a zone table, or that of the snapshot ``seen``.
    Several tables that belong together are read through one snapshot."""
    entry = (seen or snapshot(spark, root)).get(zone, table)
    if entry is None:
        raise UnreadableTable(f"{zone}.{table}: no committed version in {zone_path(root, zone, table)}")
    return read_version(spark, zone, table, entry.path, schema)


def read_path(spark: SparkSession, path: str,
              schema: T.StructType | None = None) -> DataFrame:
    """Read one Parquet file or directory by path."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_version(df: DataFrame, root: str, zone: str, table: str,
                  check_schema: bool = True) -> WriteResult:
    """Write ``df`` as a new version of ``<root>/<zone>/<table>`` that nobody reads yet, and count its
    rows: an ``Observation`` of the write itself, no second scan. ``check_schema`` asserts the declared
    zone schema before any work starts."""
    expected = expected_schema(zone, table)
    if check_schema and expected is not None:
        if zone == "bronze":
            _check_columns(f"{zone}.{table}", df.schema, expected, exact=False)
        elif not same_columns(df.schema, expected):
            raise ValueError(
                f"{zone}.{table}: schema {df.schema.simpleString()} does not match "
                f"the declared {expected.simpleString()}")
    path = f"{zone_path(root, zone, table)}/{new_version()}"
    obs = Observation(f"{zone}_{table}_rows")
    with _job_description(df.sparkSession, f"write {zone}.{table}"):
        (df.observe(obs, F.count(F.lit(1)).alias("rows"))
           .write.mode("errorifexists").parquet(path))
    return WriteResult(table, path, int(obs.get["rows"]))


def write_table(df: DataFrame, root: str, zone: str, table: str,
                check_schema: bool = True) -> WriteResult:
    """K1 + K2: replace ``<root>/<zone>/<table>`` with ``df``; count rows. Readers see the old rows until
    the new ones are complete."""
    result = write_version(df, root, zone, table, check_schema)
    commit(df.sparkSession, root, [result.entry(zone)], stage=f"write {zone}.{table}")
    return result


def adopt_files(spark: SparkSession, root: str, zone: str, table: str, path: str) -> WriteResult:
    """Make Parquet files that are there already the current version of a table, after the column check;
    they stay where they are."""
    df = read_version(spark, zone, table, path)
    result = WriteResult(table, path, df.count())
    commit(spark, root, [result.entry(zone)], stage=f"adopt {zone}.{table}")
    return result


def expire_versions(spark: SparkSession, root: str, keep: int = 2, min_age: timedelta = timedelta(days=7)) -> list[str]:
    """Delete the folders of old versions, and those that killed writes have left; the deleted paths.

    The last ``keep`` committed versions of a table stay, and so does every folder younger than ``min_age``, so
    that no reader or running write loses its files. Readers of older snapshots are on their own.
    Uses the JVM's file system, so not for Spark Connect.
    """
    held = (records(spark, root).where("kind = 'commit'").select("seq", F.explode("entries").alias("e"))
            .groupBy("e.zone", "e.table").agg(F.collect_list(F.struct("seq", "e.path")).alias("versions")).collect())
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    fs = make(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before, gone = f"{datetime.now(timezone.utc) - min_age:%Y%m%dT%H%M%S}", []
    for row in held:
        stays = {v.path.rsplit("/", 1)[-1] for v in sorted(row.versions, key=lambda v: -v.seq)[:keep]}
        folder = make(zone_path(root, row.zone, row.table))
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name not in stays and name[:15] < before and name[:8].isdigit():
                fs.delete(status.getPath(), True)
                gone.append(f"{zone_path(root, row.zone, row.table)}/{name}")
    return gone


def scratch_root(spark: SparkSession, prefix: str) -> str:
    """A new folder for a lake of one's own: in the folder that ``spark.checkpoint.dir`` names, which all
    executors share; a local session without that setting gets a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{prefix}-{new_version()}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{prefix}-")


@contextmanager
def _job_description(spark: SparkSession, text: str):
    """Name the jobs of a block in the event log / monitoring, then restore
    the caller's name."""
    sc = spark.sparkContext
    before = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(text)
    try:
        yield
    finally:
        sc.setJobDescription(before)
