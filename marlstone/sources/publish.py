"""Publish Gold tables to serving tables.

Semantics kept from the rule: an existing serving table is *emptied and
refilled* (its definition, grants and indexes survive); an absent one is
created from the DataFrame's schema; tables are published one after another
and the first failure stops the run, leaving earlier tables published.

Unlike a single-process reverse ETL, the Gold files are never loaded into
one machine's memory: each Spark task streams its own slice into the target
over its own connection (``num_partitions`` caps the connections).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from types import MappingProxyType
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marlstone.schemas import SERVING_TABLES
from marlstone.sources.manifest import Snapshot, new_version, snapshot
from marlstone.sources.relational import jdbc_connection
from marlstone.sources.zones import read_table


@dataclass(frozen=True)
class PublishResult:
    gold_table: str
    serving_table: str
    created: bool
    row_count: int


class ServingTarget(Protocol):
    def exists(self, spark: SparkSession, table: str) -> bool: ...
    def replace_rows(self, df: DataFrame, table: str) -> None: ...
    def create(self, df: DataFrame, table: str) -> None: ...


@dataclass
class CatalogTarget:
    """Serving tables in a Spark catalog database."""
    database: str | None = None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}" if self.database else table

    def exists(self, spark: SparkSession, table: str) -> bool:
        return spark.catalog.tableExists(self.name(table))

    def replace_rows(self, df: DataFrame, table: str) -> None:
        """Finish the rows in a table ``<table>__stage_...``, then overwrite
        from it: rows that cannot be computed leave the table as it is, and
        after a failed copy the stage still has them all."""
        spark, stage = df.sparkSession, self.name(f"{table}__stage_{uuid.uuid4().hex}")
        # insertInto matches columns by position: follow the table's order.
        target_cols = spark.table(self.name(table)).columns
        try:
            df.select(*target_cols).write.saveAsTable(stage)
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {stage}")
            raise
        spark.table(stage).write.insertInto(self.name(table), overwrite=True)
        spark.sql(f"DROP TABLE {stage}")

    def create(self, df: DataFrame, table: str) -> None:
        df.write.saveAsTable(self.name(table))


@dataclass
class ViewTarget:
    """Serving names that are views of a Spark catalog database, each over a table of its own.

    ``replace_rows`` writes the rows into a new table and then points the view at it, which is one change of
    the catalog: readers see the old rows or the new ones, and a failure at any step leaves the old. The
    table that the view showed before is dropped last, but for ``keep`` earlier ones, which queries that
    began before the switch still read.
    """
    database: str
    keep: int = 1

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, spark: SparkSession, table: str) -> bool:
        return spark.catalog.tableExists(self.name(table))

    def _versions(self, spark: SparkSession, table: str) -> list[str]:
        """Tables of earlier and unfinished switches, oldest first."""
        listed = spark.sql(f"SHOW TABLES IN `{self.database}` LIKE '{table}__v*'").collect()
        return sorted(r.tableName for r in listed)

    def replace_rows(self, df: DataFrame, table: str) -> None:
        spark = df.sparkSession
        if self.exists(spark, table):  # columns in the order the view has them
            df = df.select(*spark.table(self.name(table)).columns)
        before, new = self._versions(spark, table), f"{table}__v{new_version().lower().replace('-', '_')}"
        try:
            df.write.saveAsTable(self.name(new))
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {self.name(new)}")
            raise
        spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS SELECT * FROM {self.name(new)}")
        for old in before[:max(0, len(before) - self.keep)]:
            spark.sql(f"DROP TABLE IF EXISTS {self.name(old)}")

    def create(self, df: DataFrame, table: str) -> None:
        self.replace_rows(df, table)


def jdbc_transaction(spark: SparkSession, options: Mapping[str, str],
                     statements: Sequence[str]) -> None:
    """Run ``statements`` in one transaction of the database, from the driver;
    they move rows inside the database only."""
    connection = jdbc_connection(spark, options)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            for text in statements:
                statement.executeUpdate(text)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            statement.close()
    finally:
        connection.close()


@dataclass
class JdbcTarget:
    """Serving tables in a relational database over JDBC.

    ``replace_rows`` loads the rows into ``<table>__stage_...`` (tasks insert in
    parallel; the name is new each time, so two publishers do not meet), then empties
    and refills the table from it in one transaction (``transaction``), columns by name:
    readers see the old rows or the new ones, and a failure anywhere leaves the old.
    """
    options: dict[str, str]
    num_partitions: int = 8
    batch_size: int = 10_000
    schema: str = "public"
    transaction: Callable[[SparkSession, Mapping[str, str], Sequence[str]], None] = jdbc_transaction

    def name(self, table: str) -> str:
        return f'"{self.schema}"."{table}"'

    def _write(self, df: DataFrame, table: str) -> None:
        # numPartitions caps concurrent connections (Spark coalesces to it)
        (df.write.format("jdbc")
         .options(**self.options)
         .option("dbtable", self.name(table))
         .option("numPartitions", str(self.num_partitions))
         .option("batchsize", str(self.batch_size))
         .mode("overwrite").save())

    def exists(self, spark: SparkSession, table: str) -> bool:
        probe = (spark.read.format("jdbc").options(**self.options)
                 .option("query",
                         "SELECT COUNT(*) AS n FROM information_schema.tables "
                         f"WHERE table_schema = '{self.schema}' AND table_name = '{table}'")
                 .load().first())
        return bool(probe["n"])

    def replace_rows(self, df: DataFrame, table: str) -> None:
        staged = f"{table}__stage_{uuid.uuid4().hex[:12]}"
        target, stage = self.name(table), self.name(staged)
        columns = ", ".join(f'"{c}"' for c in df.columns)
        self._write(df, staged)
        self.transaction(df.sparkSession, self.options, [
            f"TRUNCATE TABLE {target}",
            f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {stage}",
            f"DROP TABLE {stage}"])

    def create(self, df: DataFrame, table: str) -> None:
        self._write(df, table)


def publish_table(df: DataFrame, target: ServingTarget, serving_table: str,
                  gold_table: str = "") -> PublishResult:
    """K3 / K4 / K5 / K8 for one table; the row count is observed during
    the load itself."""
    spark = df.sparkSession
    obs = Observation(f"publish_{serving_table}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    existed = target.exists(spark, serving_table)
    if existed:
        target.replace_rows(counted, serving_table)
    else:
        target.create(counted, serving_table)
    return PublishResult(gold_table, serving_table, not existed,
                         int(obs.get["rows"]))


def publish_gold(spark: SparkSession, root: str, target: ServingTarget,
                 tables: Mapping[str, str] = SERVING_TABLES, seen: Snapshot | None = None,
                 finished: Mapping[str, int] = MappingProxyType({}),
                 done: Callable[[PublishResult], None] = lambda result: None) -> list[PublishResult]:
    """Publish every Gold table, in order, stop at the first
    error (it propagates; earlier tables stay published). All tables are read through one snapshot
    (``seen``, by default the current one), so they come from one run. ``finished`` has the row
    counts of Gold tables that an interrupted run has published; ``done`` is told of each one."""
    seen = seen or snapshot(spark, root)
    results = []
    for gold_table, serving_table in tables.items():
        if gold_table in finished:
            results.append(PublishResult(gold_table, serving_table, False, finished[gold_table]))
            continue
        df = read_table(spark, root, "gold", gold_table, seen=seen)
        results.append(publish_table(df, target, serving_table, gold_table))
        done(results[-1])
    return results
