"""Relational source tables.

``JdbcSource`` reads a source table in parallel: the primary key's values are cut
into slices of equally many rows, one JDBC query per task, instead of one
statement streaming the whole table through a single connection. All statements of
an extract can see the database as of one moment (``JdbcSource.consistent``).
``CatalogSource`` reads the same tables from the Spark catalog (used to stage
fixtures and in tests; no database server is involved).

Either way a table comes with all its columns and the source's own types
(``SELECT *``); any table can be read. Declared columns are checked when Bronze
is written, and cast by the cleaners.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from marlstone.schemas import BRONZE, PRIMARY_KEYS

DB_VARS = ("DB_HOST", "DB_PORT", "DB_NAME", "DB_USER", "DB_PASSWORD")


def jdbc_options(env: Mapping[str, str] | None = None,
                 driver: str = "org.postgresql.Driver",
                 scheme: str = "postgresql") -> dict[str, str]:
    """JDBC url / user / password / driver from the environment.

    All five ``DB_*`` variables are required; there are no default
    credentials. (The JDBC driver jar must be on the Spark classpath.)
    """
    env = os.environ if env is None else env
    missing = [v for v in DB_VARS if not env.get(v)]
    if missing:
        raise KeyError(f"environment variables not set: {', '.join(missing)}")
    return {
        "url": f"jdbc:{scheme}://{env['DB_HOST']}:{env['DB_PORT']}/{env['DB_NAME']}",
        "user": env["DB_USER"],
        "password": env["DB_PASSWORD"],
        "driver": driver,
    }


def jdbc_connection(spark: SparkSession, options: Mapping[str, str]):
    """A connection of the driver's own to the database."""
    jvm = spark.sparkContext._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = jvm.java.lang.Class.forName(options["driver"], True, loader)
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if options.get(name):
            properties.setProperty(name, options[name])
    return driver.getDeclaredConstructor().newInstance().connect(options["url"], properties)


@contextmanager
def exported_snapshot(spark: SparkSession, options: Mapping[str, str]) -> Iterator[str]:
    """Name of a snapshot that other transactions of the database can take over,
    held by an open transaction until the block ends."""
    connection = jdbc_connection(spark, options)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        statement.execute("SET TRANSACTION ISOLATION LEVEL REPEATABLE READ, READ ONLY")
        rows = statement.executeQuery("SELECT pg_export_snapshot()")
        rows.next()
        yield rows.getString(1)
        connection.rollback()
    finally:
        connection.close()


def slice_predicates(key: str, starts: list) -> list[str]:
    """One condition for each slice: from its start to the next one's. Together
    they hold for every row once, NULL keys and keys outside the starts included."""
    at = [str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'" for v in starts[1:]]
    if not at:
        return ["1 = 1"]
    return ([f"{key} < {at[0]} OR {key} IS NULL"]
            + [f"{key} >= {lo} AND {key} < {hi}" for lo, hi in zip(at, at[1:])]
            + [f"{key} >= {at[-1]}"])


class TableSource(Protocol):
    """``consistent`` gives the source to read several tables from as of one moment."""

    def read(self, spark: SparkSession, table: str) -> DataFrame: ...

    def consistent(self, spark: SparkSession) -> AbstractContextManager[TableSource]: ...


@dataclass
class JdbcSource:
    """Parallel JDBC read in slices of the table's primary key, each of
    ``rows_per_slice`` rows however the key's values lie (a repeated value stays in
    one slice). How many run at a time is up to the cluster's cores; ``max_slices``
    bounds the statements, and so the starts that the driver keeps.

    ``consistent`` lets every statement see one exported snapshot. A task that is run again
    sees it too; once the holding transaction is lost, later tasks fail. Only PostgreSQL
    has it; for other databases set ``common_snapshot`` to False: each statement then sees
    the rows of its own moment."""
    options: dict[str, str]
    rows_per_slice: int = 1_000_000
    max_slices: int = 100_000
    fetch_size: int = 10_000
    schema: str = "public"
    keys: Mapping[str, str] = field(default_factory=lambda: PRIMARY_KEYS)
    extra: dict[str, str] = field(default_factory=dict)
    common_snapshot: bool = True

    def _reader(self, spark: SparkSession):
        r = (spark.read.format("jdbc").options(**self.options)
             .option("fetchsize", str(self.fetch_size))
             .option("preferTimestampNTZ", "true"))
        for k, v in self.extra.items():
            r = r.option(k, v)
        return r

    def _query(self, spark: SparkSession, text: str) -> DataFrame:
        return self._reader(spark).option("query", text).load()

    def slice_starts(self, spark: SparkSession, table: str, key: str) -> list:
        """First key of each slice, ascending: one count and, for more than one
        slice, one pass over the key in its index's order."""
        name = f"{self.schema}.{table}"
        n = self._query(spark, f"SELECT COUNT({key}) AS n FROM {name}").first()["n"]
        depth = max(self.rows_per_slice, -(-n // self.max_slices))
        if n <= depth:
            return []
        rows = self._query(spark, (
            f"SELECT k FROM (SELECT {key} AS k, ROW_NUMBER() OVER (ORDER BY {key}) AS r "
            f"FROM {name} WHERE {key} IS NOT NULL) ranked WHERE MOD(r - 1, {depth}) = 0")).collect()
        return sorted({r["k"] for r in rows})

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        qualified = f"{self.schema}.{table}"
        key = self.keys.get(table)
        starts = self.slice_starts(spark, table, key) if key else []
        if len(starts) > 1:
            return self._reader(spark).jdbc(self.options["url"], qualified,
                                            predicates=slice_predicates(key, starts))
        return self._reader(spark).option("dbtable", qualified).load()

    @contextmanager
    def consistent(self, spark: SparkSession) -> Iterator[JdbcSource]:
        if not self.common_snapshot:
            yield self
            return
        if not self.options["url"].startswith("jdbc:postgresql:"):
            raise ValueError("a common snapshot needs PostgreSQL: set common_snapshot=False")
        if self.fetch_size <= 0:  # Spark then leaves auto-commit on, and SET TRANSACTION has no effect
            raise ValueError("a common snapshot needs a fetch_size above 0")
        with exported_snapshot(spark, self.options) as snapshot:
            yield replace(self, extra={**self.extra, "sessionInitStatement": (
                "SET TRANSACTION ISOLATION LEVEL REPEATABLE READ, READ ONLY; "
                f"SET TRANSACTION SNAPSHOT '{snapshot}'")})


@dataclass
class CatalogSource:
    """Source tables held in a Spark catalog database. The catalog has no snapshot
    over several tables: each is read as it is when its read begins."""
    database: str | None = None
    common_snapshot = False

    @contextmanager
    def consistent(self, spark: SparkSession) -> Iterator[CatalogSource]:
        yield self

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        name = f"{self.database}.{table}" if self.database else table
        return spark.table(name)


def initialize_source(spark: SparkSession, rows: Mapping[str, list[tuple]],
                      database: str | None = None,
                      guard_table: str = "staging_products") -> bool:
    """K9: create missing source tables (declared schemas) in a catalog
    database, and insert ``rows`` only when ``guard_table`` is empty.

    Returns True when rows were inserted. For staging fixtures only.
    """
    def q(t: str) -> str:
        return f"{database}.{t}" if database else t

    for table, schema in BRONZE.items():
        if not spark.catalog.tableExists(q(table)):
            spark.createDataFrame([], schema).write.saveAsTable(q(table))
    if not spark.table(q(guard_table)).isEmpty():
        return False
    for table, table_rows in rows.items():
        if table_rows:
            (spark.createDataFrame(table_rows, BRONZE[table])
             .write.insertInto(q(table)))
    return True
