"""Inspection helpers.

They work on schemas and catalog metadata, never on collected data: the
only rows built on the driver are one per column, bounded by the schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# SQL type names reported for Spark types, as a SQL DESCRIBE
# names them.
_SQL_TYPE_NAMES = {
    T.ByteType: "TINYINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.FloatType: "FLOAT",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
    T.StringType: "VARCHAR",
    T.BinaryType: "BLOB",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE",
}


def sql_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    for cls, name in _SQL_TYPE_NAMES.items():
        if isinstance(dt, cls):
            return name
    return dt.simpleString().upper()


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Q2: the first ``n`` rows, in no particular order (a LIMIT)."""
    return df.limit(n)


def describe_columns(df: DataFrame) -> DataFrame:
    """Q3: one row per column: (column_name, column_type, nullable)."""
    rows = [(f.name, sql_type_name(f.dataType), f.nullable)
            for f in df.schema.fields]
    schema = "column_name string, column_type string, nullable boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def schema_inventory(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Q4: every table of a catalog database with its columns.

    Columns: table_name, column_name, column_type, nullable. An empty
    database gives an empty result (not an error). Temporary views of the
    session are not tables of the database and left out.
    """
    db = database or spark.catalog.currentDatabase()
    rows = []
    tables = [t for t in spark.catalog.listTables(db) if not t.isTemporary]
    for table in sorted(tables, key=lambda t: t.name):
        for col in spark.catalog.listColumns(f"`{db}`.`{table.name}`"):
            rows.append((table.name, col.name, col.dataType.upper(), col.nullable))
    schema = ("table_name string, column_name string, column_type string, "
              "nullable boolean")
    return spark.createDataFrame(rows, schema)
