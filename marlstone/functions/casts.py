"""Type casts of the cleaning rules.

Explicit target types, so results do not depend on session settings such as
``spark.sql.timestampType``. A value that its target type cannot hold raises in
any session: under ``spark.sql.ansi.enabled = false`` a plain cast would wrap
an integer around or give NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_cast_sql(column: str, kind: str) -> str:
    """SQL of a cast that keeps NULL and raises for a value without a result."""
    c = f"`{column}`"
    return (f"coalesce(try_cast({c} AS {kind}), CASE WHEN {c} IS NOT NULL THEN CAST(raise_error("
            f"concat('{column}: ', CAST({c} AS STRING), ' is no {kind}')) AS {kind}) END)")


def as_int_sql(column: str) -> str:
    """CAST(x AS INTEGER); overflow raises."""
    return strict_cast_sql(column, "int")


def as_timestamp_sql(column: str) -> str:
    """CAST(x AS TIMESTAMP) as a zone-less timestamp; malformed text raises."""
    return strict_cast_sql(column, "timestamp_ntz")


def as_flag_sql(column: str) -> str:
    """CAST(int AS BOOLEAN): 0 -> false, other -> true, NULL -> NULL."""
    return f"CAST(`{column}` AS BOOLEAN)"


def as_money_sql(column: str) -> str:
    """CAST(decimal AS DOUBLE): nearest double of the decimal value."""
    return f"CAST(`{column}` AS DOUBLE)"


def as_int(column: str) -> Column:
    return F.expr(as_int_sql(column))


def as_timestamp(column: str) -> Column:
    return F.expr(as_timestamp_sql(column))


def as_flag(column: str) -> Column:
    return F.expr(as_flag_sql(column))


def as_money(column: str) -> Column:
    return F.expr(as_money_sql(column))
