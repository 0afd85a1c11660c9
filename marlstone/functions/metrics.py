"""Business arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def zero_if_null(col: Column | str) -> Column:
    """COALESCE(x, 0.0) on a double column."""
    return F.coalesce(_c(col), F.lit(0.0))


def net_profit(price: Column | str, cogs: Column | str,
               refund: Column | str) -> Column:
    """price - cogs - COALESCE(refund, 0.0), left to right.

    Same association order as the rule, so the double result is bit-equal.
    """
    return (_c(price) - _c(cogs)) - zero_if_null(refund)


def round2(col: Column | str) -> Column:
    """ROUND(x, 2) on a double, as round-half-away(x * 100) / 100.

    ``F.round(x, 2)`` rounds the decimal expansion of x instead: for
    23 * 100.0 / 4000 = 0.575 (stored as 0.57499999...) it gives 0.58, while
    the scaled double 57.49999999999999 rounds to 57, i.e. 0.57, which is the
    specified result.
    """
    return F.round(_c(col) * F.lit(100.0), 0) / F.lit(100.0)


def rate_percent(numerator: Column | str, denominator: Column | str) -> Column:
    """ROUND(num * 100.0 / den, 2) as DOUBLE.

    Division by zero gives NULL (``try_divide``) instead of raising under
    ANSI; it cannot occur while the denominator counts non-null keys.
    """
    num = _c(numerator).cast("double") * F.lit(100.0)
    return round2(F.try_divide(num, _c(denominator).cast("double")))
