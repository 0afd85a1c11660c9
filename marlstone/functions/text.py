"""Text cleaning expressions.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; no Python runs per row. They are written as SQL text: one call into
the JVM builds a whole column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode "space separator" (Zs) characters. The SQL TRIM the
# cleaning rules are specified against strips exactly these at both ends and
# keeps tab, newline and other control characters.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


# The two characters whose lower case in the JVM (full Unicode
# case mapping) differs from the simple one-to-one mapping of the SQL LOWER
# the rules are specified against: capital I with dot above (the JVM gives
# "i" followed by U+0307) and capital sigma (the JVM gives the final sigma
# U+03C2 at the end of a word). Each maps to its simple lower case.
SIMPLE_LOWER_CASE = {"\u0130": "i", "\u03a3": "\u03c3"}


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def trim_spaces_sql(expression: str) -> str:
    """SQL that strips leading and trailing space separators (not tab / newline).

    Spark's ``trim`` strips only U+0020; ``btrim`` with a character set
    strips any character of the set from both ends, which is what TRIM
    means here. The set form is about twice as costly per value as plain
    ``trim``, and every separator except U+0020 is non-ASCII, so the value
    is first trimmed of U+0020 and the set form runs only when the result
    still begins or ends with a non-ASCII character (in binary string order,
    Spark's default, exactly the characters ``>= U+0080``). Otherwise both
    ends are ASCII and not U+0020, so the set form would remove nothing.
    """
    spaced, high = f"trim({expression})", _literal("\u0080")
    return (f"CASE WHEN substring({spaced}, 1, 1) >= {high} OR substring({spaced}, -1, 1) >= {high}"
            f" THEN btrim({spaced}, {_literal(SPACE_SEPARATORS)}) ELSE {spaced} END")


def special_case_letters_sql(column: str) -> str:
    """SQL that replaces the two letters of ``SIMPLE_LOWER_CASE`` by their
    simple lower case. ``translate`` rebuilds the string, so it runs only on
    values that contain one of them (a byte search each)."""
    special = " OR ".join(f"contains({column}, {_literal(ch)})" for ch in SIMPLE_LOWER_CASE)
    return (f"CASE WHEN {special} THEN translate({column}, {_literal(''.join(SIMPLE_LOWER_CASE))}, "
            f"{_literal(''.join(SIMPLE_LOWER_CASE.values()))}) ELSE {column} END")


def normalize_text_sql(column: str, default: str | None = None, lower: bool = True) -> str:
    """SQL of ``[LOWER](TRIM(COALESCE(column, default)))`` in that nesting order.

    The default is applied *before* trimming, so a blank value becomes the
    empty string, not the default (X7). ``lower=False`` keeps case (used for
    the referer and product names).
    """
    c = f"`{column}`"
    if lower:
        # on the raw value, where it is cheap to reference: the two letters
        # are not space separators and the defaults are ASCII, so mapping
        # them before COALESCE and TRIM gives the same result as after
        c = special_case_letters_sql(c)
    if default is not None:
        c = f"coalesce({c}, {_literal(default)})"
    c = trim_spaces_sql(c)
    return f"lower({c})" if lower else c


def trim_spaces(column: str) -> Column:
    return F.expr(trim_spaces_sql(f"`{column}`"))


def normalize_text(column: str, default: str | None = None, lower: bool = True) -> Column:
    return F.expr(normalize_text_sql(column, default, lower))
