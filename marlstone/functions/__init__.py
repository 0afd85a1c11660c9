"""Column expressions: built-in Spark functions only (no UDFs)."""

from marlstone.functions.casts import (
    as_flag, as_flag_sql, as_int, as_int_sql, as_money, as_money_sql, as_timestamp,
    as_timestamp_sql)
from marlstone.functions.exact import exact_sums, merged_sums, slot_sums
from marlstone.functions.metrics import net_profit, rate_percent, round2, zero_if_null
from marlstone.functions.text import (
    SPACE_SEPARATORS, normalize_text, normalize_text_sql, trim_spaces, trim_spaces_sql)

__all__ = [
    "SPACE_SEPARATORS", "as_flag", "as_flag_sql", "as_int", "as_int_sql", "as_money",
    "as_money_sql", "as_timestamp", "as_timestamp_sql", "exact_sums", "merged_sums", "net_profit",
    "normalize_text", "normalize_text_sql", "rate_percent", "round2", "slot_sums", "trim_spaces",
    "trim_spaces_sql", "zero_if_null",
]
