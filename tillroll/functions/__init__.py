"""Column expressions shared by the operators (all JVM-side built-ins)."""

from tillroll.functions.columns import (
    EMAIL_PATTERN_AS_RUN,
    EMAIL_PATTERN_STRICT,
    digits_only,
    email_shape,
    full_name,
    pct_change,
    safe_pct,
)
from tillroll.functions.dates import as_of_date, days_since, trailing_window

__all__ = [
    "EMAIL_PATTERN_AS_RUN",
    "EMAIL_PATTERN_STRICT",
    "as_of_date",
    "days_since",
    "digits_only",
    "email_shape",
    "full_name",
    "pct_change",
    "safe_pct",
    "trailing_window",
]
