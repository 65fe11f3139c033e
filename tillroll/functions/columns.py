"""Scalar column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The e-mail shape check. The reference writes
# '^[^@]+@[^@]+\\.[^@]+$' in a non-raw Python string inside SQL text; the SQL
# literal parser then turns "\." into ".", so the pattern that actually runs
# treats the dot as any character ("a@bcd" passes). AS_RUN reproduces the
# reference's results; STRICT requires a literal dot after the "@".
EMAIL_PATTERN_AS_RUN = "^[^@]+@[^@]+.[^@]+$"
EMAIL_PATTERN_STRICT = r"^[^@]+@[^@]+\.[^@]+$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def email_shape(col: Column | str, strict: bool = False) -> Column:
    """True when ``col`` looks like an e-mail address (NULL stays NULL)."""
    return _c(col).rlike(EMAIL_PATTERN_STRICT if strict else EMAIL_PATTERN_AS_RUN)


def digits_only(col: Column | str) -> Column:
    """Drop every non-digit character (all occurrences)."""
    return F.regexp_replace(_c(col), r"[^0-9]", "")


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first || ' ' || last``; NULL when either part is NULL."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def pct_change(curr: Column | str, prev: Column | str, scale: int = 2) -> Column:
    """``round(100 * (curr - prev) / nullif(prev, 0), scale)``.

    NULL when there is no previous value or it is zero. On decimals the
    arithmetic is exact and the rounding is HALF_UP.
    """
    c, p = _c(curr), _c(prev)
    return F.round(F.lit(100) * (c - p) / F.nullif(p, F.lit(0)), scale)


def safe_pct(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    """``round(100.0 * part / nullif(whole, 0), scale)`` with ``100.0`` as the
    SQL decimal literal, so the division is exact decimal arithmetic."""
    return F.round(F.lit(Decimal("100.0")) * _c(part) / F.nullif(_c(whole), F.lit(0)), scale)
