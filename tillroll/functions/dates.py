"""Date helpers. ``as_of`` is always an explicit date, never the wall clock,
so results are reproducible and the bound folds into a constant. It reaches
the parquet scan as a pushed filter where the compared column is a column of
the file as it stands (or a cast that Catalyst unwraps)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: dt.date | str) -> Column:
    """A DATE literal for ``as_of`` (``date`` or ISO string)."""
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def trailing_window(col: Column | str, as_of: dt.date | str, days: int) -> Column:
    """``col >= as_of - days``: inclusive lower bound, no upper bound.

    Rows dated after ``as_of`` still count, as in the reference; the
    cleaning stage is what removes future-dated orders. Timestamps compare
    against midnight of the first day.
    """
    c = F.col(col) if isinstance(col, str) else col
    return c >= F.date_sub(as_of_date(as_of), days)


def days_since(col: Column | str, as_of: dt.date | str) -> Column:
    """Whole days from ``col`` to ``as_of``."""
    return F.datediff(as_of_date(as_of), F.col(col) if isinstance(col, str) else col)
