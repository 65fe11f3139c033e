import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import build_session  # noqa: E402

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture(scope="session")
def spark():
    import tempfile

    s = build_session(
        "local[*]", app_name="tillroll-tests", shuffle_partitions=8,
        conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tillroll-wh-"),
              "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tillroll-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture(autouse=True, scope="module")
def no_views_left(spark):
    """The sales job's view outlives it; other modules list a database's tables."""
    yield
    spark.catalog.dropTempView("customer_segmented")


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _key(row):
    return tuple((v is not None, v) for v in row)


def sort_rows(items):
    """Sort tuples with NULLs first in every position."""
    return sorted((tuple(r) for r in items), key=_key)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    cols = cols or tuple(df.columns)
    return sort_rows(df.select(*cols).collect())


def plan_text(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
