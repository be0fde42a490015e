from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from memberpulse.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4,
                    conf={"spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="memberpulse-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="memberpulse-test-")


def ts(text: str | None) -> dt.datetime | None:
    """A UTC wall-clock timestamp for TIMESTAMP_NTZ columns."""
    return None if text is None else dt.datetime.fromisoformat(text)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, order_by=None) -> list[dict]:
    if order_by:
        df = df.orderBy(*order_by) if isinstance(order_by, (list, tuple)) else df.orderBy(order_by)
    return [r.asDict(recursive=True) for r in df.collect()]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
