"""OP3–OP5, AGG7–AGG9, SET1, JON2, JON3, RAT3, T10, T11."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL, d, plan_text, rows, ts
from memberpulse import schemas
from memberpulse.operators import engagement as eng
from memberpulse.operators import membership as mem
from memberpulse.sources import fixtures as fx


def app(spark, data):
    return spark.createDataFrame([(ts(t), f"user{u}@x", u, n) for t, u, n in data], schemas.APP_EVENTS)


def ga(spark, data):
    return spark.createDataFrame([(ts(t), u, n, p, s) for t, u, n, p, s in data], schemas.GA_EVENTS)


def test_active_users_two_rows_per_period(spark):
    a = app(spark, [("2024-01-01 00:00:00", 1, "click"), ("2024-01-02 00:00:00", 1, "click"),
                    ("2024-01-02 00:00:00", 2, "purchase")])
    g = ga(spark, [
        ("2024-01-01 00:00:00", 1, "session_start", "/app/1", 1.0),    # active + first visit
        ("2024-01-01 00:00:00", 3, "error", "/pricing", 50.0),         # neither
        ("2024-01-01 00:00:00", None, "first_visit", "/app/2", 1.0),   # no user: not counted
        ("2024-01-09 00:00:00", 4, "click", "/pricing", 12.0),         # active only, other week
    ])
    got = sorted((r[mem.WEEK], r["WAU"], r["first_visit"]) for r in rows(eng.active_users(a, g, "week", fx.active_use())))
    assert got == [(d("2024-01-01"), 1, 1), (d("2024-01-01"), 2, 1), (d("2024-01-08"), 1, 0)]


def test_app_only_period_gets_zero_first_visits(spark):
    a = app(spark, [("2024-02-01 00:00:00", 1, "click")])
    g = ga(spark, [("2024-01-01 00:00:00", 1, "view", "/x", 1.0)])
    got = sorted((r[mem.MONTH], r["MAU"], r["first_visit"]) for r in rows(eng.active_users(a, g, "month", fx.active_use())))
    assert got == [(d("2024-01-01"), 0, 0), (d("2024-02-01"), 1, 0)]


def test_custom_active_predicate(spark):
    g = ga(spark, [("2024-01-01 00:00:00", 1, "error", "/pricing", 1.0)])
    a = app(spark, [])
    got = rows(eng.active_users(a, g, "week", active=F.col("event_name") == "error"))
    assert [(r["WAU"], r["first_visit"]) for r in got] == [(1, 0)]


def test_with_engagement_duplicates_and_zero_fills(spark):
    """Report rows repeat per engagement row; T11: engagement-only periods are all zero."""
    report = spark.createDataFrame(
        [(d("2024-01-01"), 4, 4, 1, 1, 0, 1, 0, 4, 3, 0.25, 0.3333, 10.0, 0.0, 10.0)],
        f"{mem.WEEK} date, " + ", ".join(
            f"{c} {'double' if c in ('signup_to_paid', 'free_to_paid', 'payment', 'refund', 'weekly_revenue') else 'bigint'}"
            for c in mem.REPORT_COLUMNS))
    engagement = spark.createDataFrame(
        [(d("2024-01-01"), 5, 8), (d("2024-01-01"), 7, 8), (d("2024-01-08"), 2, 0)],
        f"{mem.WEEK} date, WAU bigint, first_visit bigint")
    got = rows(eng.with_engagement(report, engagement, mem.WEEK), [mem.WEEK, "WAU"])
    assert [(r[mem.WEEK], r["signup_count"], r["WAU"], r["visit_to_lead"]) for r in got] == [
        (d("2024-01-01"), 4, 5, 0.5), (d("2024-01-01"), 4, 7, 0.5), (d("2024-01-08"), 0, 2, 0.0)]
    assert got[2]["cumsum_signup_count"] == 0 and got[2]["payment"] == 0.0


def test_web_log_shares_one_scan_and_one_user_shuffle(spark):
    plan = plan_text(eng.active_users(fx.app_events(spark, SF_SMALL), fx.ga_events(spark, SF_SMALL), "week", fx.active_use()))
    assert plan.count("FileScan parquet") == 2, plan   # app events once, web log once
    for bad in ("Expand", "PythonUDF", "CartesianProduct"):
        assert bad not in plan, bad
