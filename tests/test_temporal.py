"""FN1–FN11, FLT5, FLT6, T6, T7, T18."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import d, ts
from memberpulse.functions import temporal as tm


def test_lenient_parse_naive_zoned_and_garbage(spark):
    df = spark.createDataFrame(
        [("2024-03-10 23:30:00",), ("2024-03-10T23:30:00Z",), ("2024-03-11 08:30:00+09:00",),
         ("2024-03-10",), ("not a date",), (None,), (" 2024-01-05 07:00:00 ",)], "s string")
    got = [r[0] for r in df.select(tm.lenient_timestamp(F.col("s"))).collect()]
    assert got == [ts("2024-03-10 23:30:00"), ts("2024-03-10 23:30:00"), ts("2024-03-10 23:30:00"),
                   ts("2024-03-10 00:00:00"), None, None, ts("2024-01-05 07:00:00")]


def test_week_edge_is_local(spark):
    """2024-03-10 23:30 UTC is Monday 03-11 in Seoul, so its week starts 03-11."""
    df = spark.createDataFrame([(ts("2024-03-10 23:30:00"),), (ts("2024-03-10 14:59:59"),)],
                               T.StructType([T.StructField("t", T.TimestampNTZType())]))
    day = tm.local_date(tm.utc_wall(df, "t"))
    got = df.select(day.alias("day"), tm.week_start(day).alias("wk"), tm.month_start(day).alias("mo")).collect()
    assert [tuple(r) for r in got] == [(d("2024-03-11"), d("2024-03-11"), d("2024-03-01")),
                                       (d("2024-03-10"), d("2024-03-04"), d("2024-03-01"))]


def test_results_do_not_depend_on_session_zone(spark):
    """NTZ and instant inputs give the same local dates under any session zone."""
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 23:30:00' AS ntz, "
                   "timestamp'2024-03-10 23:30:00+00:00' AS ltz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = df.select(tm.local_date(tm.utc_wall(df, "ntz")), tm.local_date(tm.utc_wall(df, "ltz"))).first()
            assert tuple(r) == (d("2024-03-11"), d("2024-03-11")), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_member_window_opens_at_ten_local(spark):
    """FLT6 / T7: [as_of − 7d 10:00, as_of 10:00) Seoul = [.. 01:00, .. 01:00) UTC."""
    df = spark.createDataFrame(
        [(ts("2024-01-15 00:59:59"),), (ts("2024-01-15 01:00:00"),), (ts("2024-01-22 00:59:59"),),
         (ts("2024-01-22 01:00:00"),), (None,)],
        T.StructType([T.StructField("t", T.TimestampNTZType())]))
    got = [r[0] for r in df.select(tm.in_member_window(df, "t", "2024-01-22")).collect()]
    assert got == [False, True, True, False, False]


def test_date_window_uses_local_midnight(spark):
    """FLT5 / T7: local date in [as_of − 7d, as_of)."""
    df = spark.createDataFrame(
        [(ts("2024-01-14 14:59:59"),), (ts("2024-01-14 15:00:00"),), (ts("2024-01-21 14:59:59"),),
         (ts("2024-01-21 15:00:00"),)],
        T.StructType([T.StructField("t", T.TimestampNTZType())]))
    got = [r[0] for r in df.select(tm.in_date_window(df, "t", "2024-01-22")).collect()]
    assert got == [False, True, True, False]


def test_window_bounds_fold_to_literals_and_push_down(spark, scratch):
    path = f"{scratch}/t"
    spark.createDataFrame([(ts("2024-01-16 00:00:00"),)],
                          T.StructType([T.StructField("t", T.TimestampNTZType())])).write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.where(tm.in_member_window(df, "t", "2024-01-22"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t,2024-01-15T01:00), LessThan(t,2024-01-22T01:00)]" in plan, plan
    plan = df.where(tm.in_date_window(df, "t", "2024-01-22"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t,2024-01-14T15:00), LessThan(t,2024-01-21T15:00)]" in plan, plan


def test_truncate_now(spark):
    r = spark.range(1).select(tm.truncate_now("2024-01-22 05:00:00.789")).first()[0]
    assert r == ts("2024-01-22 05:00:00")


def test_sizing_conf_scales_with_input():
    from memberpulse.session import sizing_conf
    small, big = sizing_conf(10 << 20), sizing_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "409600"
    assert sizing_conf(1 << 40)["spark.sql.shuffle.partitions"] == "4096"
