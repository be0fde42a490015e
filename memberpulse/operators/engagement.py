"""Active users and visitor-to-lead.

``active_users`` is the Spark form of the weekly / monthly active-user SQL:

* app events: distinct users per period (one ``count_distinct``: Spark plans
  it as partial aggregation on (period, user) — no ``Expand``);
* web log: ONE aggregation over (period, user) keeps two flags — "some active
  hit" and "some first-visit hit" — and a second, tiny aggregation counts
  flagged users per period.  Both web-log metrics share one scan and one
  shuffle; the result feeds both the UNION branch and the first-visit side.
* ``union`` of the two per-period counts; first visits attached per period
  (the SQL's full outer join, see ``active_users``), ordered by period.

Everything after the first aggregation has one row per period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memberpulse.functions.ratios import zero_ratio
from memberpulse.functions.temporal import DEFAULT_TZ, local_date, month_start, utc_wall, week_start
from memberpulse.operators.membership import MONTH, REPORT_COLUMNS, WEEK

# Event names that count as a first visit (FLT13).
FIRST_VISIT_EVENTS = ("first_visit", "session_start")


def _start(day: Column, grain: str) -> Column:
    return week_start(day) if grain == "week" else month_start(day)


def _bucket(df: DataFrame, grain: str, tz: str) -> Column:
    return _start(local_date(utc_wall(df, "event_time_utc"), tz), grain)


def _period_name(grain: str) -> str:
    if grain not in ("week", "month"):
        raise ValueError("grain must be 'week' or 'month'")
    return WEEK if grain == "week" else MONTH


def web_log_users(ga: DataFrame, grain: str, active: Column, tz: str = DEFAULT_TZ) -> DataFrame:
    """AGG8 + AGG9: per period, distinct users with an active hit and with a first visit.

    ``active``: the rule by which an event counts as active use (D4, FLT14).  A period
    whose hits match neither predicate still appears, with zeros.
    """
    period = _period_name(grain)
    known = F.col("user_id").isNotNull()
    is_first_visit = F.col("event_name").isin(*FIRST_VISIT_EVENTS)
    pairs = ga.select(_bucket(ga, grain, tz).alias(period), "user_id",
                      F.coalesce(active, F.lit(False)).alias("a"),
                      F.coalesce(is_first_visit, F.lit(False)).alias("f"))
    per_user = pairs.groupBy(period, "user_id").agg(F.bool_or("a").alias("a"), F.bool_or("f").alias("f"))
    return per_user.groupBy(period).agg(
        F.count_if(known & F.col("a")).alias("active_users"),
        F.count_if(known & F.col("f")).alias("first_visit"))


def app_users(app: DataFrame, grain: str = "week", tz: str = DEFAULT_TZ) -> DataFrame:
    """AGG7: distinct app users per period."""
    period = _period_name(grain)
    return (app.select(_bucket(app, grain, tz).alias(period), "user_id")
            .groupBy(period).agg(F.count_distinct("user_id").alias("users")))


def first_visits(ga: DataFrame, grain: str = "week", tz: str = DEFAULT_TZ) -> DataFrame:
    """AGG9 alone: distinct users with a first-visit / session-start hit per period."""
    period = _period_name(grain)
    known = F.col("user_id").isNotNull()
    hit = F.when(F.col("event_name").isin(*FIRST_VISIT_EVENTS) & known, F.col("user_id"))
    return (ga.select(_bucket(ga, grain, tz).alias(period), hit.alias("u"))
            .groupBy(period).agg(F.count_distinct("u").alias("first_visit")))


def daily_users(app: DataFrame, ga: DataFrame, active: Column, tz: str = DEFAULT_TZ) -> DataFrame:
    """One row per local day, log and user: ``(day, web, user_id, uses, visits)``.

    The users of any period of whole days follow from it exactly (:func:`roll_up`), so
    a job that reports weeks and months scans and shuffles each log once.  Ids are kept
    as text, so the two logs may hold them in different types.
    """
    def hits(df: DataFrame, web: bool, uses: Column, visits: Column) -> DataFrame:
        return df.select(local_date(utc_wall(df, "event_time_utc"), tz).alias("day"), F.lit(web).alias("web"),
                         F.col("user_id").cast("string").alias("user_id"),
                         F.coalesce(uses, F.lit(False)).alias("uses"), F.coalesce(visits, F.lit(False)).alias("visits"))

    both = hits(app, False, F.lit(True), F.lit(False)).unionByName(
        hits(ga, True, active, F.col("event_name").isin(*FIRST_VISIT_EVENTS)))
    return both.groupBy("day", "web", "user_id").agg(F.bool_or("uses").alias("uses"), F.bool_or("visits").alias("visits"))


def roll_up(daily: DataFrame, grain: str) -> DataFrame:
    """:func:`active_users` of one grain from the rows of :func:`daily_users`."""
    period = _period_name(grain)
    known = F.col("user_id").isNotNull()
    per_user = daily.groupBy(_start(F.col("day"), grain).alias(period), "web", "user_id").agg(
        F.bool_or("uses").alias("uses"), F.bool_or("visits").alias("visits"))
    counts = per_user.groupBy(period, "web").agg(
        F.count_if(known & F.col("uses")).alias("n"), F.count_if(known & F.col("visits")).alias("fv"))
    return _with_first_visits(counts.withColumn("fv", F.when(F.col("web"), F.col("fv"))), grain)


def active_users(app: DataFrame, ga: DataFrame, grain: str, active: Column,
                 tz: str = DEFAULT_TZ) -> DataFrame:
    """OP3 / OP4: (period, WAU|MAU, first_visit), two rows per period.

    One row carries the app-user count, the other the active web-log users;
    both carry the period's first visits.  Same result as the SQL's
    ``(app ∪ web) FULL OUTER JOIN first_visits ON period``, but the web-log
    aggregate is consumed ONCE: an app row takes the first visits of its
    period from the web row through a window over the few per-period rows
    (referencing the aggregate twice would scan and shuffle the web log twice,
    as column pruning makes the two branches differ).  As in the join, a NULL
    period matches nothing: its rows get 0 first visits and the web log's
    NULL-period first visits come as a row of their own.
    """
    period = _period_name(grain)
    app_rows = app_users(app, grain, tz).select(
        period, F.col("users").alias("n"), F.lit(None).cast("bigint").alias("fv"), F.lit(False).alias("web"))
    web_rows = web_log_users(ga, grain, active, tz).select(
        period, F.col("active_users").alias("n"), F.col("first_visit").alias("fv"), F.lit(True).alias("web"))
    return _with_first_visits(app_rows.unionByName(web_rows), grain)


def _with_first_visits(counts: DataFrame, grain: str) -> DataFrame:
    """The output rows from per-period ``(period, web, n, fv)``; ``fv`` is NULL on app rows."""
    period = _period_name(grain)
    metric = "WAU" if grain == "week" else "MAU"
    p = F.col(period)
    both = counts.withColumn(
        "matched", F.when(p.isNotNull(), F.max("fv").over(Window.partitionBy(period))))
    zero = F.lit(0).cast("bigint")
    own = F.struct(F.col("n").alias("n"), F.coalesce(F.col("matched"), zero).alias("first_visit"))
    unmatched_fv = F.struct(zero.alias("n"), F.col("fv").alias("first_visit"))
    out = F.when(F.col("web") & p.isNull(), F.array(own, unmatched_fv)).otherwise(F.array(own))
    return (both.select(period, F.inline(out))
            .select(period, F.col("n").cast("bigint").alias(metric),
                    F.col("first_visit").cast("bigint").alias("first_visit"))
            .orderBy(period))


def with_engagement(report: DataFrame, engagement: DataFrame, period_col: str = WEEK,
                    null_period: str = "epoch") -> DataFrame:
    """OP5: report ⟗ engagement on the period, missing values 0, then visit_to_lead.

    Engagement-only periods get 0 in every report column, running totals
    included (T11); each report row repeats once per engagement row (T10).
    With ``null_period="epoch"`` a missing period becomes 1970-01-01 (T2).
    """
    metric = [c for c in engagement.columns if c not in (period_col, "first_visit")]
    joined = report.join(engagement, period_col, "full")
    report_types = dict(report.dtypes)
    filled = []
    for c in REPORT_COLUMNS + tuple(metric) + ("first_visit",):
        dtype = report_types.get(c, "bigint")
        filled.append(F.coalesce(F.col(c), F.lit(0).cast(dtype)).alias(c))
    period = F.col(period_col)
    if null_period == "epoch":
        period = F.coalesce(period, F.lit("1970-01-01").cast("date"))
    out = joined.select(period.alias(period_col), *filled)
    return out.withColumn("visit_to_lead", zero_ratio("signup_count", "first_visit", 4))
