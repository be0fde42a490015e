"""Membership report.

Plan shape of ``member_report`` (one scan of the memberships):

1. ``groupBy(period, identity)`` — partial aggregation on the map side, so an
   identity holding a third of all rows ships one combined row per map task.
   It keeps the identity's first ``row_id`` in the period, the count of
   'first paid' rows, three "has at least one qualifying row" flags
   (churned / active paid / same-day paid signup) and money sums in whole cents.
2. ``min(first_row) over (partition by identity)`` on that aggregate marks the
   period of the identity's first row in file order (AGG1) — no sort of raw rows.
3. ``groupBy(period)`` sums the flags: exact distinct-identity counts without
   the ``Expand`` that several ``count(distinct)`` in one aggregate would need.
4. Running totals over the few per-period rows (single-partition window on a
   result with one row per week/month; never applied before aggregation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memberpulse.functions.ratios import zero_ratio
from memberpulse.functions.temporal import (DEFAULT_TZ, EPOCH, local_date, month_start, utc_wall,
                                            week_start)

# The reference's status vocabulary.
PERIOD_STATUSES = ("paid", "first paid", "scheduled")   # period from payment_date
SIGNUP = "signup"                                        # period from signup_date
CHURN = "churn"                                          # period from churn_date
FIRST_PAID = "first paid"
PAID_STATUSES = ("paid", "first paid")

WEEK = "week_start_date"
MONTH = "year_month_date"


def money(name: str) -> Column:
    """Money as a wide decimal (T8): sums are exact and order-independent, nothing is rounded; NaN is NULL."""
    amount = F.col(name).cast("double")
    return F.when(~F.isnan(amount), amount).cast("decimal(28,8)")


def from_money(col: Column) -> Column:
    return col.cast("double")

REPORT_COLUMNS = ("signup_count", "cumsum_signup_count", "first_paid_count", "active_paid_users",
                  "churn_count", "cumsum_active_paid", "paid_signup", "free_signup",
                  "cumsum_active_free", "signup_to_paid", "free_to_paid", "payment", "refund",
                  "weekly_revenue")


def period_date_column(tz: str = DEFAULT_TZ) -> Column:
    """PRJ4: the local date a membership row is reported under, NULL if none.

    paid / first paid / scheduled -> payment date; signup -> signup date;
    churn -> churn date.  The three conditions exclude each other.
    """
    st = F.col("payment_status")
    chosen = (F.when(st.isin(*PERIOD_STATUSES) & F.col("payment_date").isNotNull(), F.col("payment_date"))
              .when(st == SIGNUP, F.col("signup_date"))
              .when((st == CHURN) & F.col("churn_date").isNotNull(), F.col("churn_date")))
    return local_date(chosen, tz)


def with_periods(df: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """OP1: normalise every ``*_date`` column (PRJ2, FN1) and add both periods.

    ``week_start_date`` is the local Monday (FN4), ``year_month_date`` the first
    of the local month (FN5); both are DATE and NULL for rows without a period.
    """
    date_cols = [c for c in df.columns if c.endswith("_date")]
    df = df.withColumns({c: utc_wall(df, c) for c in date_cols})
    day = period_date_column(tz)
    return df.withColumns({WEEK: week_start(day), MONTH: month_start(day)})


def _same_local_day(a: str, b: str, tz: str) -> Column:
    """FLT12: equal local dates; NULL dates are never equal."""
    return F.coalesce(local_date(F.col(a), tz) == local_date(F.col(b), tz), F.lit(False))


def member_report(df: DataFrame, period_col: str = WEEK, tz: str = DEFAULT_TZ,
                  null_period: str = "epoch") -> DataFrame:
    """OP2: the membership report at the grain of ``period_col``.

    ``df`` is the output of :func:`with_periods`.  Columns, in order: period,
    signup_count, cumsum_signup_count, first_paid_count, active_paid_users,
    churn_count, cumsum_active_paid, paid_signup, free_signup,
    cumsum_active_free, signup_to_paid, free_to_paid, payment, refund,
    weekly_revenue.

    Rows without a period (T2): ``null_period="epoch"`` (parity with the
    reference) keeps one extra row dated 1970-01-01, ordered last, with zero
    counts and sums and the final running totals; ``"drop"`` removes it.
    Identities whose first row has no period are counted nowhere (T3).
    """
    if null_period not in ("epoch", "drop"):
        raise ValueError("null_period must be 'epoch' or 'drop'")
    st = F.col("payment_status")
    known = F.col("identity").isNotNull()          # a NULL identity adds to no distinct count
    per_identity = df.groupBy(period_col, "identity").agg(
        F.min("row_id").alias("first_row"),
        F.count_if(st == FIRST_PAID).alias("n_first_paid"),
        F.bool_or(known & F.col("churn_date").isNotNull()).alias("churned"),
        F.bool_or(known & F.coalesce(st.isin(*PAID_STATUSES), F.lit(False))
                  & F.col("churn_date").isNull()).alias("active_paid"),
        F.bool_or(known & F.coalesce(st == FIRST_PAID, F.lit(False))
                  & _same_local_day("signup_date", "payment_date", tz)).alias("paid_signup"),
        F.sum(money("amount")).alias("payment"),
        F.sum(money("refund")).alias("refund"),
    )
    first_seen = F.col("first_row") == F.min("first_row").over(Window.partitionBy("identity"))
    per_period = per_identity.withColumn("is_first", first_seen).groupBy(period_col).agg(
        F.count_if("is_first").alias("signup_count"),
        F.sum("n_first_paid").alias("first_paid_count"),
        F.count_if("active_paid").alias("active_paid_users"),
        F.count_if("churned").alias("churn_count"),
        F.count_if("paid_signup").alias("paid_signup"),
        F.sum("payment").alias("payment"),
        F.sum("refund").alias("refund"),
    )
    period = F.col(period_col)
    if null_period == "drop":
        per_period = per_period.where(period.isNotNull())
    else:
        # The row without a period keeps none of its counts or sums.
        zeroed = {c: F.when(period.isNull(), F.lit(0).cast("bigint")).otherwise(F.col(c))
                  for c in ("signup_count", "first_paid_count", "active_paid_users",
                            "churn_count", "paid_signup")}
        zeroed.update({c: F.when(period.isNull(), F.lit(None)).otherwise(F.col(c))
                       for c in ("payment", "refund")})
        per_period = per_period.withColumns(zeroed)
    return _finish_report(per_period, period_col)


def _finish_report(per_period: DataFrame, period_col: str) -> DataFrame:
    """Running totals (WIN1, WIN2), derived columns (PRJ3) and ratios (RAT1, RAT2)."""
    running = (Window.orderBy(F.col(period_col).asc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    payment = F.coalesce(F.col("payment"), F.lit(0).cast("bigint"))
    refund = F.coalesce(F.col("refund"), F.lit(0).cast("bigint"))
    out = per_period.select(
        F.coalesce(F.col(period_col), F.lit(EPOCH)).alias(period_col),
        "signup_count",
        F.sum("signup_count").over(running).alias("cumsum_signup_count"),
        "first_paid_count", "active_paid_users", "churn_count",
        (F.sum("active_paid_users").over(running) - F.sum("churn_count").over(running))
        .alias("cumsum_active_paid"),
        "paid_signup",
        (F.col("signup_count") - F.col("paid_signup")).alias("free_signup"),
        payment.alias("payment"), refund.alias("refund"),
    )
    return out.select(
        period_col, "signup_count", "cumsum_signup_count", "first_paid_count", "active_paid_users",
        "churn_count", "cumsum_active_paid", "paid_signup", "free_signup",
        (F.col("cumsum_signup_count") - F.col("cumsum_active_paid")).alias("cumsum_active_free"),
        zero_ratio("first_paid_count", "signup_count", 4).alias("signup_to_paid"),
        zero_ratio("cumsum_active_paid",
                   F.col("cumsum_signup_count") - F.col("cumsum_active_paid"), 4).alias("free_to_paid"),
        from_money(F.col("payment")).alias("payment"),
        from_money(F.col("refund")).alias("refund"),
        from_money(F.col("payment") - F.col("refund")).alias("weekly_revenue"),
    )


# -- single metrics, each as its own operator (AGG1, AGG3–AGG6) ------------------

def first_seen_signups(df: DataFrame, period_col: str = WEEK) -> DataFrame:
    """AGG1/WIN3: per period, identities whose first row (file order) falls in it.

    ``min_by(period, row_id)`` per identity is a hash-based partial aggregate
    (it keeps the period of the smallest row_id, NULL included); a first row
    without a period counts nowhere (T3).
    """
    first = (df.groupBy("identity")
             .agg(F.min_by(period_col, "row_id").alias(period_col)))
    return (first.where(F.col(period_col).isNotNull())
            .groupBy(period_col).agg(F.count("*").alias("signup_count")))


def _with_period(agg_df: DataFrame) -> DataFrame:
    """Drop the group of rows without a period, after aggregating.

    ``_n`` = count of non-NULL periods in the group (0 only for the NULL group).
    Filtering on an aggregate output keeps Catalyst from pushing the predicate
    below the aggregate, where it would inline and evaluate the whole period
    expression a second time per input row.
    """
    return agg_df.where(F.col("_n") > 0).drop("_n")


def paid_signups(df: DataFrame, period_col: str = WEEK, tz: str = DEFAULT_TZ) -> DataFrame:
    """AGG5: distinct identities with a 'first paid' row paid on the signup day.

    Only periods with such a row appear (as the reference's filter-then-group does).
    """
    hit = F.coalesce(F.col("payment_status") == FIRST_PAID, F.lit(False)) \
        & _same_local_day("signup_date", "payment_date", tz)
    agg = df.groupBy(period_col).agg(
        F.count_distinct(F.when(hit, F.col("identity"))).alias("paid_signup"),
        F.count_if(hit).alias("_hits"), F.count(period_col).alias("_n"))
    return _with_period(agg.where(F.col("_hits") > 0).drop("_hits"))


def churn_and_active(df: DataFrame, period_col: str = WEEK) -> DataFrame:
    """AGG3 + AGG4 per period with one shuffle of (period, identity) pairs.

    ``churn_count``: distinct identities with a churn date (any status);
    ``active_paid_users``: distinct identities with a paid row and no churn date.
    A period where neither holds reports 0 for both.
    """
    known = F.col("identity").isNotNull()
    pairs = df.groupBy(period_col, "identity").agg(
        F.bool_or(known & F.col("churn_date").isNotNull()).alias("churned"),
        F.bool_or(known & F.coalesce(F.col("payment_status").isin(*PAID_STATUSES), F.lit(False))
                  & F.col("churn_date").isNull()).alias("active"))
    return _with_period(pairs.groupBy(period_col).agg(
        F.count_if("churned").alias("churn_count"),
        F.count_if("active").alias("active_paid_users"),
        F.count(period_col).alias("_n")))


def revenue(df: DataFrame, period_col: str = WEEK) -> DataFrame:
    """AGG6: payment and refund sums per period (all-NULL -> 0) and their difference."""
    sums = _with_period(df.groupBy(period_col).agg(
        F.coalesce(F.sum(money("amount")), F.lit(0).cast("bigint")).alias("p"),
        F.coalesce(F.sum(money("refund")), F.lit(0).cast("bigint")).alias("r"),
        F.count(period_col).alias("_n")))
    return sums.select(period_col, from_money(F.col("p")).alias("payment"),
                       from_money(F.col("r")).alias("refund"),
                       from_money(F.col("p") - F.col("r")).alias("weekly_revenue"))
