"""OP1, OP2, AGG1–AGG6, WIN1–WIN3, RAT1–RAT2 and traps T1–T5, T8."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL, d, plan_text, rows, ts
from memberpulse import schemas
from memberpulse.operators import membership as mem
from memberpulse.plans.catalog import membership_periods


def memberships(spark, data):
    return spark.createDataFrame(
        [(i + 1, ident, st, ts(sd), ts(pd), ts(cd), amt, ref)
         for i, (ident, st, sd, pd, cd, amt, ref) in enumerate(data)],
        schemas.MEMBERSHIPS)


def test_with_periods_picks_date_by_status(spark):
    df = memberships(spark, [
        (1, "paid", "2024-01-01 00:00:00", "2024-01-10 16:00:00", None, 10.0, None),   # Seoul Thu 01-11
        (2, "signup", "2024-01-07 15:30:00", None, None, None, None),                   # Seoul Mon 01-08
        (3, "churn", "2024-01-01 00:00:00", None, "2024-02-01 00:00:00", None, None),
        (4, "churn", "2024-01-01 00:00:00", None, None, None, None),                    # no churn date
        (5, "refunded", "2024-01-01 00:00:00", "2024-01-02 00:00:00", None, None, 5.0),  # other status
        (6, "scheduled", "2024-01-01 00:00:00", None, None, None, None),                # no payment date
    ])
    got = rows(mem.with_periods(df).select("identity", mem.WEEK, mem.MONTH), "identity")
    assert [(r["identity"], r[mem.WEEK], r[mem.MONTH]) for r in got] == [
        (1, d("2024-01-08"), d("2024-01-01")),
        (2, d("2024-01-08"), d("2024-01-01")),
        (3, d("2024-01-29"), d("2024-02-01")),
        (4, None, None), (5, None, None), (6, None, None)]


def test_with_periods_parses_text_dates_leniently(spark):
    df = spark.createDataFrame(
        [(1, 7, "signup", "2024-01-07T15:30:00Z", "garbage", None, None, None)],
        schemas.MEMBERSHIPS_CSV)
    r = mem.with_periods(df).first()
    assert r["signup_date"] == ts("2024-01-07 15:30:00") and r["payment_date"] is None
    assert r[mem.WEEK] == d("2024-01-08")


def report_of(spark, data, null_period="epoch", period=mem.WEEK):
    return rows(mem.member_report(mem.with_periods(memberships(spark, data)), period,
                                  null_period=null_period), None)


def test_first_seen_is_file_order_and_null_period_counts_nowhere(spark):
    """First row by row_id, not by date; T3: a first row without period counts nowhere."""
    data = [
        (1, "paid", "2024-01-01 00:00:00", "2024-01-16 00:00:00", None, 1.0, None),   # week 01-15, first row of 1
        (1, "signup", "2024-01-02 00:00:00", None, None, None, None),                 # week 01-01, earlier date
        (2, "scheduled", "2024-01-01 00:00:00", None, None, None, None),              # first row of 2: no period
        (2, "signup", "2024-01-02 00:00:00", None, None, None, None),
    ]
    got = {r[mem.WEEK]: r for r in report_of(spark, data)}
    assert got[d("2024-01-15")]["signup_count"] == 1
    assert got[d("2024-01-01")]["signup_count"] == 0
    assert sum(r["signup_count"] for r in got.values()) == 1


def test_null_period_row_parity_epoch_and_drop(spark):
    """The period-less rows give a last row dated 1970-01-01 with zeros and final running totals."""
    data = [
        (1, "first paid", "2024-01-01 00:00:00", "2024-01-01 01:00:00", None, 10.0, None),
        (2, "signup", "2024-01-08 00:00:00", None, None, None, None),
        (3, "refunded", "2024-01-08 00:00:00", "2024-01-09 00:00:00", None, None, 4.0),   # no period
    ]
    rep = report_of(spark, data)
    assert [r[mem.WEEK] for r in rep] == [d("2024-01-01"), d("2024-01-08"), d("1970-01-01")]
    epoch = [r for r in rep if r[mem.WEEK] == d("1970-01-01")][0]
    assert (epoch["signup_count"], epoch["first_paid_count"], epoch["payment"], epoch["refund"]) == (0, 0, 0.0, 0.0)
    assert epoch["cumsum_signup_count"] == 2 and epoch["cumsum_active_paid"] == 1
    assert epoch["signup_to_paid"] == 0.0 and epoch["free_to_paid"] == 1.0
    dropped = report_of(spark, data, null_period="drop")
    assert len(dropped) == 2 and d("1970-01-01") not in [r[mem.WEEK] for r in dropped]


def test_distinct_counts_flags_and_money(spark):
    data = [
        (1, "paid", "2024-01-01 00:00:00", "2024-01-02 00:00:00", None, 10.10, None),
        (1, "paid", "2024-01-01 00:00:00", "2024-01-03 00:00:00", None, 20.20, None),   # same identity twice
        (2, "paid", "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-04 00:00:00", 0.30, None),
        (3, "first paid", "2024-01-02 15:30:00", "2024-01-02 16:00:00", None, 1.0, None),  # same Seoul day
        (4, "first paid", "2024-01-02 14:30:00", "2024-01-02 15:30:00", None, 2.0, None),  # crosses Seoul midnight
        (5, "churn", "2024-01-01 00:00:00", None, "2024-01-03 00:00:00", None, None),
        (None, "paid", "2024-01-01 00:00:00", "2024-01-02 00:00:00", None, 0.4, None),    # unknown identity
    ]
    r = [x for x in report_of(spark, data) if x[mem.WEEK] == d("2024-01-01")][0]
    assert r["active_paid_users"] == 3          # 1, 3, 4 (2 has a churn date; NULL identity not counted)
    assert r["churn_count"] == 2                # 2 and 5
    assert r["first_paid_count"] == 2
    assert r["paid_signup"] == 1                # only identity 3: same local day
    assert r["payment"] == 34.0                 # exact cents: 10.10 + 20.20 + 0.30 + 1 + 2 + 0.4
    assert r["weekly_revenue"] == 34.0


def test_ratios_zero_division_and_half_even(spark):
    """T4: x/0 -> 0; T5: bround(0.0625, 4) keeps 0.0625, 1/16 at 4 places, 3/8 ... half-even."""
    signups = [(i, "signup", "2024-01-01 00:00:00", None, None, None, None) for i in range(1, 4)]
    paid = [(i, "first paid", "2024-01-01 00:00:00", "2024-01-08 00:00:00", None, 1.0, None) for i in range(1, 4)]
    r = [x for x in report_of(spark, signups + paid) if x[mem.WEEK] == d("2024-01-08")][0]
    assert (r["first_paid_count"], r["signup_count"]) == (3, 0)
    assert r["signup_to_paid"] == 0.0           # 3 first paid / 0 signups
    assert (r["cumsum_active_paid"], r["cumsum_active_free"]) == (3, 0)
    assert r["free_to_paid"] == 0.0             # 3 / 0
    df = spark.createDataFrame([(1, 16), (5, 80000), (3, 20000), (0, 0), (-3, 20000)], "a long, b long")
    from memberpulse.functions.ratios import null_ratio, zero_ratio
    got = [tuple(x) for x in df.select(zero_ratio("a", "b", 3), null_ratio("a", "b", 4)).collect()]
    assert got == [(0.062, 0.0625), (0.0, 0.0001), (0.0, 0.0002), (0.0, None), (-0.0, -0.0002)]


def test_running_totals_and_additivity_on_fixture(spark):
    rep = mem.member_report(membership_periods(spark, SF_SMALL), mem.WEEK)
    data = rows(rep, mem.WEEK)
    real = [r for r in data if r[mem.WEEK] != d("1970-01-01")]
    assert sum(r["signup_count"] for r in real) == max(r["cumsum_signup_count"] for r in data)
    first = mem.first_seen_signups(membership_periods(spark, SF_SMALL), mem.WEEK)
    assert first.agg(F.sum("signup_count")).first()[0] == sum(r["signup_count"] for r in real)
    weekly_money = sum(r["payment"] for r in data)
    total = membership_periods(spark, SF_SMALL).where(F.col(mem.WEEK).isNotNull()) \
        .agg(F.sum(F.col("amount").cast("decimal(18,2)"))).first()[0]
    assert abs(weekly_money - float(total)) < 1e-6


def test_report_plan_has_no_expand_udf_or_cartesian(spark):
    plan = plan_text(mem.member_report(membership_periods(spark, SF_SMALL), mem.WEEK))
    for bad in ("Expand", "PythonUDF", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_single_metric_operators_match_report(spark):
    periods = membership_periods(spark, SF_SMALL)
    rep = {r[mem.WEEK]: r for r in rows(mem.member_report(periods, mem.WEEK))}
    for r in rows(mem.churn_and_active(periods)):
        assert (rep[r[mem.WEEK]]["churn_count"], rep[r[mem.WEEK]]["active_paid_users"]) == \
            (r["churn_count"], r["active_paid_users"])
    for r in rows(mem.paid_signups(periods)):
        assert rep[r[mem.WEEK]]["paid_signup"] == r["paid_signup"]
    for r in rows(mem.revenue(periods)):
        assert rep[r[mem.WEEK]]["payment"] == r["payment"]


def test_hot_identity_is_combined_before_the_shuffle(spark, scratch):
    """One identity holds a third of the rows: the plan must partially aggregate
    (period, identity) on the map side before exchanging, and counts stay exact."""
    data = [(1 if i % 3 == 0 else i, "paid", "2024-01-01 00:00:00",
             f"2024-0{1 + i % 2}-{1 + i % 27:02d} 0{i % 10}:00:00", None, 1.0, None) for i in range(3000)]
    memberships(spark, data).write.parquet(f"{scratch}/m")
    df = mem.with_periods(spark.read.parquet(f"{scratch}/m"))
    rep = mem.member_report(df, mem.WEEK)
    plan = plan_text(rep)
    first_exchange = plan.index("Exchange hashpartitioning(week_start_date#")
    assert "partial_min(row_id" in plan[first_exchange:], plan     # partial aggregate below the exchange
    assert "Expand" not in plan
    got = rows(rep)
    assert sum(r["signup_count"] for r in got) == len({r[0] for r in data})   # every identity once
    assert sum(r["payment"] for r in got) == 3000.0
