"""Randomised checks: Spark operators vs the DuckDB oracle on generated edge-case inputs.

The fixtures derived from the test tables never contain NULL identities, NULL
event times or statuses outside the vocabulary; these tests do.  The oracle
SQL is the same text used for the registered queries, run over the generated
table instead of the derived one.
"""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_EVEN, Decimal

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from memberpulse import schemas
from memberpulse.operators import engagement as eng
from memberpulse.operators import membership as mem
from memberpulse.plans import oracle as sql
from memberpulse.sources import fixtures as fx
from oracle_compare import _norm

STATUSES = ["paid", "first paid", "scheduled", "signup", "churn", "refunded", None]
BASE = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _ts():
    # hours over ~10 weeks, biased to Seoul midnight (15:00 UTC) and week edges
    return st.one_of(st.none(), st.integers(0, 24 * 70).map(lambda h: BASE + dt.timedelta(hours=h)),
                     st.integers(0, 70).map(lambda d: BASE + dt.timedelta(days=d, hours=14, minutes=59)))


membership_rows = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(1, 6)),                 # identity
    st.sampled_from(STATUSES),
    _ts(), _ts(), _ts(),
    st.one_of(st.none(), st.integers(0, 100000).map(lambda c: c / 100)),
    st.one_of(st.none(), st.integers(0, 100000).map(lambda c: c / 100)),
), min_size=1, max_size=40)


def _canon(records, columns):
    return sorted(tuple(_norm(r[c]) for c in sorted(columns)) for r in records)


@SETTINGS
@given(data=membership_rows, grain=st.sampled_from([mem.WEEK, mem.MONTH]),
       null_period=st.sampled_from(["epoch", "drop"]))
def test_member_report_matches_oracle(spark, data, grain, null_period):
    recs = [(i + 1, *r) for i, r in enumerate(data)]
    df = spark.createDataFrame(recs, schemas.MEMBERSHIPS)
    got = rows(mem.member_report(mem.with_periods(df), grain, null_period=null_period))
    pdf = pd.DataFrame(recs, columns=[f.name for f in schemas.MEMBERSHIPS.fields])
    con = duckdb.connect()
    con.register("memberships_in", pdf)
    text = sql.compose("SELECT * FROM rep", extra={
        "memberships": 'SELECT row_id, CAST("identity" AS BIGINT) AS "identity", payment_status, '
                       "CAST(signup_date AS TIMESTAMP) AS signup_date, CAST(payment_date AS TIMESTAMP) AS payment_date, "
                       "CAST(churn_date AS TIMESTAMP) AS churn_date, CAST(amount AS DOUBLE) AS amount, "
                       "CAST(refund AS DOUBLE) AS refund FROM memberships_in",
        "membership_periods": sql.CTE["membership_periods"].split(" AS (", 1)[1].rsplit(")", 1)[0],
        **sql.report_ctes(grain)})
    if null_period == "drop":
        text = text.replace("SELECT * FROM rep", f"SELECT * FROM rep WHERE {grain} <> DATE '1970-01-01'")
    res = con.execute(text)
    cols = [d[0] for d in res.description]
    want = [dict(zip(cols, r)) for r in res.fetchall()]
    assert _canon(got, cols) == _canon(want, cols)


event_rows = st.lists(st.tuples(
    _ts(), st.one_of(st.none(), st.integers(1, 5)),
    st.sampled_from(["click", "purchase", "first_visit", "session_start", "error"]),
    st.sampled_from(["/app/1", "/pricing"]), st.sampled_from([1.0, 10.0, 30.0]),
), min_size=1, max_size=40)


@SETTINGS
@given(app=event_rows, ga=event_rows, grain=st.sampled_from(["week", "month"]))
def test_active_users_matches_oracle_with_null_periods(spark, app, ga, grain):
    app_df = spark.createDataFrame([(t, None, u, n) for t, u, n, _, _ in app], schemas.APP_EVENTS)
    ga_df = spark.createDataFrame(list(ga), schemas.GA_EVENTS)
    got = rows(eng.active_users(app_df, ga_df, grain, fx.active_use()))
    by_day = eng.roll_up(eng.daily_users(app_df, ga_df, fx.active_use()), grain)
    assert sorted(map(str, rows(by_day))) == sorted(map(str, got))      # one table of days gives both grains
    con = duckdb.connect()
    con.register("app_in", pd.DataFrame([(t, u, n) for t, u, n, _, _ in app],
                                        columns=["event_time_utc", "user_id", "event_name"]))
    con.register("ga_in", pd.DataFrame(ga, columns=[f.name for f in schemas.GA_EVENTS.fields]))
    p, metric = ("week_start_date", "WAU") if grain == "week" else ("year_month_date", "MAU")
    text = sql.compose("SELECT * FROM eng", extra={
        "app_events": "SELECT CAST(event_time_utc AS TIMESTAMP) AS event_time_utc, "
                      "CAST(user_id AS BIGINT) AS user_id, event_name FROM app_in",
        "ga_events": "SELECT CAST(event_time_utc AS TIMESTAMP) AS event_time_utc, CAST(user_id AS BIGINT) AS user_id, "
                     "event_name, page_path, engagement_time_sec FROM ga_in",
        **sql.engagement_ctes(p, metric, grain)})
    res = con.execute(text)
    cols = [d[0] for d in res.description]
    want = [dict(zip(cols, r)) for r in res.fetchall()]
    assert _canon(got, cols) == _canon(want, cols)


def test_report_independent_of_input_partitioning(spark):
    from conftest import SF_SMALL
    from memberpulse.plans.catalog import membership_periods
    base = membership_periods(spark, SF_SMALL)
    one = rows(mem.member_report(base.coalesce(1), mem.WEEK), mem.WEEK)
    many = rows(mem.member_report(base.repartition(13, "row_id"), mem.WEEK), mem.WEEK)
    assert one == many


registry_states = st.dictionaries(st.one_of(st.none(), st.integers(0, 12)), st.sampled_from(["pending", "active", "failed", "deleted"]),
                                  max_size=10)
dump_members = st.sets(st.integers(0, 12), max_size=10)


@SETTINGS
@given(reg_rows=registry_states, dump=dump_members)
def test_fused_sync_equals_diff_upsert_mark(spark, reg_rows, dump):
    """OP16: the single-join sync equals the three steps on the old snapshot, NULL emails included."""
    from memberpulse.operators import registry as reg
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.REGISTRY.fields)
    registry = spark.createDataFrame(
        [(None if k is None else f"u{k}@x", "English" if (k or 0) % 2 else "Korean", None if (k or 0) % 3 else "n",
          dt.datetime(2023, 12, 1), dt.datetime(2023, 12, 2), status) for k, status in reg_rows.items()], nullable)
    members = spark.createDataFrame(
        [(f"m{k}", f"u{k}@x", [{"name": "English", "slug": "english"}] if k % 2 else [], None, True,
          {"suppressed": False}, 0, None, dt.datetime(2024, 1, 1), None) for k in dump], schemas.MEMBERS)
    now = "2024-01-22 05:00:00"
    new, missing = reg.registry_diff(members, registry)
    composed = reg.set_status(reg.upsert(registry, new, now), missing, reg.DELETED, now)
    assert rows(composed, "email") == rows(reg.sync(registry, members, now), "email")


random_members = st.lists(st.tuples(
    st.lists(st.sampled_from(["english", "korean", "internal", None]), max_size=3),   # label slugs
    st.sampled_from([True, False, None]),                                              # subscribed
    st.sampled_from([True, False, None]),                                              # suppressed
    _ts(), _ts(),                                                                      # created, last seen
), min_size=1, max_size=30)


@SETTINGS
@given(data=random_members)
def test_language_kpis_match_brute_force(spark, data):
    """OP6/OP7 against a direct count in Python over the same rows (window: 2024-01-15..22 10:00 KST)."""
    from memberpulse.operators import audience as aud
    lo, hi = dt.datetime(2024, 1, 8, 1), dt.datetime(2024, 1, 15, 1)      # as_of 2024-01-15, in UTC
    recs = [(f"m{i}", f"u{i}@x", [{"name": s, "slug": s} for s in slugs], None, sub, {"suppressed": sup},
             0, None, created, seen) for i, (slugs, sub, sup, created, seen) in enumerate(data)]
    df = spark.createDataFrame(recs, schemas.MEMBERS)
    got_m = {r["lang_code"]: r for r in rows(aud.member_stats(df, "2024-01-15"))}
    got_s = {r["lang_code"]: r for r in rows(aud.subscriber_stats(df, "2024-01-15"))}
    inside = lambda t: t is not None and lo <= t < hi
    for code, slug in (("en", "english"), ("ko", "korean")):
        mine = [r for r in data if slug in r[0]]
        total = len(mine)
        active = sum(inside(r[4]) for r in mine)
        subscriber = sum(r[1] is True and r[2] is False for r in mine)
        assert (got_m[code]["total"], got_m[code]["active"], got_m[code]["subscriber"]) == (total, active, subscriber)
        rate = None if total == 0 else float((Decimal(active) / total).quantize(Decimal("0.001"), rounding=ROUND_HALF_EVEN))
        assert got_m[code]["engagement_rate"] == rate
        new = sum(inside(r[3]) and r[2] is False for r in mine)
        churn = sum(r[1] is False and inside(r[4]) and r[2] is False for r in mine)
        assert (got_s[code]["total"], got_s[code]["new"], got_s[code]["churn"], got_s[code]["net"]) == \
            (subscriber, new, churn, new - churn)


random_posts = st.lists(st.tuples(
    st.sampled_from(["published", "draft", None]),
    st.lists(st.sampled_from(["newsletters", "other", None]), max_size=2),
    st.sampled_from(["label:english", "label:korean", "label:english,label:korean", "label:other", None]),
    _ts(),
    st.integers(0, 50), st.integers(0, 50), st.integers(0, 50), st.integers(0, 50),
), min_size=1, max_size=25)


@SETTINGS
@given(data=random_posts)
def test_newsletters_match_brute_force(spark, data):
    """OP8/OP9 against a direct computation: local (UTC+9) date window [2024-01-08, 2024-01-15)."""
    from memberpulse.operators import newsletters as nl
    recs = [(f"p{i}", status, ts_, seg, [{"slug": t} for t in tags],
             {"email_count": sent, "opened_count": opened, "delivered_count": delivered}, {"clicks": clicks})
            for i, (status, tags, seg, ts_, sent, opened, delivered, clicks) in enumerate(data)]
    df = spark.createDataFrame(recs, schemas.NEWSLETTERS)   # title, status, published_at, segment, tags, ..
    got = sorted((r["title"], r["lang_code"], r["date"], r["open_rate"], r["click_rate"], r["delivery_rate"])
                 for r in rows(nl.newsletter_stats(nl.weekly_newsletters(df, "2024-01-15"))))

    def ratio(a, b):
        if b == 0:
            return None
        return float((Decimal(a) / Decimal(b)).quantize(Decimal("0.001"), rounding=ROUND_HALF_EVEN))

    want = []
    for title, status, ts_, seg, tags, email, count in recs:
        local = None if ts_ is None else ts_ + dt.timedelta(hours=9)
        if status != "published" or "newsletters" not in [t["slug"] for t in tags] or local is None:
            continue
        if not (dt.date(2024, 1, 8) <= local.date() < dt.date(2024, 1, 15)):
            continue
        for code, slug in (("en", "english"), ("ko", "korean")):
            if seg is not None and slug in seg:
                want.append((title, code, local.date(), ratio(email["opened_count"], email["delivered_count"]),
                             ratio(count["clicks"], email["delivered_count"]),
                             ratio(email["delivered_count"], email["email_count"])))
    assert got == sorted(want)
