"""OP6–OP9, RSH1, RSH2, FLT1, FLT5–FLT10, RAT4–RAT7, D7."""

from __future__ import annotations

from conftest import d, rows, ts
from memberpulse import schemas
from memberpulse.operators import audience as aud
from memberpulse.operators import newsletters as nl


def member(i, labels, subscribed=True, suppressed=False, created="2023-01-01 00:00:00",
           seen="2023-01-01 00:00:00", count=0, rate=None, note=None):
    return (f"m{i}", f"u{i}@x", [{"name": n, "slug": n.lower() if n else None} for n in labels], note,
            subscribed, {"suppressed": suppressed}, count, rate, ts(created), ts(seen))


def test_member_stats_counts_both_languages_and_null_ratios(spark):
    df = spark.createDataFrame([
        member(1, ["English"], seen="2024-01-20 00:00:00"),                       # en active subscriber
        member(2, ["English", "Korean"], subscribed=False, seen="2024-01-15 00:59:59"),   # both, inactive
        member(3, ["English"], suppressed=None),                                 # NULL suppressed: not a subscriber
        member(4, ["Internal"]),                                                 # no language
    ], schemas.MEMBERS)
    got = {r["lang_code"]: r for r in rows(aud.member_stats(df, "2024-01-22"))}
    assert (got["en"]["total"], got["en"]["active"], got["en"]["subscriber"]) == (3, 1, 1)
    assert (got["en"]["engagement_rate"], got["en"]["subscription_rate"]) == (0.333, 0.333)
    assert (got["ko"]["total"], got["ko"]["active"], got["ko"]["subscriber"]) == (1, 0, 0)
    assert got["en"]["date"] == d("2024-01-22")


def test_language_without_members_has_null_ratios(spark):
    df = spark.createDataFrame([member(1, ["English"])], schemas.MEMBERS)
    ko = [r for r in rows(aud.member_stats(df, "2024-01-22")) if r["lang_code"] == "ko"][0]
    assert (ko["total"], ko["engagement_rate"], ko["subscription_rate"]) == (0, None, None)


def test_subscriber_stats(spark):
    df = spark.createDataFrame([
        member(1, ["Korean"], created="2024-01-16 00:00:00"),                                  # new, subscriber
        member(2, ["Korean"], subscribed=False, created="2024-01-16 00:00:00",
               seen="2024-01-21 00:00:00"),                                                    # new and churned
        member(3, ["Korean"], subscribed=False, suppressed=True, seen="2024-01-21 00:00:00"),  # suppressed: ignored
        member(4, ["Korean"], subscribed=None),
    ], schemas.MEMBERS)
    ko = [r for r in rows(aud.subscriber_stats(df, "2024-01-22")) if r["lang_code"] == "ko"][0]
    assert (ko["total"], ko["new"], ko["churn"], ko["net"]) == (1, 2, 1, 1)


NEWS = schemas.NEWSLETTERS


def post(title, status="published", at="2024-01-16 00:00:00", seg="label:english", tag=True,
         sent=100, opened=10, delivered=80, clicks=5):
    return (title, status, ts(at), seg, [{"slug": "newsletters"}] if tag else [{"slug": "other"}],
            {"email_count": sent, "opened_count": opened, "delivered_count": delivered}, {"clicks": clicks})


def test_weekly_newsletters_filters(spark):
    df = spark.createDataFrame([
        post("keep"), post("draft", status="draft"), post("untagged", tag=False),
        post("too early", at="2024-01-14 14:59:59"), post("first local day", at="2024-01-14 15:00:00"),
        post("run day", at="2024-01-21 15:00:00"),
    ], NEWS)
    got = sorted(r["title"] for r in rows(nl.weekly_newsletters(df, "2024-01-22")))
    assert got == ["first local day", "keep"]


def test_newsletter_stats_per_language(spark):
    df = spark.createDataFrame([
        post("en", seg="label:english", opened=1, delivered=16, sent=32, clicks=3),
        post("both", seg="label:english,label:korean", delivered=0),
        post("none", seg="label:japanese"),
    ], NEWS)
    got = sorted((r["title"], r["lang_code"], r["open_rate"], r["click_rate"], r["delivery_rate"], r["date"])
                 for r in rows(nl.newsletter_stats(df)))
    assert got == [("both", "en", None, None, 0.0, d("2024-01-16")),
                   ("both", "ko", None, None, 0.0, d("2024-01-16")),
                   ("en", "en", 0.062, 0.188, 0.5, d("2024-01-16"))]
