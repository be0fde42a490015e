"""Member and subscriber KPIs per language.

One scan and one global aggregate: for every language the conditional counts
are separate ``count_if`` columns of a single ``agg`` (partial aggregation per
task, a few longs per partition to the final task), then ``inline`` turns the
one result row into one row per language.  A member carrying both language
labels counts in both; a language without members still gets its row, with
NULL ratios (D7) instead of a division error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.functions.predicates import has_slug, is_false, reachable_subscriber, unsuppressed
from memberpulse.functions.ratios import null_ratio
from memberpulse.functions.temporal import DEFAULT_TZ, as_date, in_member_window

# Fixed values: (lang_code, label slug) pairs the reference reports on.
LANGUAGES = (("en", "english"), ("ko", "korean"))


def per_language(members: DataFrame, counts: dict[str, Column],
                 languages=LANGUAGES) -> DataFrame:
    """RSH1 + AGG11/AGG12: ``count_if(language & predicate)`` for every pair, one row per language."""
    aggs = []
    for code, slug in languages:
        in_lang = has_slug("labels", slug)
        aggs += [F.count_if(in_lang & pred).alias(f"{code}__{name}") for name, pred in counts.items()]
    wide = members.agg(*aggs)
    rows = F.array(*[
        F.struct(*[F.col(f"{code}__{name}").alias(name) for name in counts],
                 F.lit(code).alias("lang_code"))
        for code, _ in languages])
    return wide.select(F.inline(rows))


def member_stats(members: DataFrame, as_of, tz: str = DEFAULT_TZ, languages=LANGUAGES) -> DataFrame:
    """OP6: date, total, active, subscriber, engagement_rate, subscription_rate, lang_code.

    active = last seen in [as_of − 7d 10:00, as_of 10:00) local (FLT6);
    subscriber = subscribed and not suppressed (FLT10).
    """
    counts = {
        "total": F.lit(True),
        "active": in_member_window(members, "last_seen_at", as_of, tz),
        "subscriber": reachable_subscriber(),
    }
    stats = per_language(members, counts, languages)
    return stats.select(
        as_date(as_of).alias("date"), "total", "active", "subscriber",
        null_ratio("active", "total", 3).alias("engagement_rate"),
        null_ratio("subscriber", "total", 3).alias("subscription_rate"),
        "lang_code")


def subscriber_stats(members: DataFrame, as_of, tz: str = DEFAULT_TZ, languages=LANGUAGES) -> DataFrame:
    """OP7: date, total, new, churn, net, lang_code.

    total = subscribed and unsuppressed; new = created in the window and
    unsuppressed, subscribed or not; churn = unsubscribed, seen in the window,
    unsuppressed; net = new − churn.
    """
    counts = {
        "total": reachable_subscriber(),
        "new": in_member_window(members, "created_at", as_of, tz) & unsuppressed(),
        "churn": is_false("subscribed") & in_member_window(members, "last_seen_at", as_of, tz)
        & unsuppressed(),
    }
    stats = per_language(members, counts, languages)
    return stats.select(as_date(as_of).alias("date"), "total", "new", "churn",
                        (F.col("new") - F.col("churn")).alias("net"), "lang_code")
