"""Newsletter selection and KPIs.

Both are narrow (no shuffle): filters that reach the scan, and an ``explode``
of at most one row per language per newsletter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberpulse.functions.predicates import NEWSLETTER_TAG, PUBLISHED, has_slug
from memberpulse.functions.ratios import null_ratio
from memberpulse.functions.temporal import DEFAULT_TZ, in_date_window, local_date, utc_wall
from memberpulse.operators.audience import LANGUAGES


def weekly_newsletters(posts: DataFrame, as_of, tz: str = DEFAULT_TZ) -> DataFrame:
    """OP8: posts tagged 'newsletters', published, local date in [as_of − 7d, as_of)."""
    return posts.where(has_slug("tags", NEWSLETTER_TAG)
                       & (F.col("status") == PUBLISHED)
                       & in_date_window(posts, "published_at", as_of, tz))


def newsletter_stats(news: DataFrame, tz: str = DEFAULT_TZ, languages=LANGUAGES) -> DataFrame:
    """OP9: one row per newsletter and language whose segment names the language.

    Columns: date (local publish date), sent, opened, clicked, delivered,
    open_rate, click_rate, delivery_rate (3 places, NULL when the divisor is 0),
    title, lang_code.  The reference assumes exactly one newsletter per
    language; here every matching newsletter gets its row (RSH2).
    """
    seg = F.col("email_segment")
    codes = F.array_compact(F.array(*[F.when(seg.contains(slug), F.lit(code)) for code, slug in languages]))
    published = utc_wall(news, "published_at")
    rows = news.select(
        local_date(published, tz).alias("date"),
        F.col("email.email_count").alias("sent"),
        F.col("email.opened_count").alias("opened"),
        F.col("count.clicks").alias("clicked"),
        F.col("email.delivered_count").alias("delivered"),
        "title",
        F.explode(codes).alias("lang_code"))
    return rows.select(
        "date", "sent", "opened", "clicked", "delivered",
        null_ratio("opened", "delivered", 3).alias("open_rate"),
        null_ratio("clicked", "delivered", 3).alias("click_rate"),
        null_ratio("delivered", "sent", 3).alias("delivery_rate"),
        "title", "lang_code")
