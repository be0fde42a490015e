"""Member predicates over nested columns.

All predicates return a non-NULL Boolean: a NULL field counts as "no match",
as the reference's ``== True`` / ``== False`` comparisons on Python objects do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference.
INTERNAL_LABEL = "Internal"
NEWSLETTER_TAG = "newsletters"
PUBLISHED = "published"
HEAVY_EMAIL_COUNT = 4        # email_count > 4 ...
LOW_OPEN_RATE = 25.0         # ... and email_open_rate < 25.0 -> inactive


def has_slug(array_col: str, slug) -> Column:
    """FLT1/FLT7: some element of ``array_col`` has ``slug`` (NULL slugs never match)."""
    target = slug if isinstance(slug, Column) else F.lit(slug)
    return F.coalesce(F.exists(array_col, lambda x: x["slug"].eqNullSafe(target)), F.lit(False))


def has_label_other_than(name: str = INTERNAL_LABEL) -> Column:
    """FLT8: some label's name is not ``name``.

    An empty label list is False; a NULL name counts as "not ``name``" (T13):
    members with no labels are protected, 'Internal' plus another label is not.
    """
    return F.coalesce(F.exists("labels", lambda x: ~x["name"].eqNullSafe(F.lit(name))), F.lit(False))


def is_true(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.eqNullSafe(F.lit(True))


def is_false(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.eqNullSafe(F.lit(False))


def unsuppressed() -> Column:
    return is_false(F.col("email_suppression.suppressed"))


def reachable_subscriber() -> Column:
    """FLT10: subscribed and not suppressed."""
    return is_true("subscribed") & unsuppressed()


def inactive_member() -> Column:
    """FLT11: unsubscribed, suppressed, or heavily mailed with a low open rate.

    A NULL open rate is not low.
    """
    low_engagement = F.coalesce(
        (F.col("email_count") > HEAVY_EMAIL_COUNT) & (F.col("email_open_rate") < LOW_OPEN_RATE),
        F.lit(False))
    return is_false("subscribed") | is_true(F.col("email_suppression.suppressed")) | low_engagement


def first_label_name() -> Column:
    """FN18: name of the first label, NULL for an empty or NULL list."""
    return F.get(F.col("labels"), 0)["name"]
