"""Membership upkeep.

The reference deletes and invites members with one HTTP call per row; here
the Spark jobs stop at tables of candidates / payloads and resume from tables
of outcomes (ids confirmed deleted, emails whose invite failed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.functions.predicates import has_label_other_than, inactive_member

# Fixed value: the registry status of rows waiting for an invite.
PENDING = "pending"
# Buckets of the seeded order: the first so many hex digits of a row's hash.
BUCKET_DIGITS = 4


def inactive_members(members: DataFrame) -> DataFrame:
    """OP10: deletion candidates.

    A member qualifies when some label is not 'Internal' (no labels at all
    protects a member; 'Internal' plus another label does not, T13) and the
    member is unsubscribed, suppressed, or mailed more than 4 times with an
    open rate below 25 (a NULL open rate is not low).
    """
    return members.where(has_label_other_than() & inactive_member())


def capacity(members: DataFrame, deleted_ids: DataFrame, member_limit) -> DataFrame:
    """OP11: free member slots = limit − members before deletion + confirmed deletions.

    ``member_limit`` is an int or a Column over ``total`` (e.g. ``2 * total``).
    One aggregate over the union of both inputs (no join of two one-row
    results); the count is floored at 0 (T12).  Columns: total, deleted,
    member_limit, capacity.
    """
    tagged = (members.select(F.lit(1).alias("is_member"), F.lit(None).cast("string").alias("deleted_id"))
              .unionByName(deleted_ids.select(F.lit(0).alias("is_member"),
                                              F.col("id").cast("string").alias("deleted_id"))))
    counts = tagged.agg(F.coalesce(F.sum("is_member"), F.lit(0)).cast("bigint").alias("total"),
                        F.count_distinct("deleted_id").alias("deleted"))
    limit = member_limit if isinstance(member_limit, Column) else F.lit(member_limit)
    counts = counts.withColumn("member_limit", limit.cast("bigint"))
    return counts.withColumn(
        "capacity", F.greatest(F.lit(0).cast("bigint"),
                               F.col("member_limit") - F.col("total") + F.col("deleted")))


def invite_order(seed: str) -> Column:
    """Reproducible uniform order of registry rows: md5 of email and seed (FN22)."""
    return F.md5(F.concat(F.col("email"), F.lit(str(seed))))


def first_n_by_hash(df: DataFrame, key: Column, tie: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest hex hash ``key`` (ties by ``tie``), at any size the same way.

    Rows are counted per bucket of leading hash digits (at most 16 ** BUCKET_DIGITS counts,
    brought to the driver); they give the cut as a literal.  One pass then takes all rows
    below it, and of the one bucket that the cut goes through the first few by a top-k: no
    join, and no sort of the rows that are taken whole.
    """
    bucket = F.substring(key, 1, BUCKET_DIGITS)
    counts = df.groupBy(bucket.alias("bucket")).count().collect()
    left, cut = n, None
    for b, rows in sorted((r["bucket"], r["count"]) for r in counts):
        if rows > left:
            cut = b
            break
        left -= rows
    if cut is None:
        return df
    whole = df.where(bucket < cut)
    if not left:
        return whole
    return whole.union(df.where(bucket == cut).orderBy(key, tie).limit(left))


def invite_batch(registry: DataFrame, n: int, seed: str) -> DataFrame:
    """OP12: ``n`` pending registry rows in a seeded uniform random order, as invite payloads.

    Rows of equal hash are taken by email; the result itself is in no order.  A pending row
    without an email can't be invited and fails the job (T17).  Payload: email, labels
    [{name: label, slug: lower(label)}], note ('' when NULL) (PRJ7).
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    email = F.when(F.col("email").isNull(), F.raise_error(F.lit("pending registry row without email"))).otherwise(F.col("email"))
    pending = registry.where(F.col("status") == PENDING).select(email.alias("email"), "label", "note")
    picked = first_n_by_hash(pending, invite_order(seed), "email", int(n))
    return picked.select(
        "email",
        F.array(F.struct(F.col("label").alias("name"), F.lower("label").alias("slug"))).alias("labels"),
        F.coalesce(F.col("note"), F.lit("")).alias("note"))
