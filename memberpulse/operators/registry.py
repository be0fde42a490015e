"""Member registry upkeep as snapshot -> snapshot functions (SURVEY OP13–OP16; SNK4, SNK5,
JON4–JON7, FN11, FN18, T9, T15–T17).

The reference issues SQL ``UPDATE`` and ``MERGE`` against a warehouse table.
Plain files support neither (T9), so every operator here returns the *next*
registry snapshot; the job writes it to a new path, never over the one read.
Joins are on ``email`` (declared non-NULL, T17) and let AQE choose between a
broadcast of a small side and a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberpulse.functions.predicates import first_label_name
from memberpulse.functions.temporal import truncate_now

# The registry's status vocabulary (with "pending", see upkeep.PENDING).
ACTIVE = "active"
DELETED = "deleted"
FAILED = "failed"


def set_status(registry: DataFrame, keys: DataFrame, status: str, now) -> DataFrame:
    """OP13 (SNK4, JON7): rows whose email is in ``keys`` get ``status`` and ``updated_at = now``.

    ``keys`` is de-duplicated first, so repeated keys never multiply rows.
    """
    hits = keys.select("email").distinct().withColumn("_hit", F.lit(True))
    j = registry.join(hits, "email", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    changed = {"updated_at": F.when(hit, truncate_now(now)).otherwise(F.col("updated_at")),
               "status": F.when(hit, F.lit(status)).otherwise(F.col("status"))}
    return j.select(*[changed.get(c, F.col(c)).alias(c) for c in registry.columns])


def _next(registry: DataFrame, columns: dict) -> list:
    """All columns of the registry: those given, the others as they were (NULL for inserts)."""
    return [columns.get(c, F.col(f"t.{c}")).alias(c) for c in registry.columns]


def members_flat(members: DataFrame) -> DataFrame:
    """The dump's registry-facing columns: email, label (first label's name), note, created_at."""
    return members.select("email", first_label_name().alias("label"), "note", "created_at")


def registry_diff(members: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """OP14: (new, missing) against the registry's *active* rows.

    new: dump members whose email is not active in the registry — pending,
    failed or deleted rows present in the dump count as new (T15);
    missing: active registry emails absent from the dump.  Both anti-joins.
    """
    flat = members_flat(members)
    active = registry.where(F.col("status") == ACTIVE).select("email")
    new = flat.join(active, "email", "left_anti")
    missing = active.join(flat.select("email"), "email", "left_anti")
    return new, missing


def _unique_source(source: DataFrame) -> DataFrame:
    """One row per email; a repeated email fails the job, as a MERGE would."""
    grouped = source.groupBy("email").agg(F.count("*").alias("_n"),
                                         F.any_value("label").alias("label"),
                                         F.any_value("note").alias("note"))
    checked_email = F.when(F.col("_n") > 1, F.raise_error(
        F.concat(F.lit("upsert source repeats email "), F.col("email")))).otherwise(F.col("email"))
    return grouped.select(checked_email.alias("email"), "label", "note")


def upsert(registry: DataFrame, source: DataFrame, now) -> DataFrame:
    """OP15 (SNK5, JON6): MERGE ``source`` (email, label, note) into the registry.

    Matched rows become active with ``updated_at = now`` (label, note and
    created_at kept); unmatched source rows are inserted as active with both
    timestamps ``now``; registry rows without a source row are unchanged.
    """
    ts = truncate_now(now)
    t = registry.withColumn("_t", F.lit(True)).alias("t")
    s = _unique_source(source).withColumn("_s", F.lit(True)).alias("s")
    j = t.join(s, F.col("t.email") == F.col("s.email"), "full")
    in_t = F.coalesce(F.col("t._t"), F.lit(False))
    in_s = F.coalesce(F.col("s._s"), F.lit(False))
    columns = {c: F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")) for c in ("email", "label", "note")}
    columns |= {"created_at": F.when(in_t, F.col("t.created_at")).otherwise(ts),
                "updated_at": F.when(in_s, ts).otherwise(F.col("t.updated_at")),
                "status": F.when(in_s, F.lit(ACTIVE)).otherwise(F.col("t.status"))}
    return j.select(*_next(registry, columns))


def sync(registry: DataFrame, members: DataFrame, now) -> DataFrame:
    """OP16: diff against the *old* snapshot, upsert the new members, mark the missing deleted.

    Equal to ``set_status(upsert(registry, new, now), missing, 'deleted', now)``
    with ``(new, missing) = registry_diff(members, registry)``, but planned as
    ONE full outer join of registry and dump on email (the dump side is
    grouped by email first, which both checks uniqueness of upserted emails
    and leaves it hash-partitioned for the join):

    * in both, registry row active      -> unchanged
    * in both, registry row not active  -> active, updated_at = now (T15)
    * registry only, active             -> deleted, updated_at = now
    * registry only, not active         -> unchanged
    * dump only                         -> inserted as active, both timestamps now
    """
    ts = truncate_now(now)
    flat = members_flat(members)
    grouped = flat.groupBy("email").agg(F.count("*").alias("_n"),
                                       F.any_value("label").alias("label"),
                                       F.any_value("note").alias("note"))
    t = registry.withColumn("_t", F.lit(True)).alias("t")
    s = grouped.withColumn("_s", F.lit(True)).alias("s")
    j = t.join(s, F.col("t.email") == F.col("s.email"), "full")
    in_t = F.coalesce(F.col("t._t"), F.lit(False))
    in_s = F.coalesce(F.col("s._s"), F.lit(False))
    was_active = in_t & F.coalesce(F.col("t.status") == ACTIVE, F.lit(False))     # a row without a status isn't active
    upserted = in_s & ~was_active
    deleted = was_active & ~in_s & F.col("t.email").isNotNull()      # a NULL email is in no list of missing ones
    email = F.when(in_t, F.col("t.email")).otherwise(F.col("s.email"))
    checked = F.when(upserted & (F.col("s._n") > 1), F.raise_error(
        F.concat(F.lit("member dump repeats email "), F.col("s.email")))).otherwise(email)
    columns = {c: F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")) for c in ("label", "note")}
    columns |= {"email": checked, "created_at": F.when(in_t, F.col("t.created_at")).otherwise(ts),
                "updated_at": F.when(upserted | deleted, ts).otherwise(F.col("t.updated_at")),
                "status": F.when(upserted, F.lit(ACTIVE)).when(deleted, F.lit(DELETED)).otherwise(F.col("t.status"))}
    return j.select(*_next(registry, columns))


def sync_changes(registry: DataFrame, flat_members: DataFrame) -> DataFrame:
    """What ``sync`` would change: ``(email, label, note, status)``, a row per email that becomes active or deleted.

    ``flat_members``: as ``members_flat`` gives them.  An email that the dump repeats and
    that would become active fails the job (T16).
    """
    grouped = flat_members.groupBy("email").agg(F.count("*").alias("_n"), F.any_value("label").alias("label"),
                                                F.any_value("note").alias("note"))
    held = registry.groupBy("email").agg(F.bool_or(F.col("status") == ACTIVE).alias("_some"),
                                         F.bool_and(F.coalesce(F.col("status") == ACTIVE, F.lit(False))).alias("_all"))
    t, s = held.withColumn("_t", F.lit(True)).alias("t"), grouped.alias("s")
    j = t.join(s, F.col("t.email") == F.col("s.email"), "full")
    in_s = F.col("s._n").isNotNull()
    becomes_active = in_s & ~F.coalesce(F.col("t._all"), F.lit(False))
    becomes_deleted = ~in_s & F.coalesce(F.col("t._some"), F.lit(False)) & F.col("t.email").isNotNull()
    email = F.coalesce(F.col("s.email"), F.col("t.email"))
    checked = F.when(becomes_active & (F.col("s._n") > 1), F.raise_error(
        F.concat(F.lit("member dump repeats email "), F.col("s.email")))).otherwise(email)
    return j.where(becomes_active | becomes_deleted).select(
        checked.alias("email"), "s.label", "s.note", F.when(becomes_active, ACTIVE).otherwise(DELETED).alias("status"))


def apply_changes(registry: DataFrame, changes: DataFrame, now) -> DataFrame:
    """The next snapshot of registry rows under :func:`sync_changes`: equal to ``sync`` of them.

    Of rows with one email only those not yet of the new status change; a new email is inserted.
    """
    ts = truncate_now(now)
    t = registry.withColumn("_t", F.lit(True)).alias("t")
    j = t.join(changes.alias("s"), F.col("t.email") == F.col("s.email"), "full")
    in_t = F.coalesce(F.col("t._t"), F.lit(False))
    was_active = F.coalesce(F.col("t.status") == ACTIVE, F.lit(False))
    hit = ((F.col("s.status") == ACTIVE) & ~was_active) | ((F.col("s.status") == DELETED) & was_active)
    hit = F.coalesce(hit, F.lit(False))
    columns = {c: F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")) for c in ("email", "label", "note")}
    columns |= {"created_at": F.when(in_t, F.col("t.created_at")).otherwise(ts),
                "updated_at": F.when(hit, ts).otherwise(F.col("t.updated_at")),
                "status": F.when(hit, F.col("s.status")).otherwise(F.col("t.status"))}
    return j.select(*_next(registry, columns))
