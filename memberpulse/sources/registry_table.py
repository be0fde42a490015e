"""The member registry as a catalog table that is changed in place, in proportion to the change.

Rows are laid out by a hash of their email: partitions (column ``part``) that are rewritten
separately, each in buckets that a join on the email reads without a shuffle.  A change
finds the partitions it touches, reads those alone, joins them with the changes (only the
changes are shuffled, to the buckets' number) and overwrites those partitions.  All other
files stay as they are.

Each operator gives the same table when it is run again after a failure between two
partitions, with the same ``now``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberpulse.operators import registry
from memberpulse.session import remove_path, shared_dir
from memberpulse.sources.sinks import dynamic_overwrite

PART = "part"
_PARTS, _BUCKETS = "memberpulse.parts", "memberpulse.buckets"


def part_of(parts: int) -> Column:
    return F.pmod(F.xxhash64("email"), F.lit(parts)).cast("int").alias(PART)


def create_registry_table(rows: DataFrame, name: str, parts: int = 64, buckets: int = 8) -> None:
    """Write ``rows`` as the registry table ``name``, which must not exist.

    ``parts``: how finely changes are written; ``buckets``: tasks that read a change's join.
    """
    if PART in rows.columns:
        raise ValueError(f"a registry column can't be named {PART}")
    (rows.select("*", part_of(parts)).repartition(buckets, "email").write.mode("errorifexists")
     .partitionBy(PART).bucketBy(buckets, "email").sortBy("email").saveAsTable(name))
    rows.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PARTS}' = '{parts}', '{_BUCKETS}' = '{buckets}')")


def is_registry_table(spark: SparkSession, name: str) -> bool:
    return "/" not in name and spark.catalog.tableExists(name) and _PARTS in _properties(spark, name)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def registry_rows(spark: SparkSession, name: str) -> DataFrame:
    """All rows of the registry, without the layout's column."""
    return spark.table(name).drop(PART)


def touched(table: DataFrame, found: list[int]) -> DataFrame:
    """The rows of some partitions: the scan lists no other."""
    return table.where(F.col(PART).isin(found))


def _change(spark: SparkSession, name: str, source: DataFrame, apply) -> int:
    """Rewrite the partitions of ``source``'s emails as ``apply(rows, source)``; returns their number.

    ``source`` has at most one row an email, or ``apply`` says what to do; it is staged, as
    it is read for its partitions and for the join.
    """
    properties = _properties(spark, name)
    parts, buckets = int(properties[_PARTS]), int(properties[_BUCKETS])
    stage = shared_dir(spark)
    try:
        source.write.parquet(stage)
        staged = spark.read.schema(source.schema).parquet(stage)
        found = sorted(r[PART] for r in staged.select(part_of(parts)).distinct().collect())    # at most ``parts`` numbers
        if found:
            rows = touched(spark.table(name), found)
            result = apply(rows, staged.repartition(buckets, "email"))
            columns = [c for c in rows.columns if c != PART]
            with dynamic_overwrite(spark):
                result.select(*columns, part_of(parts)).write.mode("overwrite").insertInto(name)
        return len(found)
    finally:
        remove_path(spark, stage)


def upsert(spark: SparkSession, name: str, source: DataFrame, now) -> int:
    """OP15 (MERGE) of ``source`` (email, label, note) into the table; returns the number of partitions written."""
    return _change(spark, name, source.select("email", "label", "note"), lambda rows, s: registry.upsert(rows, s, now))


def set_status(spark: SparkSession, name: str, keys: DataFrame, status: str, now) -> int:
    """OP13 (UPDATE): rows whose email is in ``keys`` get ``status``; returns the number of partitions written."""
    return _change(spark, name, keys.select("email"), lambda rows, s: registry.set_status(rows, s, status, now))


def sync(spark: SparkSession, name: str, members: DataFrame, now) -> int:
    """OP16: new members become active, missing ones deleted; returns the number of partitions written.

    The registry is read once, without a shuffle, to find the changes, and only partitions
    that hold one are written.
    """
    buckets = int(_properties(spark, name)[_BUCKETS])
    dump = registry.members_flat(members).repartition(buckets, "email")
    changes = registry.sync_changes(spark.table(name), dump)
    return _change(spark, name, changes, lambda rows, s: registry.apply_changes(rows, s, now))
