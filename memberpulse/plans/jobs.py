"""The reference's three scheduled pipelines as Spark jobs.

* ``run_service_report``  membership CSV + event tables -> weekly and monthly reports (P1)
* ``run_newsletter_kpis`` landed member / post dumps -> KPI date partitions + raw archive (P2)
* ``run_member_upkeep``   member dump + registry -> candidates, invites, registry snapshots (P3)

Scheduling, HTTP calls and credentials are not part of this library: inputs
arrive as landed files or tables, external actions leave as tables
(candidates, invite payloads) and come back as tables of outcomes.

Intermediate results that two branches share are written once to the shared
folder named by ``spark.checkpoint.dir`` (see ``session.shared_dir``): the
written table cuts the lineage, survives the loss of executors, and the
branches read it back column-pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from memberpulse.functions.temporal import DEFAULT_TZ
from memberpulse.operators import audience, engagement, membership, newsletters, registry, upkeep
from memberpulse.session import remove_path, shared_dir
from memberpulse.sources import readers, registry_table, sinks


class JobResult(dict):
    """What a job wrote, by name, and in ``metrics`` what it read: rows, and rows with values that were rejected."""

    def __init__(self):
        super().__init__()
        self.metrics: dict[str, dict[str, int]] = {}

    def note(self, name: str, observation: Observation, max_rejected: int | None) -> None:
        """Keep a read's counts; more than ``max_rejected`` of any kind fail the job before it publishes anything."""
        counts = self.metrics[name] = readers.observed_counts(observation)
        over = {k: v for k, v in counts.items() if k != "rows" and max_rejected is not None and v > max_rejected}
        if over:
            raise ValueError(f"{name}: of {counts['rows']} rows too many were rejected: {over}")


def run_service_report(spark: SparkSession, memberships_root: str, app_events: str, ga_events: str,
                       out_root: str, as_of, active: Column, tz: str = DEFAULT_TZ,
                       null_period: str = "epoch", max_rejected: int | None = None) -> JobResult:
    """Extract -> normalise -> weekly/monthly report -> engagement -> replace both reports.

    ``active``: the rule by which a web event counts as active use (D4); there is no default.
    Both grains are rolled up from one table of daily users, so each log is scanned once.
    Each report is published as a new version of ``{out_root}/{name}`` (``sinks.read_report``);
    the result holds the versions' paths.  ``max_rejected``: the job fails if more rows of
    the CSV have no identity, or have dates or amounts that are no dates or amounts.
    The staged memberships and daily users are removed at the end.
    """
    stage, written, seen = shared_dir(spark), JobResult(), Observation("memberships")
    try:
        rows = readers.read_memberships_csv(spark, memberships_root, as_of, observation=seen)
        membership.with_periods(rows, tz).write.parquet(f"{stage}/membership_periods")
        written.note("memberships", seen, max_rejected)
        engagement.daily_users(readers.read_table(spark, app_events), readers.read_table(spark, ga_events), active, tz
                               ).write.parquet(f"{stage}/daily_users")
        periods = spark.read.parquet(f"{stage}/membership_periods")
        daily = spark.read.parquet(f"{stage}/daily_users")
        for grain, period, name in (("week", membership.WEEK, "weekly_metrics"),
                                    ("month", membership.MONTH, "monthly_metrics")):
            report = membership.member_report(periods, period, tz, null_period)
            users = engagement.roll_up(daily, grain)
            written[name] = sinks.publish_report(engagement.with_engagement(report, users, period, null_period),
                                                 f"{out_root.rstrip('/')}/{name}")
        return written
    finally:
        remove_path(spark, stage)


MEMBER_STATS = ("date date, total bigint, active bigint, subscriber bigint, engagement_rate double, "
                "subscription_rate double, lang_code string")
SUBSCRIBER_STATS = "date date, total bigint, new bigint, churn bigint, net bigint, lang_code string"
NEWSLETTER_STATS = ("date date, sent bigint, opened bigint, clicked bigint, delivered bigint, "
                    "open_rate double, click_rate double, delivery_rate double, title string, "
                    "lang_code string")


def run_newsletter_kpis(spark: SparkSession, member_pages: str, post_pages: str, kpi_root: str,
                        archive_root: str, as_of, tz: str = DEFAULT_TZ,
                        tables: tuple[str, str, str] = ("member_kpis", "subscriber_kpis", "newsletter_kpis"),
                        page: str | None = "page") -> dict[str, str]:
    """Archive the raw dumps, write three KPI tables into their run-date partitions.

    ``tables``: names of the member, subscriber and newsletter tables, folders of
    ``kpi_root``; with an empty ``kpi_root``, names of existing catalog tables, whose own
    schemas hold.  ``page``: where the dumps have their page numbers (``readers``).
    """
    stage = f"{shared_dir(spark)}/members"
    readers.read_member_pages(spark, member_pages, page=page).write.parquet(stage)
    members = spark.read.parquet(stage)
    try:
        posts = newsletters.weekly_newsletters(readers.read_post_pages(spark, post_pages, page=page), as_of, tz)
        written = {
            "members.json": sinks.archive_raw(spark, member_pages, archive_root, as_of, "members.json"),
            "newsletters.json": sinks.archive_raw(spark, post_pages, archive_root, as_of, "newsletters.json"),
        }
        outputs = (
            (tables[0], audience.member_stats(members, as_of, tz), MEMBER_STATS),
            (tables[1], audience.subscriber_stats(members, as_of, tz), SUBSCRIBER_STATS),
            (tables[2], newsletters.newsletter_stats(posts, tz), NEWSLETTER_STATS),
        )
        for name, df, ddl in outputs:
            target = f"{kpi_root.rstrip('/')}/{name}" if kpi_root else name
            sinks.overwrite_partitions(df, target, "date", spark.createDataFrame([], ddl).schema)
            written[name] = target
        return written
    finally:
        remove_path(spark, stage)


def plan_deletions(members: DataFrame) -> DataFrame:
    """P3 step 1: ids and emails to delete (OP10)."""
    return upkeep.inactive_members(members).select("id", "email")


def plan_invites(members: DataFrame, deleted_ids: DataFrame, registry_df: DataFrame,
                 member_limit, seed: str) -> DataFrame:
    """P3 step 2: capacity after confirmed deletions (OP11), then that many invites (OP12).

    The capacity is one number; it is the only value brought to the driver.
    """
    n = upkeep.capacity(members, deleted_ids, member_limit).first()["capacity"]
    return upkeep.invite_batch(registry_df, int(n or 0), seed)


def run_member_upkeep(spark: SparkSession, members_path: str, registry_path: str, out_root: str,
                      now, member_limit, seed: str, deleted_ids_path: str | None = None,
                      failed_path: str | None = None, fresh_members_path: str | None = None,
                      page: str | None = "page", max_rejected: int | None = None) -> JobResult:
    """P3, staged by the outcome tables available.

    Always writes the deletion candidates.  With ``deleted_ids_path`` (ids
    confirmed deleted) it writes the invite batch.  With ``failed_path``
    (emails whose invite failed) those rows of the registry become 'failed'.  With
    ``fresh_members_path`` (the dump re-read after deletions and invites) the registry is
    synced against it.  Both reports are new versions (``sinks.publish_report``).

    ``registry_path``: a snapshot (path or table), whose next snapshots go to paths keyed by
    ``now``, which a retry of the run replaces, and which itself is never overwritten; or the
    name of a ``registry_table``, which is changed in place.  ``max_rejected``: the job fails
    if more registry rows have no email; they are counted when the registry is written.
    """
    out, written = out_root.rstrip("/"), JobResult()
    run = "run=" + "".join(c for c in str(now) if c.isdigit())
    in_place = registry_table.is_registry_table(spark, registry_path)
    members = readers.read_member_pages(spark, members_path, page=page)
    reg = registry_table.registry_rows(spark, registry_path) if in_place else readers.read_table(spark, registry_path)
    written["deletion_candidates"] = sinks.publish_report(plan_deletions(members), f"{out}/deletion_candidates")
    if deleted_ids_path:
        deleted = readers.read_table(spark, deleted_ids_path)
        written["invites"] = sinks.publish_report(plan_invites(members, deleted, reg, member_limit, seed), f"{out}/invites")
    failed = readers.read_table(spark, failed_path) if failed_path else None
    fresh = readers.read_member_pages(spark, fresh_members_path, page=page) if fresh_members_path else None
    if in_place and (failed_path or fresh_members_path):
        seen = Observation("registry")
        readers.observed(reg.select("email"), seen, null_emails=F.col("email").isNull()).write.format("noop").mode("overwrite").save()
        written.note("registry", seen, max_rejected)
        if failed_path:
            registry_table.set_status(spark, registry_path, failed, registry.FAILED, now)
        if fresh_members_path:
            registry_table.sync(spark, registry_path, fresh, now)
        written["registry"] = registry_path
        return written
    if failed_path:
        reg = _next_snapshot(written, "registry_failed", f"{out}/registry_v1/{run}", reg, max_rejected,
                             lambda rows: registry.set_status(rows, failed, registry.FAILED, now))
    if fresh_members_path:
        _next_snapshot(written, "registry_synced", f"{out}/registry_v2/{run}", reg, max_rejected,
                       lambda rows: registry.sync(rows, fresh, now))
    return written


def _next_snapshot(written: JobResult, name: str, path: str, reg: DataFrame, max_rejected: int | None, change) -> DataFrame:
    """Write ``change(registry)`` as a snapshot, counting the rows that were read."""
    seen = Observation(name)
    rows = readers.observed(reg, seen, null_emails=F.col("email").isNull())
    sinks.write_snapshot(change(rows), path, replace=True)
    written.note(name, seen, max_rejected)
    written[name] = path
    return reg.sparkSession.read.parquet(path)
