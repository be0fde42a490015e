"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's test tables through the adapters in
``memberpulse.sources.fixtures`` and runs over whole tables.  The matching
DuckDB text for each key is in ``ORACLE`` (built in ``memberpulse.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberpulse import schemas
from memberpulse.functions import temporal as tm
from memberpulse.operators import audience as aud
from memberpulse.operators import engagement as eng
from memberpulse.operators import membership as mem
from memberpulse.operators import newsletters as nl
from memberpulse.operators import registry as reg
from memberpulse.operators import upkeep as up
from memberpulse.plans import jobs
from memberpulse.plans import oracle as sql
from memberpulse.session import shared_dir
from memberpulse.sources import fixtures as fx
from memberpulse.sources import readers as rd
from memberpulse.sources import registry_table as rt
from memberpulse.sources import sinks as sk

Query = Callable[[SparkSession, str], DataFrame]


def membership_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mem.with_periods(fx.memberships(spark, sf_dir), fx.TZ)


def _report(period: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mem.member_report(membership_periods(spark, sf_dir), period, fx.TZ)
    return run


def _single(op, period: str = mem.WEEK, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(membership_periods(spark, sf_dir), period, **kw)
    return run


def _active(grain: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return eng.active_users(fx.app_events(spark, sf_dir), fx.ga_events(spark, sf_dir), grain, fx.active_use(), fx.TZ)
    return run


def _active_from_days(grain: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        daily = eng.daily_users(fx.app_events(spark, sf_dir), fx.ga_events(spark, sf_dir), fx.active_use(), fx.TZ)
        return eng.roll_up(daily, grain)
    return run


def wau_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4/SRC5: the app table read by path, the web table by name."""
    path = f"{shared_dir(spark)}/app_events"
    fx.app_events(spark, sf_dir).write.parquet(path)
    fx.ga_events(spark, sf_dir).createOrReplaceTempView("memberpulse_web_events")
    return eng.active_users(rd.read_table(spark, path), rd.read_table(spark, "memberpulse_web_events"),
                            "week", fx.active_use(), fx.TZ)


def _first_visit(grain: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return eng.first_visits(fx.ga_events(spark, sf_dir), grain, fx.TZ)
    return run


def _service(grain: str) -> Query:
    period = mem.WEEK if grain == "week" else mem.MONTH

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        periods = membership_periods(spark, sf_dir)
        report = mem.member_report(periods, period, fx.TZ)
        engagement = eng.active_users(fx.app_events(spark, sf_dir), fx.ga_events(spark, sf_dir),
                                      grain, fx.active_use(), fx.TZ)
        return eng.with_engagement(report, engagement, period)
    return run


def weekly_member_report_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly report without the row of memberships that have no period."""
    return mem.member_report(membership_periods(spark, sf_dir), mem.WEEK, fx.TZ, null_period="drop")


def revenue_subcent_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of amounts with fractions of a cent."""
    periods = membership_periods(spark, sf_dir)
    return mem.revenue(periods.withColumns({c: F.col(c) / 1000 for c in ("amount", "refund")}), mem.WEEK)


def lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN1: order times written in thirteen forms (one of them no date), read back leniently."""
    k = F.col("o_orderkey")
    at = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"))
    forms = [F.date_format(at, f) for f in (
        "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss' Asia/Seoul'", "yyyy-MM-dd HH:mm:ss'+02:00'",
        "yyyy/MM/dd HH:mm", "dd-MMM-yyyy", "yyyyMMdd", "MMMM d, yyyy h:mm a", "MM/dd/yyyy HH:mm:ss", "yyyyMMdd'T'HHmmss",
        "EEEE, d MMMM yyyy HH:mm", "M/d/yyyy h:mm:ss a")]
    text = F.element_at(F.array(*forms, F.lit("not a date")), (k % 13 + 1).cast("int"))
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", rd.lenient_timestamp(text).alias("parsed"))


def dates_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN9: the memberships' periods and local times as text."""
    return tm.dates_to_text(membership_periods(spark, sf_dir), fx.TZ).drop("amount", "refund")


def member_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aud.member_stats(fx.members(spark, sf_dir), fx.AS_OF, fx.TZ)


def subscriber_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aud.subscriber_stats(fx.members(spark, sf_dir), fx.AS_OF, fx.TZ)


def _weekly_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nl.weekly_newsletters(fx.newsletters(spark, sf_dir), fx.AS_OF, fx.TZ)


def weekly_newsletters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly_posts(spark, sf_dir).select(
        "title", "status", "published_at", "email_segment",
        F.col("email.email_count").alias("email_count"),
        F.col("email.opened_count").alias("opened_count"),
        F.col("email.delivered_count").alias("delivered_count"),
        F.col("count.clicks").alias("clicks"))


def newsletter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nl.newsletter_stats(_weekly_posts(spark, sf_dir), fx.TZ)


def inactive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up.inactive_members(fx.members(spark, sf_dir)).select(
        "id", "email", "subscribed", F.col("email_suppression.suppressed").alias("suppressed"),
        "email_count", "email_open_rate")


def _deleted_ids(members: DataFrame) -> DataFrame:
    """Outcome table: candidates whose deletion was confirmed (even member numbers)."""
    return up.inactive_members(members).where(fx.member_number() % 2 == 0).select("id")


def member_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = fx.members(spark, sf_dir)
    return up.capacity(members, _deleted_ids(members), 2 * F.col("total"))


def _invites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up.invite_batch(fx.registry(spark, sf_dir), fx.INVITE_BATCH, fx.SEED)


def _flat_invites(invites: DataFrame) -> DataFrame:
    return invites.select("email", F.col("labels")[0]["name"].alias("label_name"),
                          F.col("labels")[0]["slug"].alias("label_slug"), "note")


def invite_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_invites(_invites(spark, sf_dir))


def invite_batch_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP12 with a third of the pending rows."""
    registry = fx.registry(spark, sf_dir)
    n = registry.where(F.col("status") == up.PENDING).count() // 3
    return _flat_invites(up.invite_batch(registry, n, fx.SEED))


def registry_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.registry_diff(fx.members(spark, sf_dir), fx.registry(spark, sf_dir))[0]


def registry_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.registry_diff(fx.members(spark, sf_dir), fx.registry(spark, sf_dir))[1]


def _wide_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry with a column that the operators don't know."""
    return fx.registry(spark, sf_dir).withColumn("invite_code", F.md5(F.col("email")))


def _failed_invites(registry: DataFrame) -> DataFrame:
    """Outcome table over the whole registry: every email whose hash starts with 0."""
    return registry.where(F.md5(F.col("email")).startswith("0")).select("email")


def registry_mark_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = _wide_registry(spark, sf_dir)
    return reg.set_status(registry, _failed_invites(registry), reg.FAILED, fx.NOW)


def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = _wide_registry(spark, sf_dir)
    new, _ = reg.registry_diff(fx.members(spark, sf_dir), registry)
    return reg.upsert(registry, new, fx.NOW)


def registry_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.sync(_wide_registry(spark, sf_dir), fx.members(spark, sf_dir), fx.NOW)


def _member_pages(members: DataFrame) -> DataFrame:
    """Members packed in pages of at most MEMBER_PAGE_SIZE (ids are unique per customer)."""
    return members.withColumn("page", F.floor(fx.member_number() / fx.MEMBER_PAGE_SIZE))


def json_param_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = _member_pages(fx.members(spark, sf_dir))
    records = members.select("page", "email", F.get(F.col("labels"), 0)["name"].alias("label"), "note")
    return rd.unnest_json_records(rd.to_json_pages(records, "page"))


def _flat_members(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "id", "email", *more,
        F.array_join(F.transform("labels", lambda x: x["name"]), ",").alias("label_names"),
        "note", "subscribed", F.col("email_suppression.suppressed").alias("suppressed"),
        "email_count", "email_open_rate", "created_at", "last_seen_at")


def _staged(df: DataFrame) -> DataFrame:
    """``df`` as a table of the shared folder: a lost executor rereads it."""
    path = f"{shared_dir(df.sparkSession)}/staged"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def report_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1: overwrite the weekly report twice (idempotent), read it back."""
    path = f"{shared_dir(spark)}/weekly_report"
    report = _staged(_report(mem.WEEK)(spark, sf_dir))       # computed once for both writes
    sk.overwrite_report(report, path)
    sk.overwrite_report(report, path)
    return spark.read.parquet(path)


MEMBER_STATS_SCHEMA = "date date, total bigint, active bigint, subscriber bigint, " \
    "engagement_rate double, subscription_rate double, lang_code string"


def kpi_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: two run dates into date partitions; re-running one leaves the other intact."""
    path = f"{shared_dir(spark)}/member_statistics"
    members = fx.members(spark, sf_dir)
    target = spark.createDataFrame([], MEMBER_STATS_SCHEMA).schema
    for as_of in (fx.AS_OF, fx.PREV_AS_OF, fx.AS_OF):
        sk.overwrite_partitions(aud.member_stats(members, as_of, fx.TZ), path, "date", target)
    return spark.read.schema(target).parquet(path)


def report_publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1: publish the weekly report three times as versions, the first time without its last rows, and read it."""
    target = f"{shared_dir(spark)}/weekly_report"
    report = _staged(_report(mem.WEEK)(spark, sf_dir))       # computed once for the writes
    for rows in (report.limit(10), report, report):
        sk.publish_report(rows, target)
    return sk.read_report(spark, target)


def _scratch_database(spark: SparkSession) -> str:
    """A database of this call's own, its tables in the shared folder."""
    path = shared_dir(spark)
    name = "memberpulse_" + path.rsplit("/", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def kpi_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: two run dates into the partitions of a catalog table by name; re-running one leaves the other intact."""
    name = f"{_scratch_database(spark)}.member_statistics"
    columns = ", ".join(c.strip() for c in MEMBER_STATS_SCHEMA.split(","))
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (date)")
    members = fx.members(spark, sf_dir)
    for as_of in (fx.AS_OF, fx.PREV_AS_OF, fx.AS_OF):
        sk.overwrite_partitions(aud.member_stats(members, as_of, fx.TZ), name, "date")
    return spark.table(name)


def registry_table_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4, SNK5 in place: the registry as a bucketed table, synced twice with the dump (the second time nothing changes)."""
    name = f"{_scratch_database(spark)}.registry"
    rt.create_registry_table(_wide_registry(spark, sf_dir), name, parts=16, buckets=8)
    members = fx.members(spark, sf_dir)
    rt.sync(spark, name, members, fx.NOW)
    rt.sync(spark, name, members, "2030-01-01 00:00:00")
    return rt.registry_rows(spark, name)


def registry_table_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4, SNK5 in place: new members upserted into the bucketed registry table, a part of its partitions rewritten."""
    name = f"{_scratch_database(spark)}.registry"
    registry = _wide_registry(spark, sf_dir)
    rt.create_registry_table(registry, name, parts=16, buckets=8)
    new, _ = reg.registry_diff(fx.members(spark, sf_dir), registry)
    rt.upsert(spark, name, new, fx.NOW)
    return rt.registry_rows(spark, name)


def raw_archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3: archive the landed member dump, undeclared fields and CRLF pages included; digests are checked, rows read back."""
    root = shared_dir(spark)
    members = fx.members(spark, sf_dir).withColumn("uuid", F.md5("id"))
    members.where(fx.member_number() % 2 == 0).write.json(f"{root}/landed/lf")
    members.where(fx.member_number() % 2 == 1).write.option("lineSep", "\r\n").json(f"{root}/landed/crlf")
    path = sk.archive_raw(spark, f"{root}/landed", root, fx.AS_OF, "members.json")
    if sk.check_archive(spark, path).where(~F.col("intact") & F.col("file").endswith(".json")).count():
        raise OSError(f"{path} differs from its manifest")
    raw = spark.read.option("recursiveFileLookup", True).schema(schemas.as_text_timestamps(schemas.MEMBERS).add("uuid", "string")).json(path)
    return _flat_members(raw.withColumns({c: rd.lenient_timestamp(F.col(c))
                                          for c in ("created_at", "last_seen_at")}), "uuid")


def _land_memberships(rows: DataFrame, root: str) -> None:
    """The day's CSV, columns in another order: header names decide, not places."""
    (rows.select(*reversed(rows.columns)).write.mode("overwrite").option("header", True).option("escape", '"')
     .csv(rd.membership_csv_path(root, fx.AS_OF)))


def membership_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1: land the memberships as the day's CSV, read it back with lenient dates and text identities.

    Every seventh row has a comment of two lines with quotes and a comma, in a column that is not read.
    """
    root = shared_dir(spark)
    comment = F.when(F.col("row_id") % 7 == 0, F.lit('said "yes",\nthen left\r\n')).otherwise(F.lit("none"))
    rows = fx.memberships(spark, sf_dir).withColumn("identity", F.concat(F.lit("u"), "identity"))
    _land_memberships(rows.withColumn("comment", comment), root)
    return rd.read_memberships_csv(spark, root, fx.AS_OF)


def _land_pages(pages: DataFrame, field: str, path: str) -> None:
    """``(page, field)`` rows from page 0 on, as numbered documents and an empty last page."""
    last = pages.agg((F.max("page") + 2).alias("page"), F.max(F.slice(field, 1, 0)).alias(field))
    pages.select((F.col("page") + 1).alias("page"), field).unionByName(last).write.json(path)


def _land_member_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The member dump as numbered pages plus an empty last page."""
    members = _member_pages(fx.members(spark, sf_dir))
    fields = [c for c in members.columns if c != "page"]
    _land_pages(members.groupBy("page").agg(F.collect_list(F.struct(*fields)).alias("members")), "members", path)


def member_pages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2: land the member dump as numbered pages, read it back whole."""
    path = f"{shared_dir(spark)}/member_pages"
    _land_member_pages(spark, sf_dir, path)
    return _flat_members(rd.read_member_pages(spark, path))


def _land_post_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    posts = fx.newsletters(spark, sf_dir).withColumn("page", F.floor(F.col("title").substr(6, 20).cast("bigint") / 100))
    fields = [c for c in posts.columns if c != "page"]
    _land_pages(posts.groupBy("page").agg(F.collect_list(F.struct(*fields)).alias("posts")), "posts", path)


def post_pages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3: land the post dump as numbered pages, read it back whole, select the week's newsletters."""
    path = f"{shared_dir(spark)}/post_pages"
    _land_post_pages(spark, sf_dir, path)
    weekly = nl.weekly_newsletters(rd.read_post_pages(spark, path), fx.AS_OF, fx.TZ)
    return weekly.select(
        "title", "status", "published_at", "email_segment",
        F.col("email.email_count").alias("email_count"), F.col("email.opened_count").alias("opened_count"),
        F.col("email.delivered_count").alias("delivered_count"), F.col("count.clicks").alias("clicks"))


def registry_active_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6: write the registry as a table, scan it filtered by status and projected."""
    path = f"{shared_dir(spark)}/registry"
    fx.registry(spark, sf_dir).write.parquet(path)
    return rd.read_registry(spark, path, "active", ("email", "label", "updated_at"))


def service_report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 from a landed CSV and event tables (by path and by name): the rows of both reports."""
    root = shared_dir(spark)
    _land_memberships(fx.memberships(spark, sf_dir), root)
    fx.app_events(spark, sf_dir).write.parquet(f"{root}/app_events")
    fx.ga_events(spark, sf_dir).createOrReplaceTempView("memberpulse_web_log")
    out = jobs.run_service_report(spark, root, f"{root}/app_events", "memberpulse_web_log", f"{root}/out",
                                  fx.AS_OF, fx.active_use(), fx.TZ)
    week, month = (spark.read.parquet(out[name]).withColumnsRenamed(renamed).withColumn("grain", F.lit(grain))
                   for grain, name, renamed in (
                       ("week", "weekly_metrics", {mem.WEEK: "period", "WAU": "users"}),
                       ("month", "monthly_metrics", {mem.MONTH: "period", "MAU": "users"})))
    return week.unionByName(month)


def newsletter_kpis_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 from landed pages: the rows of the three KPI tables."""
    root = shared_dir(spark)
    _land_member_pages(spark, sf_dir, f"{root}/members")
    _land_post_pages(spark, sf_dir, f"{root}/posts")
    tables = ("member_kpis", "subscriber_kpis", "newsletter_kpis")
    out = jobs.run_newsletter_kpis(spark, f"{root}/members", f"{root}/posts", f"{root}/kpi", f"{root}/raw",
                                   fx.AS_OF, fx.TZ, tables)
    member, subscriber, newsletter = (spark.read.parquet(out[t]).withColumn("kpi", F.lit(t)) for t in tables)
    return member.unionByName(subscriber, True).unionByName(newsletter, True)


def member_upkeep_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 with all its outcome tables: candidates, invites and the synced registry."""
    root = shared_dir(spark)
    _land_member_pages(spark, sf_dir, f"{root}/members")
    registry = fx.registry(spark, sf_dir)
    registry.write.parquet(f"{root}/registry")
    _deleted_ids(fx.members(spark, sf_dir)).write.parquet(f"{root}/deleted")
    _failed_invites(registry).write.parquet(f"{root}/failed")
    out = jobs.run_member_upkeep(spark, f"{root}/members", f"{root}/registry", f"{root}/out", fx.NOW,
                                 2 * F.col("total"), fx.SEED, f"{root}/deleted", f"{root}/failed", f"{root}/members")
    parts = (("candidate", spark.read.parquet(out["deletion_candidates"]).select("email")),
             ("invite", _flat_invites(spark.read.parquet(out["invites"])).select("email", F.col("label_name").alias("label"), "note")),
             ("registry", spark.read.parquet(out["registry_synced"])))
    candidates, invites, synced = (df.withColumn("part", F.lit(part)) for part, df in parts)
    return synced.unionByName(candidates, True).unionByName(invites, True)


QUERIES: dict[str, Query] = {
    "membership_periods": membership_periods,
    "weekly_member_report": _report(mem.WEEK),
    "monthly_member_report": _report(mem.MONTH),
    "signup_first_seen": _single(mem.first_seen_signups),
    "paid_signup_by_week": _single(mem.paid_signups, tz=fx.TZ),
    "churn_and_active_by_week": _single(mem.churn_and_active),
    "revenue_by_week": _single(mem.revenue),
    "revenue_by_month": _single(mem.revenue, mem.MONTH),
    "wau": _active("week"),
    "mau": _active("month"),
    "first_visit_by_week": _first_visit("week"),
    "first_visit_by_month": _first_visit("month"),
    "weekly_service_report": _service("week"),
    "monthly_service_report": _service("month"),
    "member_stats": member_stats,
    "subscriber_stats": subscriber_stats,
    "weekly_newsletters": weekly_newsletters,
    "newsletter_stats": newsletter_stats,
    "inactive_members": inactive_members,
    "member_capacity": member_capacity,
    "invite_batch": invite_batch,
    "registry_new": registry_new,
    "registry_missing": registry_missing,
    "registry_mark_failed": registry_mark_failed,
    "registry_upsert": registry_upsert,
    "registry_sync": registry_sync,
    "json_param_unnest": json_param_unnest,
    "report_overwrite_roundtrip": report_overwrite_roundtrip,
    "kpi_partition_roundtrip": kpi_partition_roundtrip,
    "raw_archive_roundtrip": raw_archive_roundtrip,
    "report_publish_roundtrip": report_publish_roundtrip,
    "kpi_table_roundtrip": kpi_table_roundtrip,
    "registry_table_sync": registry_table_sync,
    "registry_table_changes": registry_table_changes,
    "dates_as_text": dates_as_text,
    "membership_csv_roundtrip": membership_csv_roundtrip,
    "member_pages_roundtrip": member_pages_roundtrip,
    "post_pages_roundtrip": post_pages_roundtrip,
    "registry_active_scan": registry_active_scan,
    "weekly_member_report_drop": weekly_member_report_drop,
    "revenue_subcent_by_week": revenue_subcent_by_week,
    "lenient_dates": lenient_dates,
    "wau_from_days": _active_from_days("week"),
    "mau_from_days": _active_from_days("month"),
    "wau_from_tables": wau_from_tables,
    "invite_batch_large": invite_batch_large,
    "service_report_job": service_report_job,
    "newsletter_kpis_job": newsletter_kpis_job,
    "member_upkeep_job": member_upkeep_job,
}

_MP = "membership_periods"
ORACLE: dict[str, str] = {
    "membership_periods": sql.compose("SELECT * FROM membership_periods", _MP),
    "weekly_member_report": sql.member_report_sql("week_start_date"),
    "monthly_member_report": sql.member_report_sql("year_month_date"),
    "signup_first_seen": sql.compose(
        "SELECT period AS week_start_date, count(*) AS signup_count FROM rep_first GROUP BY 1", _MP,
        extra={"rep_first": sql.report_ctes("week_start_date")["rep_first"]}),
    "paid_signup_by_week": sql.compose(
        f"""SELECT week_start_date, count(DISTINCT "identity") AS paid_signup FROM {_MP}
            WHERE payment_status = 'first paid' AND week_start_date IS NOT NULL
              AND {sql.seoul_date('signup_date')} = {sql.seoul_date('payment_date')} GROUP BY 1""", _MP),
    "churn_and_active_by_week": sql.compose(
        f"""SELECT week_start_date,
              count(DISTINCT CASE WHEN churn_date IS NOT NULL THEN "identity" END) AS churn_count,
              count(DISTINCT CASE WHEN payment_status IN ('paid', 'first paid') AND churn_date IS NULL
                    THEN "identity" END) AS active_paid_users
            FROM {_MP} WHERE week_start_date IS NOT NULL GROUP BY 1""", _MP),
    "revenue_by_week": sql.compose(
        f"""SELECT week_start_date, CAST(coalesce(sum(CAST(amount AS DECIMAL(18, 2))), 0) AS DOUBLE) AS payment,
              CAST(coalesce(sum(CAST(refund AS DECIMAL(18, 2))), 0) AS DOUBLE) AS refund,
              CAST(coalesce(sum(CAST(amount AS DECIMAL(18, 2))), 0)
                   - coalesce(sum(CAST(refund AS DECIMAL(18, 2))), 0) AS DOUBLE) AS weekly_revenue
            FROM {_MP} WHERE week_start_date IS NOT NULL GROUP BY 1""", _MP),
    "revenue_by_month": sql.compose(
        f"""SELECT year_month_date, CAST(coalesce(sum(CAST(amount AS DECIMAL(18, 2))), 0) AS DOUBLE) AS payment,
              CAST(coalesce(sum(CAST(refund AS DECIMAL(18, 2))), 0) AS DOUBLE) AS refund,
              CAST(coalesce(sum(CAST(amount AS DECIMAL(18, 2))), 0)
                   - coalesce(sum(CAST(refund AS DECIMAL(18, 2))), 0) AS DOUBLE) AS weekly_revenue
            FROM {_MP} WHERE year_month_date IS NOT NULL GROUP BY 1""", _MP),
    "wau": sql.active_users_sql("week"),
    "mau": sql.active_users_sql("month"),
    "first_visit_by_week": sql.first_visit_sql("week"),
    "first_visit_by_month": sql.first_visit_sql("month"),
    "weekly_service_report": sql.service_report_sql("week"),
    "monthly_service_report": sql.service_report_sql("month"),
    "member_stats": sql.compose(sql.member_stats_body(sql.AS_OF), "members"),
    "subscriber_stats": sql.compose(sql.subscriber_stats_body(sql.AS_OF), "members"),
    "weekly_newsletters": sql.compose(sql.weekly_newsletters_body(sql.AS_OF), "newsletters"),
    "newsletter_stats": sql.compose(sql.newsletter_stats_body(), "newsletters",
                                    extra={"wk": sql.weekly_newsletters_body(sql.AS_OF)}),
    "inactive_members": sql.compose(
        f"SELECT id, email, subscribed, suppressed, email_count, email_open_rate FROM members "
        f"WHERE {sql.INACTIVE}", "members"),
    "member_capacity": sql.upkeep_sql(
        """SELECT total, deleted, 2 * total AS member_limit,
             greatest(0, 2 * total - total + deleted) AS capacity
           FROM (SELECT count(*) AS total FROM members) t,
                (SELECT count(DISTINCT id) AS deleted FROM deleted_ids) d""", "deleted_ids"),
    "invite_batch": sql.upkeep_sql("SELECT * FROM invites", "invites"),
    "registry_new": sql.upkeep_sql("SELECT * FROM new_members", "new_members"),
    "registry_missing": sql.upkeep_sql("SELECT * FROM missing", "missing"),
    "registry_mark_failed": sql.upkeep_sql(
        "SELECT *, md5(email) AS invite_code FROM marked", "marked"),
    "registry_upsert": sql.upkeep_sql("SELECT * FROM upserted", "upserted"),
    "registry_sync": sql.upkeep_sql(
        f"""SELECT email, label, note, created_at, invite_code,
              CASE WHEN email IN (SELECT email FROM missing) THEN {sql.NOW_SQL} ELSE updated_at END AS updated_at,
              CASE WHEN email IN (SELECT email FROM missing) THEN 'deleted' ELSE status END AS status
            FROM upserted""", "upserted", "missing"),
    "json_param_unnest": sql.compose("SELECT email, first_label AS label, note FROM members", "members"),
    "report_overwrite_roundtrip": sql.member_report_sql("week_start_date"),
    "kpi_partition_roundtrip": sql.compose(
        sql.member_stats_body(sql.AS_OF) + " UNION ALL " + sql.member_stats_body(sql.PREV_AS_OF), "members"),
    "raw_archive_roundtrip": sql.compose(f"SELECT *, md5(id) AS uuid FROM ({sql.MEMBER_FLAT}) f", "members"),
    "membership_csv_roundtrip": sql.compose(
        """SELECT * REPLACE ('u' || "identity" AS "identity") FROM memberships""", "memberships"),
    "member_pages_roundtrip": sql.compose(sql.MEMBER_FLAT, "members"),
    "post_pages_roundtrip": sql.compose(sql.weekly_newsletters_body(sql.AS_OF), "newsletters"),
    "registry_active_scan": sql.compose(
        "SELECT email, label, updated_at FROM registry WHERE status = 'active'", "registry"),
    "weekly_member_report_drop": sql.compose("SELECT * FROM rep WHERE week_start_date > DATE '1970-01-01'", _MP,
                                             extra=sql.report_ctes("week_start_date")),
    "revenue_subcent_by_week": sql.compose(
        f"""SELECT week_start_date, CAST(paid AS DOUBLE) AS payment, CAST(back AS DOUBLE) AS refund,
              CAST(paid - back AS DOUBLE) AS weekly_revenue
            FROM (SELECT week_start_date, coalesce(sum(CAST(amount / 1000 AS DECIMAL(28, 8))), 0) AS paid,
                    coalesce(sum(CAST(refund / 1000 AS DECIMAL(28, 8))), 0) AS back
                  FROM {_MP} WHERE week_start_date IS NOT NULL GROUP BY 1) s""", _MP),
    "lenient_dates": """SELECT o_orderkey, CASE o_orderkey % 13
              WHEN 2 THEN wall - INTERVAL 9 HOUR WHEN 3 THEN wall - INTERVAL 2 HOUR
              WHEN 5 THEN date_trunc('day', wall) WHEN 6 THEN date_trunc('day', wall) WHEN 12 THEN NULL ELSE wall END AS parsed
            FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 24) AS wall FROM orders) o""",
    "dates_as_text": sql.compose(
        f"""SELECT row_id, "identity", payment_status, strftime(week_start_date, '%Y-%m-%d') AS week_start_date,
              strftime(year_month_date, '%Y-%m-%d') AS year_month_date,
              {", ".join(f"strftime({c} + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') || '+09:00' AS {c}"
                         for c in ("signup_date", "payment_date", "churn_date"))}
            FROM {_MP}""", _MP),
    "report_publish_roundtrip": sql.member_report_sql("week_start_date"),
    "kpi_table_roundtrip": sql.compose(
        sql.member_stats_body(sql.AS_OF) + " UNION ALL " + sql.member_stats_body(sql.PREV_AS_OF), "members"),
    "wau_from_days": sql.active_users_sql("week"),
    "mau_from_days": sql.active_users_sql("month"),
    "wau_from_tables": sql.active_users_sql("week"),
    "invite_batch_large": sql.upkeep_sql(
        f"""SELECT email, label AS label_name, lower(label) AS label_slug, coalesce(note, '') AS note
            FROM registry WHERE status = 'pending' ORDER BY md5(email || '{sql.SEED}'), email
            LIMIT (SELECT count(*) // 3 FROM registry WHERE status = 'pending')"""),
    "service_report_job": f"""SELECT 'week' AS grain, week_start_date AS period, WAU AS users, * EXCLUDE (week_start_date, WAU)
            FROM ({sql.service_report_sql("week")}) w
          UNION ALL BY NAME
          SELECT 'month' AS grain, year_month_date AS period, MAU AS users, * EXCLUDE (year_month_date, MAU)
            FROM ({sql.service_report_sql("month")}) m""",
    "newsletter_kpis_job": sql.compose(
        f"""SELECT 'member_kpis' AS kpi, * FROM ({sql.member_stats_body(sql.AS_OF)}) a
          UNION ALL BY NAME SELECT 'subscriber_kpis' AS kpi, * FROM ({sql.subscriber_stats_body(sql.AS_OF)}) b
          UNION ALL BY NAME SELECT 'newsletter_kpis' AS kpi, * FROM ({sql.newsletter_stats_body()}) c""",
        "members", "newsletters", extra={"wk": sql.weekly_newsletters_body(sql.AS_OF)}),
    "member_upkeep_job": sql.upkeep_sql(
        f"""SELECT 'registry' AS part, coalesce(f.email, m.email) AS email,
              CASE WHEN f.email IS NULL THEN m.first_label ELSE f.label END AS label,
              CASE WHEN f.email IS NULL THEN m.note ELSE f.note END AS note,
              CASE WHEN f.email IS NULL THEN {sql.NOW_SQL} ELSE f.created_at END AS created_at,
              CASE WHEN f.email IS NULL OR (f.status = 'active') = (m.email IS NULL) THEN {sql.NOW_SQL}
                   ELSE f.updated_at END AS updated_at,
              CASE WHEN m.email IS NOT NULL THEN 'active' WHEN f.status = 'active' THEN 'deleted'
                   ELSE f.status END AS status
            FROM marked f FULL OUTER JOIN members m ON f.email = m.email
          UNION ALL BY NAME SELECT 'candidate' AS part, email FROM cand
          UNION ALL BY NAME SELECT * FROM (
            SELECT 'invite' AS part, email, label, coalesce(note, '') AS note FROM registry WHERE status = 'pending'
            ORDER BY md5(email || '{sql.SEED}'), email
            LIMIT (SELECT (SELECT count(*) FROM members) + (SELECT count(*) FROM deleted_ids))) i""",
        "marked", "cand", "deleted_ids"),
}
ORACLE |= {"registry_table_sync": ORACLE["registry_sync"], "registry_table_changes": ORACLE["registry_upsert"]}
