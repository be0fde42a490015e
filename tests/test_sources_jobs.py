"""SRC1–SRC8, SNK1–SNK3, OP17 jobs, the driver contract and the oracle at sf0.001."""

from __future__ import annotations

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL, d, plan_text, rows, ts
from memberpulse.plans import catalog, jobs
from memberpulse.operators import engagement, membership
from memberpulse.plans.catalog import QUERIES
from memberpulse.sources import fixtures as fx
from memberpulse.sources import readers as rd
from memberpulse.sources import sinks as sk
from oracle_compare import compare, duck


def test_membership_csv_missing_file_fails(spark, scratch):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        rd.read_memberships_csv(spark, scratch, "2024-01-22").collect()


def test_membership_csv_lenient_dates(spark, scratch):
    path = rd.membership_csv_path(scratch, "2024-01-22")
    with open(path, "w") as f:
        f.write("row_id,identity,payment_status,signup_date,payment_date,churn_date,amount,refund\n"
                "1,7,paid,2024-01-01 10:00:00,2024-01-02T00:00:00Z,not-a-date,10.5,\n"
                "2,8,signup,,,,,\n")
    got = rows(rd.read_memberships_csv(spark, scratch, "2024-01-22"), "row_id")
    assert got[0]["payment_date"] == ts("2024-01-02 00:00:00") and got[0]["churn_date"] is None
    assert got[0]["amount"] == 10.5 and got[1]["signup_date"] is None


def test_membership_csv_by_header_with_text_identities(spark, scratch):
    """Another column order, text identities, an extra column and no row_id: nothing shifts or gets lost."""
    with open(rd.membership_csv_path(scratch, "2024-01-22"), "w") as f:
        f.write("amount,payment_status,extra,identity,signup_date,payment_date,churn_date,refund\n"
                "10.5,paid,x,u-1,2024-01-01,2024/01/02 10:00,,\nNaN,paid,x,u-2,2024-01-01,20240103,,\n0.004,first paid,x,u-3,,10-Mar-2024,,\n")
    got = rows(rd.read_memberships_csv(spark, scratch, "2024-01-22"), "row_id")
    assert [r["identity"] for r in got] == ["u-1", "u-2", "u-3"]                      # file order
    assert [r["payment_status"] for r in got] == ["paid", "paid", "first paid"]
    assert [r["payment_date"] for r in got] == [ts("2024-01-02 10:00:00"), ts("2024-01-03 00:00:00"), ts("2024-03-10 00:00:00")]
    periods = membership.with_periods(rd.read_memberships_csv(spark, scratch, "2024-01-22"), "UTC")
    report = rows(membership.revenue(periods, membership.MONTH), membership.MONTH)
    assert [r["payment"] for r in report] == [10.5, 0.004]                            # NaN is NULL, cents are not rounded


def test_membership_csv_without_a_column_or_an_order_fails(spark, scratch):
    path = rd.membership_csv_path(scratch, "2024-01-22")
    os.makedirs(path)
    header = "identity,payment_status,signup_date,payment_date,churn_date,amount,refund\n"
    for name in ("a.csv", "b.csv"):
        with open(f"{path}/{name}", "w") as f:
            f.write(header + "u,paid,,,,1,\n")
    with pytest.raises(ValueError, match="row_id"):
        rd.read_memberships_csv(spark, scratch, "2024-01-22")
    with open(rd.membership_csv_path(scratch, "2024-01-23"), "w") as f:
        f.write("identity,payment_status\nu,paid\n")
    with pytest.raises(ValueError, match="lacks columns"):
        rd.read_memberships_csv(spark, scratch, "2024-01-23")


@pytest.mark.parametrize("page", ['{"page": 2, "members": [{"id": "m1", "email": "a@x"', '{"page": 2, "errors": [{"message": "no"}]}',
                                  '{"page": 2, "members": [{"id": "m1", "email": "a@x", "created_at": "yesterday"}]}'])
def test_bad_pages_fail(spark, scratch, page):
    """A truncated page, an error answer and a bad timestamp fail, beside good pages too."""
    with open(f"{scratch}/1.json", "w") as f:
        f.write('{"page": 1, "members": [{"id": "m2", "email": "b@x"}]}\n{"page": 3, "members": []}\n')
    with open(f"{scratch}/2.json", "w") as f:
        f.write(page + "\n")
    with pytest.raises(Exception):
        rd.read_member_pages(spark, scratch).collect()


def test_pretty_printed_page_and_raw_archive(spark, scratch):
    text = json.dumps({"members": [{"id": "m1", "email": "a@x", "uuid": "u", "tiers": [1]}]}, indent=1)
    with open(f"{scratch}/1.json", "w") as f:
        f.write(text)
    assert [r["id"] for r in rows(rd.read_member_pages(spark, f"{scratch}/1.json", multi_line=True, page=None))] == ["m1"]
    path = sk.archive_raw(spark, f"{scratch}/1.json", f"{scratch}/raw", "2024-01-22", "members.json")
    assert "\n".join(r["value"] for r in spark.read.text(path).collect()) == text     # undeclared fields included


def test_schema_drift_fails(spark):
    target = spark.createDataFrame([], "a int, b string").schema
    for ddl in ("a int", "a int, b string, c int"):
        with pytest.raises(ValueError, match="target schema"):
            sk.conform(spark.createDataFrame([], ddl), target)


def test_member_pages_with_empty_last_page(spark, scratch):
    page = {"page": 1, "members": [{"id": "m1", "email": "a@x", "labels": [{"name": "English", "slug": "english"}],
                         "subscribed": True, "email_suppression": {"suppressed": False},
                         "email_count": 3, "created_at": "2024-01-01T00:00:00.000Z"},
                        {"id": "m2", "email": "b@x", "labels": [], "note": "n"}]}
    with open(f"{scratch}/page1.json", "w") as f:
        f.write(json.dumps(page) + "\n")
    with open(f"{scratch}/page2.json", "w") as f:
        f.write(json.dumps({"page": 2, "members": []}) + "\n")
    got = rows(rd.read_member_pages(spark, scratch), "id")
    assert [r["id"] for r in got] == ["m1", "m2"]
    assert got[0]["created_at"] == ts("2024-01-01 00:00:00") and got[1]["subscribed"] is None


def test_json_records_unnest_missing_fields_are_null(spark):
    df = spark.createDataFrame([('[{"email": "a@x", "label": "English"}, {"email": "b@x", "note": null}]',),
                                ("not json",)], "members string")
    got = rows(rd.unnest_json_records(df), "email")
    assert got == [{"email": "a@x", "label": "English", "note": None},
                   {"email": "b@x", "label": None, "note": None}]


def test_partition_overwrite_keeps_other_dates(spark, scratch):
    schema = spark.createDataFrame([], jobs.SUBSCRIBER_STATS).schema
    mk = lambda day, total: spark.createDataFrame(
        [(d(day), total, 1, 0, 1, "en")], "date date, total bigint, new bigint, churn bigint, net bigint, lang_code string")
    sk.overwrite_partitions(mk("2024-01-15", 1), scratch, schema=schema)
    sk.overwrite_partitions(mk("2024-01-22", 2), scratch, schema=schema)
    sk.overwrite_partitions(mk("2024-01-22", 3), scratch, schema=schema)
    got = sorted((r["date"], r["total"]) for r in spark.read.parquet(scratch).collect())
    assert got == [(d("2024-01-15"), 1), (d("2024-01-22"), 3)]


def test_archive_path_and_report_overwrite(spark, scratch):
    assert sk.archive_path("/a/", "2024-01-22", "members.json") == "/a/20240122/members.json"
    df = spark.range(3)
    sk.overwrite_report(df, f"{scratch}/r")
    sk.overwrite_report(df, f"{scratch}/r")
    assert spark.read.parquet(f"{scratch}/r").count() == 3


def test_report_overwrite_by_name_and_failed_run(spark, scratch):
    """A catalog name as target; a run that fails leaves the report as it was."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS memberpulse_reports LOCATION '{scratch}/db'")
    for target, read in (("memberpulse_reports.weekly", spark.table), (f"{scratch}/weekly", spark.read.parquet)):
        sk.overwrite_report(spark.range(3), target)
        sk.overwrite_report(spark.range(5), target)
        with pytest.raises(Exception, match="no rows today"):
            sk.overwrite_report(spark.range(7).select(F.raise_error(F.lit("no rows today")).cast("bigint").alias("id")), target)
        assert read(target).count() == 5
    spark.sql("DROP DATABASE memberpulse_reports CASCADE")


def test_memberships_of_a_customer_with_a_third_of_the_orders(spark, scratch):
    """Ties and a hot customer: same rows as the SQL form, first orders by hash aggregation."""
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey)
                          FROM read_parquet('{SF_SMALL}/orders.parquet')) TO '{scratch}/orders.parquet' (FORMAT parquet)""")
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{scratch}/orders.parquet')")
    got = QUERIES["membership_periods"](spark, scratch)
    assert "SortAggregate" not in plan_text(got)
    res = compare(spark, con, "membership_periods", got, entry.oracle_sql()["membership_periods"])
    assert res["match"], res


def test_registry_scan_pushes_status_and_projection(spark, scratch):
    fx.registry(spark, SF_SMALL).write.parquet(f"{scratch}/registry")
    plan = plan_text(rd.read_registry(spark, f"{scratch}/registry", "pending", ("email", "label", "note")))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,pending)]" in plan
    assert "ReadSchema: struct<email:string,label:string,note:string,status:string>" in plan


def _land_member_pages(spark, sf_dir, path):
    catalog._land_member_pages(spark, sf_dir, path)


def test_service_report_job(spark, scratch):
    land = f"{scratch}/land"
    fx.memberships(spark, SF_SMALL).write.option("header", True).csv(rd.membership_csv_path(land, "2024-01-22"))
    fx.app_events(spark, SF_SMALL).write.parquet(f"{scratch}/app")
    fx.ga_events(spark, SF_SMALL).write.parquet(f"{scratch}/ga")
    out = jobs.run_service_report(spark, land, f"{scratch}/app", f"{scratch}/ga", f"{scratch}/out", "2024-01-22",
                                  active=fx.active_use())
    weekly = spark.read.parquet(out["weekly_metrics"])
    expected = entry.queries()["weekly_service_report"](spark, SF_SMALL)
    assert sorted(map(tuple, weekly.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert spark.read.parquet(out["monthly_metrics"]).count() > 0


def test_newsletter_kpi_job(spark, scratch):
    _land_member_pages(spark, SF_SMALL, f"{scratch}/members")
    posts = fx.newsletters(spark, SF_SMALL)
    posts.select(F.lit(1).alias("page"), F.array(F.struct(*posts.columns)).alias("posts")).groupBy("page").agg(
        F.flatten(F.collect_list("posts")).alias("posts")).write.json(f"{scratch}/posts")
    spark.sql("SELECT 2 AS page, array() AS posts").write.mode("append").json(f"{scratch}/posts")
    out = jobs.run_newsletter_kpis(spark, f"{scratch}/members", f"{scratch}/posts", f"{scratch}/kpi",
                                   f"{scratch}/raw", "2024-01-22")
    stats = spark.read.parquet(out["member_kpis"])
    assert stats.count() == 2 and stats.schema["date"].dataType.simpleString() == "date"
    assert os.path.isdir(f"{scratch}/raw/20240122/members.json")
    assert spark.read.parquet(out["newsletter_kpis"]).count() > 0


def test_member_upkeep_job_stages(spark, scratch):
    _land_member_pages(spark, SF_SMALL, f"{scratch}/members")
    fx.registry(spark, SF_SMALL).write.parquet(f"{scratch}/registry")
    first = jobs.run_member_upkeep(spark, f"{scratch}/members", f"{scratch}/registry", f"{scratch}/out",
                                   fx.NOW, 2000, fx.SEED)
    cands = spark.read.parquet(first["deletion_candidates"])
    cands.where(F.substring("id", 2, 10).cast("bigint") % 2 == 0).select("id").write.parquet(f"{scratch}/deleted")
    second = jobs.run_member_upkeep(spark, f"{scratch}/members", f"{scratch}/registry", f"{scratch}/out2",
                                    fx.NOW, 2000, fx.SEED, deleted_ids_path=f"{scratch}/deleted")
    invites = spark.read.parquet(second["invites"])
    assert invites.count() > 0
    invites.where(F.md5("email").startswith("0")).select("email").write.parquet(f"{scratch}/failed")
    third = jobs.run_member_upkeep(spark, f"{scratch}/members", f"{scratch}/registry", f"{scratch}/out3",
                                   fx.NOW, 2000, fx.SEED, deleted_ids_path=f"{scratch}/deleted",
                                   failed_path=f"{scratch}/failed", fresh_members_path=f"{scratch}/members")
    synced = spark.read.parquet(third["registry_synced"])
    members = fx.members(spark, SF_SMALL)
    assert synced.where("status = 'active'").join(members, "email", "left_anti").count() == 0


def test_entry_and_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "visit_to_lead" in df.columns
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_oracle_at_sf0001(spark, key):
    con = _con()
    res = compare(spark, con, key, entry.queries()[key](spark, SF_SMALL), entry.oracle_sql()[key])
    assert res["match"], res


_CON = {}


def _con() -> duckdb.DuckDBPyConnection:
    if "c" not in _CON:
        _CON["c"] = duck(SF_SMALL)
    return _CON["c"]


def test_no_python_udf_or_cartesian_anywhere(spark):
    for key, q in QUERIES.items():
        if key.endswith("roundtrip"):
            continue
        plan = plan_text(q(spark, SF_SMALL))
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
            assert bad not in plan, (key, bad)


def test_member_without_email_is_rejected_on_read(spark, scratch):
    """A NULL key would never match in the anti-joins; the read fails instead."""
    with open(f"{scratch}/page.json", "w") as f:
        f.write(json.dumps({"page": 1, "members": [{"id": "m1", "email": None}]}) + '\n{"page": 2, "members": []}\n')
    with pytest.raises(Exception, match="member record without email"):
        rd.read_member_pages(spark, scratch).collect()


def test_snapshot_never_overwrites(spark, scratch):
    """The next registry snapshot goes to a new path; writing over an existing one fails."""
    df = fx.registry(spark, SF_SMALL)
    sk.write_snapshot(df, f"{scratch}/v1")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sk.write_snapshot(df, f"{scratch}/v1")


def test_command_line_member_upkeep(spark, scratch):
    from memberpulse.__main__ import main
    _land_member_pages(spark, SF_SMALL, f"{scratch}/members")
    fx.registry(spark, SF_SMALL).write.parquet(f"{scratch}/registry")
    out = main(["member-upkeep", "--member-pages", f"{scratch}/members", "--registry", f"{scratch}/registry",
                "--out", f"{scratch}/out", "--now", fx.NOW, "--member-limit", "2000", "--seed", fx.SEED,
                "--fresh-member-pages", f"{scratch}/members"])
    assert spark.read.parquet(out["deletion_candidates"]).count() > 0
    assert spark.read.parquet(out["registry_synced"]).count() > 0
