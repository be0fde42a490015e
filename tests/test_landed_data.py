"""Whole dumps, record-safe CSV, counted rejects, reports in versions, partition loads by name, exact archives, the registry table."""

from __future__ import annotations

import glob
import hashlib
import json
import os
import uuid
from urllib.parse import unquote

import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF_SMALL, d, plan_text, rows, ts
from memberpulse.functions import temporal as tm
from memberpulse.operators import registry, upkeep
from memberpulse.plans import catalog, jobs
from memberpulse.sources import fixtures as fx
from memberpulse.sources import readers as rd
from memberpulse.sources import registry_table as rt
from memberpulse.sources import sinks as sk

DAY = "2024-01-22"
HEADER = "identity,payment_status,signup_date,payment_date,churn_date,amount,refund,comment\n"


def land(folder: str, text: str, newline: str = "") -> str:
    path = rd.membership_csv_path(folder, DAY)
    with open(path, "w", newline=newline) as f:
        f.write(text)
    return path


# --- SRC1 -----------------------------------------------------------------------------------

def test_quoted_line_breaks_stay_in_their_record(spark, scratch):
    """A quoted line break in an ignored column invents no member."""
    path = land(scratch, HEADER + 'a,paid,2024-01-01,,,1,,"x\ny"\nb,signup,2024-01-02,,,,,"say ""hi"", \\n\r\nand go"\nc,paid,,,,2,,\n')
    got = rows(rd.read_memberships_csv(spark, scratch, DAY), "row_id")
    assert [(r["identity"], r["payment_status"], r["amount"]) for r in got] == [("a", "paid", 1.0), ("b", "signup", None), ("c", "paid", 2.0)]
    want = pd.read_csv(path)
    assert [r["identity"] for r in got] == list(want["identity"])
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).collect()[1]["comment"] == want["comment"][1]


@pytest.mark.parametrize("record", ["a,paid,2024-01-01", "a,paid,2024-01-01,,,1,,x,more"])
def test_short_and_long_records_fail(spark, scratch, record):
    land(scratch, HEADER + "b,paid,,,,1,,\n" + record + "\n")
    for multi_line in (True, False):
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            rd.read_memberships_csv(spark, scratch, DAY, multi_line=multi_line).collect()


def test_split_file_fails_on_a_quoted_line_break(spark, scratch):
    land(scratch, HEADER + 'a,paid,,,,1,,"x\ny"\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        rd.read_memberships_csv(spark, scratch, DAY, multi_line=False).select("identity").collect()


def test_split_file_keeps_the_order(spark, scratch):
    """Several splits of one file: rows numbered in file order, as in one task."""
    land(scratch, HEADER + "".join(f"u{i},paid,2024-01-01,,,{i},,\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = rd.read_memberships_csv(spark, scratch, DAY, multi_line=False)
        assert df.rdd.getNumPartitions() > 4
        assert [r["identity"] for r in df.orderBy("row_id").collect()] == [f"u{i}" for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["identity"] for r in rd.read_memberships_csv(spark, scratch, DAY).orderBy("row_id").collect()] == [f"u{i}" for i in range(3000)]


def test_rejected_values_are_counted(spark, scratch):
    """The reader's counts, after its first action; texts for no value are no rejects."""
    land(scratch, HEADER + "a,paid,2024-01-01,soon,NaT-ish,1,,\nb,paid,NA,,,ten,nan,\nNULL,paid,,,,1,,\nc,paid,2024-01-01,,,1,,\n")
    seen = Observation("csv")
    got = rows(rd.read_memberships_csv(spark, scratch, DAY, observation=seen))
    assert seen.get == {"rows": 4, "null_identities": 1, "bad_dates": 1, "bad_amounts": 1}
    assert got[1]["signup_date"] is None and got[1]["refund"] is None and got[2]["identity"] is None
    plain = rows(rd.read_memberships_csv(spark, scratch, DAY), "row_id")
    assert plain == got


def test_report_job_returns_and_fails_on_rejects(spark, scratch):
    fx.app_events(spark, SF_SMALL).write.parquet(f"{scratch}/app")
    fx.ga_events(spark, SF_SMALL).write.parquet(f"{scratch}/ga")
    land(scratch, HEADER + "a,paid,2024-01-01,2024-01-02,,1,,\nb,paid,2024-01-01,soon,,2,,\n")
    run = lambda **kw: jobs.run_service_report(spark, scratch, f"{scratch}/app", f"{scratch}/ga", f"{scratch}/out", DAY,
                                               fx.active_use(), **kw)
    out = run()
    assert out.metrics["memberships"] == {"rows": 2, "null_identities": 0, "bad_dates": 1, "bad_amounts": 0}
    before = rows(sk.read_report(spark, f"{scratch}/out/weekly_metrics"))
    with pytest.raises(ValueError, match="bad_dates"):
        run(max_rejected=0)
    assert rows(sk.read_report(spark, f"{scratch}/out/weekly_metrics")) == before


# --- FN1 ------------------------------------------------------------------------------------

WRITTEN = ["March 10, 2024", "Mar 10 2024", "10 March 2024", "10-Mar-2024", "03/10/2024", "13/01/2024", "3/1/2024 5:06",
           "2024-03-10 10:00 PM", "03/10/2024 12:05 AM", "12/31/2023 12:30 pm", "20240310T101010", "20240310T1010", "20240310 101010",
           "20240310101010", "20240310", "2024/03/10", "2024/3/1 7:05:09.25", "2024.03.10", "10.03.2024", "2024-3-1", "3.1.2024",
           "2024-03-10T10:10:10.123456Z", "2024-03-10 10:00 UTC", "2024-03-10 10:00Z", "2024-03-10 10:00:00 +0900",
           "2024-03-10T10:00:00+09", "2024-03-10T10:10:10 -05:00", "Sunday, March 10, 2024", "Sun Mar 10 10:00:00 2024",
           "Sun, 10 Mar 2024 10:00:00 GMT", "2024", "2024-03", "03-10-2024", "13-01-2024", "2024-03-10T10", "2024-03-10 10",
           "2024-03-10 10pm", "10th of March 2024", "March 10th, 2024", "March 2024", "Mar 10, 2024 at 10:00", "2024-03-10, 10:00",
           "  2024-03-10 ", "2024-03-10\n", "2024-03-10 10:00:00 PM", "2024-03-10 10:00 a.m.", "2024 March 10", "2024-Mar-10",
           "Sept 5, 2024", "5 sept. 2024", "MARCH 10, 2024", "2024-02-29", "1677-09-22", "2262-04-11",
           # no times
           "2024-13-01", "2024-02-30", "30 February 2024", "02/30/2024", "2024-03-10 24:00:00", "2024-03-10 13:00 PM", "202403",
           "1710064800", "2024-W10-7", "2024-03-10 10:00:60", "0001-01-01", "9999-12-31", "1677-09-20", "2262-04-12", "2024/13/10",
           "not a date", "Marching 10, 2024", "", "2024-03-10 10:00 Nowhere/Land", "-", "24:00", "March 10, 2024|x", "\x01\x01"]


def test_written_times_are_read_as_pandas_reads_them(spark):
    df = spark.createDataFrame(list(enumerate([*WRITTEN, None])), "i int, s string")
    got = [r["t"] for r in df.select("i", tm.lenient_timestamp(F.col("s")).alias("t")).orderBy("i").collect()]
    for text, found in zip([*WRITTEN, None], got):
        want = pd.to_datetime(pd.to_datetime(text, errors="coerce") if text else pd.NaT, utc=True)
        assert found == (None if want is pd.NaT else want.tz_localize(None).to_pydatetime()), text


def test_zones_by_name_and_years_of_two_digits(spark):
    df = spark.createDataFrame([("2024-03-10 10:00 Asia/Seoul",), ("March 10, 2024 10:00 AM Asia/Seoul",), ("03/10/24",)], "s string")
    assert [r[0] for r in df.select(tm.lenient_timestamp(F.col("s"))).collect()] == [ts("2024-03-10 01:00:00")] * 2 + [None]


# --- SRC2, SRC3 -----------------------------------------------------------------------------

def land_pages(folder: str, numbers: list, empty: tuple = (), field: str = "members") -> None:
    for i, n in enumerate(numbers):
        records = [] if n in empty else [{"id": f"m{n}", "email": f"{n}@x"} if field == "members" else {"title": f"m{n}"}]
        page = {field: records} | ({} if n is None else {"page": n})
        with open(f"{folder}/{i}.json", "w") as f:
            f.write(json.dumps(page) + "\n")


@pytest.mark.parametrize("numbers, empty, message", [
    ([1, 3, 4], (4,), "pages 1 to 4"), ([2, 3], (3,), "first is 2"), ([1, 2, 2, 3], (3,), "page 2 landed more than once"),
    ([1, 1, 4, 4, 5], (5,), "page 1 landed more than once"), ([1, 2, 3], (), "not empty"), ([1, 2, 3], (2, 3), "page 2 of 3 is empty"),
    ([1, None, 2], (2,), "no number"), ([0, 1, 2], (2,), "first is 0")])
def test_lost_and_repeated_pages_fail_before_the_sync(spark, scratch, numbers, empty, message):
    land_pages(scratch, numbers, empty)
    with pytest.raises(ValueError, match=message):
        rd.read_member_pages(spark, scratch)


def test_whole_dumps(spark, scratch):
    os.makedirs(f"{scratch}/a")
    land_pages(f"{scratch}/a", [3, 1, 2, 4], (4,))
    assert sorted(r["id"] for r in rd.read_member_pages(spark, f"{scratch}/a").collect()) == ["m1", "m2", "m3"]
    os.makedirs(f"{scratch}/b")
    for n, records in ((1, [{"id": "x", "email": "x@x"}]), (2, [])):
        with open(f"{scratch}/b/2024-members-page{n:05d}.json", "w") as f:
            json.dump({"members": records}, f, indent=1)
    by_name = rd.read_member_pages(spark, f"{scratch}/b", multi_line=True, page=rd.FILE_NAME)
    assert [r["id"] for r in by_name.collect()] == ["x"]
    os.remove(f"{scratch}/b/2024-members-page00001.json")
    with pytest.raises(ValueError, match="first is 2"):
        rd.read_member_pages(spark, f"{scratch}/b", multi_line=True, page=rd.FILE_NAME)
    os.makedirs(f"{scratch}/c")
    land_pages(f"{scratch}/c", [None], field="posts")
    assert rd.read_post_pages(spark, f"{scratch}/c", page=None).count() == 1
    land_pages(f"{scratch}/c", [None, None], field="posts")
    with pytest.raises(ValueError, match="one document"):
        rd.read_post_pages(spark, f"{scratch}/c", page=None)


def test_a_lost_page_deletes_no_member(spark, scratch):
    """P3 with a hole in the fresh dump: the job fails and the registry stays as it was."""
    catalog._land_member_pages(spark, SF_SMALL, f"{scratch}/members")
    fx.registry(spark, SF_SMALL).write.parquet(f"{scratch}/registry")
    pages = spark.read.json(f"{scratch}/members")
    pages.where("page <> 1").write.json(f"{scratch}/holed")
    with pytest.raises(ValueError, match="landed"):
        jobs.run_member_upkeep(spark, f"{scratch}/members", f"{scratch}/registry", f"{scratch}/out", fx.NOW, 2000, fx.SEED,
                               fresh_members_path=f"{scratch}/holed")
    assert not os.path.exists(f"{scratch}/out/registry_v2")


# --- SNK1 -----------------------------------------------------------------------------------

def test_readers_always_find_one_whole_report(spark, scratch):
    """Before, between and after two writes, and when a write fails before its last step."""
    target = f"{scratch}/weekly"
    with pytest.raises(FileNotFoundError):
        sk.read_report(spark, target)
    sk.publish_report(spark.range(3), target)
    former = sk.read_report(spark, target)
    with pytest.raises(Exception, match="no rows today"):
        sk.publish_report(spark.range(7).select(F.raise_error(F.lit("no rows today")).cast("bigint").alias("id")), target)
    assert sk.read_report(spark, target).count() == 3
    spark.range(9).write.parquet(f"{target}/v{90:08d}")
    os.remove(f"{target}/v{90:08d}/_SUCCESS")                        # all rows written, the last step not done
    assert sk.read_report(spark, target).count() == 3
    assert sk.publish_report(spark.range(5), target).endswith("v00000091")
    assert sk.read_report(spark, target).count() == 5


def test_old_versions_go_but_the_last_ones_stay(spark, scratch):
    target = f"{scratch}/weekly"
    for n in range(1, 5):
        sk.publish_report(spark.range(n), target)
        if n == 3:
            held = sk.read_report(spark, target)
    assert held.count() == 3                                         # opened before the fourth write
    assert sorted(os.listdir(target)) == ["v00000003", "v00000004"]


def test_report_view_is_switched_in_one_step(spark, scratch, monkeypatch):
    name = f"memberpulse_views_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch}/db'")
    try:
        sk.publish_report(spark.range(3), f"{name}.weekly")
        assert sk.read_report(spark, f"{name}.weekly").count() == 3
        real, seen = spark.sql, []

        def failing(text, *args, **kw):
            if text.startswith("CREATE OR REPLACE VIEW"):
                seen.append(real(f"SELECT count(*) FROM {name}.weekly").first()[0])
                raise RuntimeError("lost the catalog")
            return real(text, *args, **kw)

        monkeypatch.setattr(spark, "sql", failing)
        with pytest.raises(RuntimeError, match="lost the catalog"):
            sk.publish_report(spark.range(5), f"{name}.weekly")
        monkeypatch.undo()
        assert seen == [3] and spark.table(f"{name}.weekly").count() == 3
        sk.publish_report(spark.range(6), f"{name}.weekly")
        assert spark.table(f"{name}.weekly").count() == 6
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


# --- SNK2 -----------------------------------------------------------------------------------

def test_partition_load_by_table_name(spark, scratch):
    name = f"memberpulse_kpis_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch}/db'")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    try:
        spark.sql(f"CREATE TABLE {name}.subs (total BIGINT, lang_code STRING, date DATE) USING parquet PARTITIONED BY (date)")
        mk = lambda day, total: spark.createDataFrame([(str(total), "en", d(day))], "total string, lang_code string, date date")
        for day, total in (("2024-01-15", 1), ("2024-01-22", 2), ("2024-01-22", 3)):
            sk.overwrite_partitions(mk(day, total), f"{name}.subs")
        got = spark.table(f"{name}.subs")
        assert sorted(map(tuple, got.collect())) == [(1, "en", d("2024-01-15")), (3, "en", d("2024-01-22"))]
        for drifting in (mk("2024-01-29", 4).drop("lang_code"), mk("2024-01-29", 4).withColumn("more", F.lit(1))):
            with pytest.raises(ValueError, match="target schema"):
                sk.overwrite_partitions(drifting, f"{name}.subs")
        with pytest.raises(Exception):                               # a value that is no BIGINT
            sk.overwrite_partitions(mk("2024-01-29", "many"), f"{name}.subs")
        assert got.count() == 2
        with pytest.raises(ValueError, match="partitioned by"):
            sk.overwrite_partitions(mk("2024-01-29", 4), f"{name}.subs", "lang_code")
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


# --- SNK3 -----------------------------------------------------------------------------------

def test_archive_is_byte_for_byte(spark, scratch):
    contents = {"of day 1/p 1%.json": b"{}", "a.json": b'{"members": [],\r\n "x": 1}', "sub/b.json": b"no final newline \xff\x00", "sub/c.json": b"", "d.json": b"\n\n"}
    for name, data in contents.items():
        os.makedirs(os.path.dirname(f"{scratch}/landed/{name}"), exist_ok=True)
        with open(f"{scratch}/landed/{name}", "wb") as f:
            f.write(data)
    for _ in range(2):                                               # a re-run replaces the archive
        path = sk.archive_raw(spark, f"{scratch}/landed", f"{scratch}/raw", DAY, "members.json")
        assert path == f"{scratch}/raw/20240122/members.json"
        found = {os.path.relpath(f, path): open(f, "rb").read() for f in glob.glob(f"{path}/**", recursive=True) if os.path.isfile(f)}
        assert {k: v for k, v in found.items() if not k.endswith(".crc")} == contents
    manifest = {os.path.relpath(unquote(r["file"].removeprefix("file://")), path): r for r in sk.check_archive(spark, path).collect()}
    assert {k: (r["length"], r["sha256"], r["intact"]) for k, r in manifest.items()} == {
        k: (len(v), hashlib.sha256(v).hexdigest(), True) for k, v in contents.items()}
    with open(f"{path}/a.json", "ab") as f:
        f.write(b" ")
    assert [r["file"].rsplit("/", 1)[1] for r in sk.check_archive(spark, path).where("NOT intact").collect()] == ["a.json"]
    with pytest.raises(Exception):
        sk.archive_raw(spark, f"{scratch}/nothing", f"{scratch}/raw", DAY, "members.json")


def test_dump_of_one_file_is_one_object(spark, scratch):
    with open(f"{scratch}/dump.json", "wb") as f:
        f.write(b"line\r\n" * 1000)
    path = sk.archive_raw(spark, f"{scratch}/dump.json", f"{scratch}/raw", DAY, "members.json")
    assert open(path, "rb").read() == b"line\r\n" * 1000


# --- SRT3, OP12 -----------------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 7, 40, 199, 200, 201, 1000])
def test_sample_takes_the_first_by_hash(spark, n):
    rows_ = [(f"u{i % 150}@x", "pending" if i % 3 else "active", "L", None) for i in range(300)]
    reg = spark.createDataFrame(rows_, "email string, status string, label string, note string")
    want = sorted((hashlib.md5(f"{e}7".encode()).hexdigest(), e) for e, s, _, _ in rows_ if s == "pending")[:n]
    picked = upkeep.invite_batch(reg, n, "7")
    assert sorted(r["email"] for r in picked.collect()) == sorted(e for _, e in want)
    assert "Join" not in plan_text(picked) and "Window" not in plan_text(picked)


def test_pending_row_without_email_fails(spark):
    reg = spark.createDataFrame([("a@x", "pending", "L", None), (None, "pending", "L", None), (None, "active", "L", None)],
                                "email string, status string, label string, note string")
    with pytest.raises(Exception, match="without email"):
        upkeep.invite_batch(reg, 1, "7").collect()
    assert upkeep.invite_batch(reg.where("email IS NOT NULL OR status = 'active'"), 5, "7").count() == 1


# --- SRC6, SNK4, SNK5 -----------------------------------------------------------------------

def test_registry_rows_without_email_are_counted(spark, scratch):
    reg = spark.createDataFrame([("a@x", "active"), (None, "active"), (None, "pending")], "email string, status string")
    reg.write.parquet(f"{scratch}/registry")
    seen = Observation("registry")
    assert rd.read_registry(spark, f"{scratch}/registry", "active", ("email",), observation=seen).count() == 2
    assert seen.get == {"rows": 3, "null_emails": 2}


def test_empty_inputs_are_counted_as_such(spark, scratch):
    """An empty registry and a CSV of a header alone: no rows, no failure."""
    empty = fx.registry(spark, SF_SMALL).limit(0)
    empty.write.parquet(f"{scratch}/registry")
    written = jobs.JobResult()
    for name, reg in (("read", spark.read.parquet(f"{scratch}/registry")), ("made", empty)):
        out = jobs._next_snapshot(written, name, f"{scratch}/{name}", reg, 0, lambda rows: registry.set_status(rows, empty, "failed", fx.NOW))
        assert written.metrics[name]["rows"] == 0 and out.count() == 0
    land(scratch, HEADER)
    seen = Observation("csv")
    rd.read_memberships_csv(spark, scratch, DAY, observation=seen).write.parquet(f"{scratch}/rows")
    assert rd.observed_counts(seen)["rows"] == 0 and spark.read.parquet(f"{scratch}/rows").count() == 0


@pytest.fixture()
def database(spark, scratch):
    name = f"memberpulse_registry_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def files(scratch: str) -> dict[str, float]:
    return {f: os.path.getmtime(f) for f in glob.glob(f"{scratch}/db/registry/part=*/*.parquet")}


def test_registry_table_changes_equal_the_snapshots(spark, scratch, database):
    table, reg, members = f"{database}.registry", fx.registry(spark, SF_SMALL), fx.members(spark, SF_SMALL)
    rt.create_registry_table(reg, table, parts=16, buckets=4)
    same = lambda want: sorted(map(str, rt.registry_rows(spark, table).select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert rt.is_registry_table(spark, table) and not rt.is_registry_table(spark, f"{scratch}/x") and same(reg)
    new, _ = registry.registry_diff(members, reg)
    failed = reg.where(F.md5("email").startswith("0")).select("email")
    want = registry.upsert(reg, new, fx.NOW)
    rt.upsert(spark, table, new, fx.NOW)
    assert same(want)
    want = registry.set_status(want, failed.union(failed), registry.FAILED, fx.NOW)
    rt.set_status(spark, table, failed.union(failed), registry.FAILED, fx.NOW)
    assert same(want)
    want = registry.sync(want, members, "2024-01-29 05:00:00")
    rt.sync(spark, table, members, "2024-01-29 05:00:00")
    assert same(want)
    held = files(scratch)
    assert rt.sync(spark, table, members, "2024-02-05 05:00:00") == 0 and files(scratch) == held    # nothing to do, nothing written


def test_registry_table_writes_in_proportion_to_the_change(spark, scratch, database):
    table = f"{database}.registry"
    rt.create_registry_table(fx.registry(spark, SF_SMALL), table, parts=16, buckets=4)
    before = files(scratch)
    keys = fx.registry(spark, SF_SMALL).select("email").limit(1).union(spark.createDataFrame([("nobody@x",)], "email string"))
    assert 1 <= rt.set_status(spark, table, keys, "failed", fx.NOW) <= 2
    after = files(scratch)
    assert 1 <= len({os.path.dirname(f) for f in set(before) ^ set(after)}) <= 2
    assert len({os.path.dirname(f) for f in before}) == 16
    assert rt.upsert(spark, table, keys.limit(0).selectExpr("email", "email AS label", "email AS note"), fx.NOW) == 0
    with pytest.raises(Exception, match="repeats email"):
        rt.upsert(spark, table, spark.createDataFrame([("x", "a", "b")] * 2, "email string, label string, note string"), fx.NOW)
    assert files(scratch) == after


def test_registry_side_of_a_change_is_not_shuffled(spark, scratch, database):
    """Only the changes are shuffled; the registry is read by its buckets, and only the touched partitions."""
    table = f"{database}.registry"
    rt.create_registry_table(fx.registry(spark, SF_SMALL), table, parts=16, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = spark.createDataFrame([("user1@example.com", "a", "b")], "email string, label string, note string").repartition(4, "email")
        rows_ = rt.touched(spark.table(table), [1, 2])
        flat = registry.members_flat(fx.members(spark, SF_SMALL)).repartition(4, "email")
        for plan in (plan_text(registry.upsert(rows_, source, fx.NOW)), plan_text(registry.set_status(rows_, source, "failed", fx.NOW)),
                     plan_text(registry.apply_changes(rows_, source.withColumn("status", F.lit("active")), fx.NOW)),
                     plan_text(registry.sync_changes(spark.table(table), flat))):
            lines = plan.split("\n")
            scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and ".registry[" in line)
            join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
            assert "Bucketed: true" in lines[scan] and not any("Exchange" in line for line in lines[join:scan]), plan
        assert "PartitionFilters: [part" in plan_text(registry.upsert(rows_, source, fx.NOW))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_changes_of_repeated_and_null_emails_equal_sync(spark):
    schema = "email string, label string, note string, created_at timestamp_ntz, updated_at timestamp_ntz, status string"
    old = ts("2023-01-01 00:00:00")
    reg = spark.createDataFrame([(e, "l", None, old, old, s) for e, s in (
        ("a", "active"), ("a", "deleted"), ("b", "active"), ("c", "pending"), (None, "active"), ("d", "active"), ("d", "failed"), ("e", None))], schema)
    members = spark.createDataFrame([(e, [], "n", old) for e in ("a", "c", "x", "b", "e")],
                                    "email string, labels array<struct<name: string, slug: string>>, note string, created_at timestamp_ntz")
    changes = registry.sync_changes(reg, registry.members_flat(members))
    got = registry.apply_changes(reg, changes, fx.NOW)
    assert sorted(map(str, got.collect())) == sorted(map(str, registry.sync(reg, members, fx.NOW).collect()))


def test_upkeep_job_on_a_registry_table(spark, scratch, database):
    table = f"{database}.registry"
    catalog._land_member_pages(spark, SF_SMALL, f"{scratch}/members")
    reg = fx.registry(spark, SF_SMALL)
    rt.create_registry_table(reg, table, parts=16, buckets=4)
    failed = reg.where(F.md5("email").startswith("0")).select("email")
    failed.write.parquet(f"{scratch}/failed")
    out = jobs.run_member_upkeep(spark, f"{scratch}/members", table, f"{scratch}/out", fx.NOW, 2000, fx.SEED,
                                 failed_path=f"{scratch}/failed", fresh_members_path=f"{scratch}/members")
    want = registry.sync(registry.set_status(reg, failed, registry.FAILED, fx.NOW), fx.members(spark, SF_SMALL), fx.NOW)
    assert sorted(map(str, rt.registry_rows(spark, out["registry"]).select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert out.metrics["registry"] == {"rows": reg.count(), "null_emails": 0}
