"""OP10–OP16, FLT8, FLT11, AGG13, SRT3, PRJ7, SNK4, SNK5, JON4–JON7, T12, T13, T15, T16."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, rows, ts
from memberpulse import schemas
from memberpulse.operators import registry as reg
from memberpulse.operators import upkeep as up
from memberpulse.sources import fixtures as fx
from test_audience_newsletters import member

NOW = "2024-01-22 05:00:00"


def test_inactive_members_label_protection(spark):
    """No labels protects; 'Internal' alone protects; 'Internal' + another does not."""
    df = spark.createDataFrame([
        member(1, [], subscribed=False),
        member(2, ["Internal"], subscribed=False),
        member(3, ["Internal", "English"], subscribed=False),
        member(4, [None], subscribed=False),                         # NULL name is "not Internal"
        member(5, ["English"], count=5, rate=24.9),                  # low engagement
        member(6, ["English"], count=5, rate=None),                  # NULL rate is not low
        member(7, ["English"], count=4, rate=1.0),                   # not mailed enough
        member(8, ["Korean"], suppressed=True),
        member(9, ["Korean"], subscribed=None),                      # NULL subscribed is not "False"
    ], schemas.MEMBERS)
    assert sorted(r["id"] for r in rows(up.inactive_members(df))) == ["m3", "m4", "m5", "m8"]


def test_capacity_floors_at_zero(spark):
    members = spark.createDataFrame([member(i, ["English"]) for i in range(5)], schemas.MEMBERS)
    deleted = spark.createDataFrame([("m1",), ("m1",), ("m2",)], "id string")
    r = rows(up.capacity(members, deleted, 4))[0]
    assert (r["total"], r["deleted"], r["member_limit"], r["capacity"]) == (5, 2, 4, 1)
    assert rows(up.capacity(members, deleted.limit(0), 1))[0]["capacity"] == 0
    assert rows(up.capacity(members, deleted, 2 * F.col("total")))[0]["capacity"] == 7


def registry_rows(spark, data):
    return spark.createDataFrame(
        [(e, lab, note, ts("2023-12-01 00:00:00"), ts("2023-12-02 00:00:00"), st) for e, lab, note, st in data],
        schemas.REGISTRY)


def test_invite_batch_is_seeded_sample_of_pending(spark):
    r = registry_rows(spark, [(f"p{i}@x", "English", None if i % 2 else "n", "pending") for i in range(30)]
                      + [("a@x", "Korean", None, "active")])
    got = rows(up.invite_batch(r, 5, "7"), "email")
    again = rows(up.invite_batch(r, 5, "7"), "email")
    assert got == again and len(got) == 5
    assert all(x["email"].startswith("p") for x in got)
    assert all(x["labels"] == [{"name": "English", "slug": "english"}] for x in got)
    assert {x["note"] for x in got} <= {"", "n"}
    expected = sorted((f"p{i}@x" for i in range(30)),
                      key=lambda e: __import__("hashlib").md5((e + "7").encode()).hexdigest())[:5]
    assert [x["email"] for x in got] == sorted(expected)


def test_set_status_ignores_repeated_keys(spark):
    r = registry_rows(spark, [("a@x", "English", None, "pending"), ("b@x", "Korean", None, "pending")])
    keys = spark.createDataFrame([("a@x",), ("a@x",), ("zzz@x",)], "email string")
    got = {x["email"]: x for x in rows(reg.set_status(r, keys, "failed", NOW))}
    assert len(got) == 2
    assert (got["a@x"]["status"], got["a@x"]["updated_at"]) == ("failed", ts(NOW))
    assert (got["b@x"]["status"], got["b@x"]["updated_at"]) == ("pending", ts("2023-12-02 00:00:00"))


def test_diff_upsert_and_sync(spark):
    r = registry_rows(spark, [
        ("stay@x", "English", "n1", "active"),      # in dump, active: unchanged
        ("back@x", "Korean", None, "deleted"),      # in dump, not active: new -> matched -> active (T15)
        ("gone@x", "English", None, "active"),      # not in dump: missing -> deleted
        ("wait@x", "English", None, "pending"),     # not in dump, not active: unchanged
    ])
    members = spark.createDataFrame([
        ("m1", "stay@x", [{"name": "English", "slug": "english"}], None, True, {"suppressed": False}, 0, None,
         ts("2024-01-01 00:00:00"), None),
        ("m2", "back@x", [{"name": "English", "slug": "english"}], "x", True, {"suppressed": False}, 0, None,
         ts("2024-01-01 00:00:00"), None),
        ("m3", "fresh@x", [], "hello", True, {"suppressed": False}, 0, None, ts("2024-01-01 00:00:00"), None),
    ], schemas.MEMBERS)
    new, missing = reg.registry_diff(members, r)
    assert sorted(x["email"] for x in rows(new)) == ["back@x", "fresh@x"]
    assert [x["email"] for x in rows(missing)] == ["gone@x"]
    composed = reg.set_status(reg.upsert(r, new, NOW), missing, reg.DELETED, NOW)
    fused = reg.sync(r, members, NOW)
    a, b = rows(composed, "email"), rows(fused, "email")
    assert a == b
    got = {x["email"]: x for x in b}
    assert (got["back@x"]["status"], got["back@x"]["label"], got["back@x"]["updated_at"]) == ("active", "Korean", ts(NOW))
    assert (got["fresh@x"]["status"], got["fresh@x"]["label"], got["fresh@x"]["created_at"]) == ("active", None, ts(NOW))
    assert got["gone@x"]["status"] == "deleted" and got["wait@x"]["status"] == "pending"
    assert got["stay@x"]["updated_at"] == ts("2023-12-02 00:00:00")


def test_sync_is_idempotent_on_fixture(spark):
    registry, members = fx.registry(spark, SF_SMALL), fx.members(spark, SF_SMALL)
    once = reg.sync(registry, members, NOW)
    twice = reg.sync(once, members, "2024-01-29 05:00:00")
    cols = ["email", "label", "note", "created_at", "status"]
    assert rows(once.select(cols), "email") == rows(twice.select(cols), "email")
    plan = plan_text(once)
    assert "CartesianProduct" not in plan and "PythonUDF" not in plan


def test_upsert_rejects_repeated_source_email(spark):
    r = registry_rows(spark, [("a@x", "English", None, "active")])
    src = spark.createDataFrame([("b@x", "English", None), ("b@x", "Korean", None)],
                                "email string, label string, note string")
    with pytest.raises(Exception, match="repeats email"):
        reg.upsert(r, src, NOW).collect()


def test_invite_batch_equals_a_plain_sort(spark):
    """The bucketed selection gives the rows of a full sort at any n; only the bucket at the cut is ranked, and nothing is joined."""
    r = fx.registry(spark, SF_SMALL).repartition(5)
    for n in (0, 7, 40, 10_000):
        small = sorted(x["email"] for x in rows(r.where("status = 'pending'").orderBy(up.invite_order("7"), "email").limit(n)))
        big = sorted(x["email"] for x in rows(up.invite_batch(r, n, "7")))
        assert small == big, n
    plan = plan_text(up.invite_batch(r, 40, "7"))
    assert plan.count("TakeOrderedAndProject") <= 1 and "Join" not in plan and "Window" not in plan


def test_other_registry_columns_survive(spark):
    """UPDATE and MERGE leave columns they don't name alone; inserts have NULL there."""
    r = registry_rows(spark, [("a@x", "English", None, "active"), ("b@x", "English", None, "pending")]).withColumn("plan", F.lit("gold"))
    members = fx.members(spark, SF_SMALL).limit(3)
    src = spark.createDataFrame([("b@x", "English", None), ("c@x", "Korean", None)], "email string, label string, note string")
    for out in (reg.set_status(r, src.select("email"), reg.FAILED, NOW), reg.upsert(r, src, NOW), reg.sync(r, members, NOW)):
        assert out.columns == r.columns
        assert {x["plan"] for x in rows(out) if x["email"] in ("a@x", "b@x")} == {"gold"}
    assert [x["plan"] for x in rows(reg.upsert(r, src, NOW)) if x["email"] == "c@x"] == [None]


def test_sync_leaves_active_rows_without_email(spark):
    r = registry_rows(spark, [("a@x", "English", None, "active")])
    r = r.union(r.withColumn("email", F.lit(None).cast("string")).select(r.columns))
    got = {x["email"]: x["status"] for x in rows(reg.sync(r, fx.members(spark, SF_SMALL).limit(1), NOW))}
    assert got["a@x"] == "deleted" and got[None] == "active"


def test_empty_sides_change_nothing(spark):
    """FLT15: without keys, members or new rows there is nothing to write, and nothing fails."""
    r = registry_rows(spark, [("a@x", "English", None, "active"), ("b@x", "Korean", "n", "pending")])
    none = spark.createDataFrame([], "email string, label string, note string")
    as_text = lambda df: sorted(map(str, df.select(r.columns).collect()))
    assert as_text(reg.set_status(r, none.select("email"), reg.FAILED, NOW)) == as_text(r)
    assert as_text(reg.upsert(r, none, NOW)) == as_text(r)
    assert reg.sync(r.limit(0), fx.members(spark, SF_SMALL).limit(0), NOW).count() == 0
    assert up.invite_batch(r.limit(0), 5, "7").count() == 0 and up.invite_batch(r, 0, "7").count() == 0
    assert up.inactive_members(fx.members(spark, SF_SMALL).limit(0)).count() == 0


def test_sync_activates_rows_without_a_status(spark):
    r = registry_rows(spark, [("user1@example.com", "English", None, None)])
    got = rows(reg.sync(r, fx.members(spark, SF_SMALL).where("email = 'user1@example.com'"), NOW))
    assert [x["status"] for x in got] == ["active"]
