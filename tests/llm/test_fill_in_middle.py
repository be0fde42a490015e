"""Fill-in-middle: a plain Python version, edge cases, exact restoration and the SQL text."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
from test_operators import DOCS, SF, clashing, edge_rows

from memberpulse.llm import fill_in_middle, oracle
from memberpulse.llm.queries import QUERIES


def plain_version(doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i: 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    pieces = ["word", " ", "\n", "\r\n", "é", "ß", "漢字", "😀", "é", "\\1", "$2", "{3}", "<", "<P", "S>", "M>", "9", " ", "\x00", "%d", "%"]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    marked = [f"a {m} b" for m in ("<P>", "<S>", "<M>")] + ["<<P", "<S<S", "P>>", "a", " ", "\n", "😀"]
    return made + marked + [None, "", "a" * 200_000, "x y" * 300_000, " " * 100_000]


def test_equals_the_plain_version(spark):
    rows = list(enumerate(odd_texts())) + [(-5, "negative id"), (2 ** 62, "large id"), (None, "no id at all"), (7, "repeated"), (7, "repeated")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = fill_in_middle.restore(fill_in_middle.fill_in_middle(docs)).collect()
    assert len(cut) == len(rows)
    for r in cut:
        want = plain_version(r["row"]["doc_id"], r["row"]["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["restored"] == (r["row"]["text"] or "")
    assert {r["form"] for r in cut} == {"plain", "psm", "spm"}


def test_edge_tables(spark):
    docs = spark.createDataFrame(edge_rows(), DOCS)
    out = fill_in_middle.restore(fill_in_middle.fill_in_middle(clashing(docs))).collect()
    assert sorted((r["row"]["doc_id"] or 0, r["restored"]) for r in out) == sorted((r[0] or 0, r[1] or "") for r in edge_rows())
    assert all(r["row"]["key"] == "x" for r in out)                  # clashing columns come back as they were
    assert fill_in_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_parameters_change_the_shares(spark):
    docs = spark.createDataFrame([(i, "some words here") for i in range(400)], "doc_id bigint, text string")

    def shares(**options) -> dict:
        return {r["form"]: r["count"] for r in fill_in_middle.fill_in_middle(docs, **options).groupBy("form").count().collect()}

    assert set(shares(plain_percent=0, spm_percent=0)) == {"psm"}
    assert set(shares(plain_percent=0, spm_percent=100)) == {"spm"}
    assert set(shares(plain_percent=100)) == {"plain"}
    assert shares() != shares(seed="2")


def test_query_matches_sql_without_python_on_the_path(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = QUERIES["op12_fill_in_middle"](spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(oracle.FILL_IN_MIDDLE).fetchall())
