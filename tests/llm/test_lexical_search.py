"""Ranked lexical search: a plain Python version, tie and edge cases, tiles and blocks, the SQL text."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_operators import DOCS, SF, clashing, edge_rows

from memberpulse.llm import lexical_search as search
from memberpulse.llm import oracle
from memberpulse.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(ASCII_LOWER))


def plain_version(docs: list[tuple], items: list[tuple], k: int) -> dict:
    """Per item the scores in order, and the ids that may stand at each (score, id)."""
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = {}
    for item, words in wanted.items():
        scored = []
        for d, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in words if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        if scored:
            out[item] = [(i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return out


def collected(found) -> dict:
    out: dict = {}
    for r in found.collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {i: sorted(v, key=lambda x: x[0]) for i, v in out.items()}


def corpus(seed: int, n: int = 300) -> tuple[list, list]:
    rng = random.Random(seed)
    words = ["A", "b", "C1", "ünï", "Ünï", "漢字", "x-y", "don't", "z_9", "7", "q"] + [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))) for i in range(n)]
    docs += [(n + i, docs[i][1]) for i in range(0, 80)]              # ties
    docs += [(5, "a second row of id 5 w1 w2"), (None, "w1 w2 w3"), (None, None), (n + 900, ""), (n + 901, "!!! ... ---")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))) for i in range(40)]
    items += [(3, "w1 w5 again"), (100, None), (101, ""), (102, "nowhere-to-be-found zzzz"), (None, "w7 w8"), (103, "w1 w1 W1 w1")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("k, block", [(50, 4096), (7, 10), (1, 4096)])
def test_equals_the_plain_version(spark, k, block):
    docs, items = corpus(k)
    found = search.lexical_search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
                                  spark.createDataFrame(items, "item_id bigint, text string"), k=k, block_items=block)
    assert collected(found) == plain_version(docs, items, k)


@pytest.mark.parametrize("tile", [(16, 3, 5), (1, 1, 1), (1024, 128, 2048)])
def test_tiles_give_equal_scores(monkeypatch, tile):
    """Whatever the tiles' sizes, scores equal a sum over terms in Python integers."""
    monkeypatch.setattr(search, "ITEM_TILE", tile[1])
    monkeypatch.setattr(search, "TERM_TILE", tile[2])
    rng = np.random.default_rng(4)
    lists = [np.unique(rng.integers(0, 50, rng.integers(0, 20))) for _ in range(17)]
    weights = rng.integers(0, 28_000, 50).astype(np.float64)
    block = search.Block(np.cumsum([0] + [len(x) for x in lists]), np.concatenate(lists), weights)
    held = [np.unique(rng.integers(0, 50, rng.integers(0, 30))) for _ in range(23)]
    impact = [rng.integers(0, search.IMPACT_BOUND, len(x)) for x in held]
    got = np.zeros((23, 17), np.int64)
    for first, scores in search.tile_scores(block, np.cumsum([0] + [len(x) for x in held]), np.concatenate(held).astype(np.int32), np.concatenate(impact)):
        got[:, first: first + scores.shape[1]] = scores
    for d in range(23):
        values = dict(zip(held[d].tolist(), impact[d].tolist()))
        assert got[d].tolist() == [sum(int(weights[t]) * values.get(t, 0) for t in x.tolist()) for x in lists]


def test_slices_stay_below_two_to_the_53():
    heavy = search.Block(np.array([0, 1]), np.array([0]), np.array([9e8]))
    assert heavy.width() * 9e8 * search.IMPACT_BOUND < 2 ** 53
    assert search.Block(np.array([0, 0]), np.zeros(0, np.int64), np.zeros(0)).width() == search.TERM_TILE


def test_lengths_norm_is_exact_for_huge_corpora():
    n = np.array([1, 10 ** 7, 3], np.int64)
    assert search.lengths_norm(n, 10 ** 12, 7 * 10 ** 14).tolist() == [50 + 50 * int(x) * 10 ** 12 // (7 * 10 ** 14) for x in n]


def test_vocabulary_compares_bytes(monkeypatch):
    monkeypatch.setattr(search, "word_hashes", lambda d, s, e: ((e - s) % 2).astype(np.uint64))    # all hashes collide
    known = search.Vocabulary(["a", "bb", "ccc", "abc", "dd"])
    data, starts, ends, _ = search.term_spans([b"dd abc a zz ccc bb b abd"])
    assert known.find(data, starts, ends).tolist() == [4, 3, 0, -1, 2, 1, -1, -1]


def test_edge_tables(spark):
    docs = spark.createDataFrame(edge_rows(), DOCS)
    items = spark.createDataFrame([(1, edge_rows()[6][1]), (2, None), (1, "one"), (None, "one two"), (4, "")], "item_id bigint, text string")
    plain = collected(search.lexical_search(docs, items))
    assert plain == plain_version([r[:2] for r in edge_rows()], [tuple(r) for r in items.collect()], 50)
    more = search.lexical_search(clashing(docs).selectExpr("*", "1 AS rank", "'y' AS item_id"), clashing(items).selectExpr("*", "2 AS doc_id"))
    assert collected(more) == plain
    assert search.lexical_search(docs.limit(0), items).count() == 0
    assert search.lexical_search(docs, items.limit(0)).count() == 0
    texts = search.lexical_search(docs.selectExpr("concat('d', doc_id) AS doc_id", "text"), items.selectExpr("concat('i', item_id) AS item_id", "text"))
    assert {len(v) for v in collected(texts).values()} == {len(v) for v in plain.values()}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES["op13_lexical_search"](spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(oracle.LEXICAL_SEARCH).fetchall())
