"""Brute-force checks and edge cases of the llm operators on small tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from memberpulse.llm import (components, decontaminate, language_id, license_scan, line_dedup, oracle, packing, quality_cascade,
                             simhash, substring_dedup, toxicity, warc)
from memberpulse.llm.common import Workspace
from memberpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [a + b for a in "ba de fi go lu mi no pe ra su".split() for b in "ta ren lo mi sk vor".split()]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def edge_rows() -> list[tuple]:
    """NULLs, empty and very long texts, repeated rows, ids that repeat or are NULL."""
    rng = random.Random(3)
    long = "\n".join(sentence(rng, 40) for _ in range(500))
    shared = "\n".join(sentence(rng, 30) for _ in range(4))
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (4, long, "en", "b", len(long)),
            (5, long, "fr", "b", len(long)), (None, shared, "en", "a", 1), (7, shared, None, "a", 1), (7, shared, None, "a", 1),
            (7, sentence(rng, 80), "fr", "c", 1), (8, shared + "\n" + sentence(rng, 60), "fr", "c", 1), (9, "one", "en", "c", 3),
            (10, "Ünï çôdé #|* " * 40, "de", "d", 1), (11, "\n".join("- " + sentence(rng, 9) for _ in range(9)), "de", "d", 1),
            (12, "\n".join(sentence(rng, 20) + (" ... " if i % 2 else "…") for i in range(5)), "de", "d", 1),
            (13, "42 -- 7.5 !? " * 12 + sentence(rng, 70), "de", "d", 1), (14, "a 1é ½ _ " + sentence(rng, 60), "de", "d", 1)]
    return rows + [(20 + i, sentence(rng, 60), ["en", "fr"][i % 2], "a", 1) for i in range(12)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


def clashing(df):
    """Extra columns named like those that operators make."""
    for c in ("key", "id", "row", "fp", "w", "n", "p", "score", "kept", "component", "n_lines", "shard", "words", "text2"):
        df = df.selectExpr("*", f"'x' AS {c}")
    return df


LABELS = "doc_id bigint, quality int, toxic int"


def operators(spark):
    labels = spark.createDataFrame([(4, 1, 1), (8, 1, 0), (None, 1, 1), (20, None, None), (21, 0, 1)], LABELS)
    items = spark.createDataFrame([(1, edge_rows()[6][1]), (2, None), (3, ""), (1, "one"), (None, "one two")], "item_id bigint, text string")
    return {
        "substring": lambda d: substring_dedup.shared_passages(d),
        "language": lambda d: language_id.language_id(d, steps=5),
        "quality": lambda d: quality_cascade.cascade(d).select("row.doc_id", "n_words", "kept"),
        "licence": lambda d: license_scan.license_scan(d.withColumnRenamed("source", "path")),
        "lines": lambda d: line_dedup.dedup_lines(d),
        "simhash": lambda d: simhash.simhash_groups(d),
        "keep_one": lambda d: simhash.keep_one(d),
        "packing": lambda d: packing.pack_documents(d),
        "decontaminate": lambda d: decontaminate.decontamination_report(d, items),
        "clean": lambda d: decontaminate.clean_documents(d, items),
        "toxicity": lambda d: toxicity.toxicity(d, labels),
    }


ONE_PER_ROW = ("language", "quality", "licence", "lines", "simhash", "decontaminate", "toxicity")
NAMES = ("substring", "language", "quality", "licence", "lines", "simhash", "keep_one", "packing", "decontaminate", "clean", "toxicity")


@pytest.mark.parametrize("name", NAMES)
def test_edge_cases(spark, edges, name):
    op = operators(spark)[name]
    out = op(edges)
    plain = out.collect()
    assert len(op(edges.limit(0)).collect()) == 0
    with_more = op(clashing(edges)).select(*out.columns).collect()
    if name != "clean":                                             # its columns are the input's
        assert len(with_more) == len(plain)
    if name in ONE_PER_ROW:
        assert Counter(r["doc_id"] for r in plain) == Counter(r[0] for r in edge_rows())


def test_quality_and_lines_match_sql(spark, edges):
    con = duckdb.connect()
    distinct = [r for r in edge_rows() if r[0] is not None and r[0] != 7]
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", distinct)
    docs = spark.createDataFrame(distinct, DOCS)
    got = quality_cascade.cascade(docs).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                               "base_failed", "kept")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(oracle.QUALITY).fetchall())
    lines = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert sorted(map(tuple, lines)) == sorted(con.execute(oracle.LINES).fetchall())
    removed = {r["doc_id"]: r["n_removed"] for r in lines}
    assert removed[4] == 0 and removed[5] == 500                    # the copy loses all, the first nothing


def test_rule_order_does_not_change_the_verdict(edges):
    rules = quality_cascade.BASE + quality_cascade.FURTHER
    order = quality_cascade.rule_order(edges, rules)
    assert sorted(r.name for r in order) == sorted(r.name for r in rules)
    kept = {str(o): [r["kept"] for r in quality_cascade.cascade(edges, order=o).orderBy("row.doc_id", "n_words").collect()]
            for o in (rules, rules[::-1], order)}
    assert len({str(v) for v in kept.values()}) == 1


def test_rules_are_ordered_by_rejections_per_time(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, sentence(rng, 60 + i % 7)) for i in range(400)], "doc_id bigint, text string")
    slow = "length(concat_ws(' ', transform(sequence(1, 60), i -> sha2(concat(t, i), 512)))) > 0 AND n_words > 1"
    made = [quality_cascade.Rule(*x) for x in (("never", "n_words < 0"), ("dear", slow), ("cheap", "n_words > 1"))]
    assert [r.name for r in quality_cascade.rule_order(docs, made)] == ["cheap", "dear", "never"]
    assert quality_cascade.rule_order(docs.limit(0), made)


def test_a_rejected_text_never_reaches_a_later_rule(spark, edges):
    """Later rules that fail on evaluation stay silent for rejected texts, and speak up for one that gets there."""
    trap = quality_cascade.Rule("trap", "raise_error('reached') IS NULL AND regexp_count(t, 'x') > 0")
    short = spark.createDataFrame([(i, "few words") for i in range(20)] + [(99, None)], "doc_id bigint, text string")
    out = quality_cascade.cascade(short, order=[quality_cascade.BASE[0], trap])
    assert {(r["failed_rule"], r["kept"], r["base_failed"]) for r in out.collect()} == {("short", False, True)}
    with pytest.raises(Exception, match="reached"):
        quality_cascade.cascade(edges, order=[quality_cascade.BASE[0], trap]).collect()


# --- SimHash --------------------------------------------------------------------------------

def components_of(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_links_of_hot_buckets_match_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2 ** 62, 6, dtype=np.uint64)
    fps = set()
    for c in centres:
        for _ in range(120):
            x = int(c)
            for b in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    want = components_of(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 4])
    table = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    for cell in (16, 4096):                                         # cut into cells, and whole
        ws = Workspace(spark)
        links = simhash.near_links(table, 4, ws, blocks=5, cell=cell).collect()
        got = components_of(fps, [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links])
        assert got == want


def test_zero_fingerprints_link_and_hubs_converge(spark):
    docs = spark.createDataFrame([(3, ""), (5, None), (9, " ")], "doc_id bigint, text string")
    assert {(r["fingerprint"], r["component_id"]) for r in simhash.simhash_groups(docs).collect()} == {("0" * 16, 3)}
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components.connected_components(edges, Workspace(spark)).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_signature_of_many_links_does_not_overflow(spark):
    links = spark.range(20_000_000).selectExpr("id AS a", "0L AS b")
    assert components._signature(links)[0] == 20_000_000


# --- packing --------------------------------------------------------------------------------

def test_packing_round_trip(spark, edges):
    out = packing.pack_documents(edges.where("doc_id <> 7"), capacity=64).collect()
    slow = packing.Encoder(**{**packing.public_bpe(), "ranks_path": None})
    want = []
    for doc_id, text, *_ in edge_rows():
        if doc_id not in (None, 7):
            ids = np.append(slow(text or ""), 2).astype("<u4")
            starts = packing.cut(len(ids), 64)
            want += [(doc_id, i, s, e - s, zlib.crc32(ids[s:e].tobytes())) for i, (s, e) in
                     enumerate(zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]))]
    assert sorted(tuple(r)[:5] for r in out) == sorted(want)
    places: dict = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 64
    bound = packing.lower_bound(np.bincount([r["length"] for r in out], minlength=65), 64)
    assert bound <= len(places) <= bound + 1


def test_bound_never_exceeds_the_optimum():
    rng = random.Random(1)
    for _ in range(60):
        bins, sizes = rng.randint(1, 8), []
        for _ in range(bins):                                       # a known packing into full bins
            left = 30
            while left:
                s = rng.randint(1, left)
                sizes.append(s)
                left -= s
        assert packing.lower_bound(np.bincount(sizes, minlength=31), 30) == bins
        _, _, fill = packing.best_fit_decreasing(np.array(sorted(sizes, reverse=True)), 30)
        assert bins <= len(fill) and sum(fill) == sum(sizes)


def test_both_tokenizer_libraries_agree(spark):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["it's  a\t\n\n b   ", "<|endoftext|> x", "ÀÉ ñ ß “quoted” — €5", "日本語 text ½ \x85 ok", "a \n b\r\n"]
    fast, slow = packing.Encoder(**packing.public_bpe()), packing.Encoder(**{**packing.public_bpe(), "ranks_path": None})
    assert all(np.array_equal(fast(t), slow(t)) for t in texts if t)


# --- WARC -----------------------------------------------------------------------------------

def test_warc_revisits_and_determinism(spark, scratch):
    big, rows = "é" * 600, []
    rows += [(i, f"http://h/{i}", big) for i in range(40)]
    rows += [(100, "http://h/a b", None), (101, None, ""), (102, "u", "small"), (103, "u", "small"), (None, "n", big), (39, "http://h/39", big)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    files = []
    for name, parts in (("one", 1), ("two", 5)):
        made = warc.write_warc(pages.repartition(parts), f"file://{scratch}/{name}", shard_bytes=8000, roll_bytes=300)
        files.append(sorted((r["path"].rsplit("/", 1)[1], r["sha256"], r["records"]) for r in made.collect()))
    assert files[0] == files[1] and len(files[0]) > 3
    got = warc.read_warc(spark, f"file://{scratch}/one").collect()
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
    for r in got:
        if r["page_id"] in (39, 100, 101, 102, 103):
            assert r["record_type"] == "response" and r["refers_to"] is None
            assert len(r["payload"]) == r["payload_bytes"] and hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
        else:
            assert (r["record_type"], r["refers_to"], r["payload_bytes"]) == ("revisit", 39, 1200)
            assert r["payload_digest"] == hashlib.sha1(big.encode()).hexdigest()
    empty = warc.write_warc(pages.limit(0), f"file://{scratch}/none")
    assert empty.count() == 0 and warc.read_warc(spark, f"file://{scratch}/none").count() == 0


# --- decontamination, licences, passages ----------------------------------------------------

def test_decontamination_matches_sql(spark):
    rng = random.Random(9)
    item = [rng.choice(WORDS) for _ in range(30)]
    items = [(1, " ".join(item)), (2, " ".join(item[:5])), (10, "É" + item[0]), (11, None), (12, "!!")]
    docs = [(i, " ".join(WORDS[i: i + 5] + item[i: i + 14] + WORDS[:20 * (i % 3)])) for i in range(18)] + [(90, None), (91, ", ".join(item).upper())]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    got = decontaminate.decontamination_report(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                               spark.createDataFrame(items, "item_id bigint, text string")).drop("key")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(oracle.DECONTAMINATION).fetchall())


def test_licences_are_inherited_from_the_nearest_folder(spark):
    files = [(1, "r/LICENSE", "Released under the MIT License."), (2, "r/a/b/x.txt", "code"), (3, "r/a/COPYING.txt", "Licensed under CC BY-NC 4.0."),
             (4, "r/a/b/own.txt", "x\n# Licensed under the Apache License, Version 2.0\ny"), (5, "s/x.txt", "code"), (6, None, "code"), (7, "r/c/y", None)]
    got = {r["doc_id"]: (r["own_license"], r["license"], r["inherited_from"]) for r in
           license_scan.license_scan(spark.createDataFrame(files, "doc_id bigint, path string, text string")).collect()}
    assert got[2] == (None, "CC-BY-NC-4.0", "r/a") and got[4] == ("Apache-2.0", "Apache-2.0", None)
    assert got[5] == (None, None, None) and got[6] == (None, None, None) and got[7] == (None, "MIT", "r")


def test_licence_lines_match_whatever_stands_around_them(spark):
    rng = random.Random(23)
    notices = [(name, text) for name, text in license_scan.TEMPLATES if len(text.split()) > 3]
    files = [(i, "r/x", "Copyright Acme. All of it by Foo Bar Baz 2019; code " + text + " see the file for more") for i, (_, text) in enumerate(notices)]
    inserted = [(5000, "r/x", "Licensed under the common Apache License, Version 2.0"), (5001, "r/x", "Code Released under the MIT License.")]
    plain = [(6000 + i, "r/x", sentence(rng, 30) + " common code") for i in range(400)] + [(9000, "r/x", "version 2.0 of the software")]
    got = {r["doc_id"]: r["own_license"] for r in license_scan.license_scan(
        spark.createDataFrame(files + inserted + plain, "doc_id bigint, path string, text string")).collect()}
    assert [got[i] for i, _ in enumerate(notices)] == [name for name, _ in notices]
    assert got[5000] == "Apache-2.0" and got[5001] == "MIT" and all(got[r[0]] is None for r in plain)


def test_fuzzy_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(11)
    passage = sentence(rng, 70).split()
    edited = passage[:20] + ["other"] + passage[21:45] + passage[46:]
    docs = [(i, sentence(rng, 90)) for i in range(30)]
    docs += [(100 + i, sentence(rng, 30 + i) + " " + " ".join(passage) + " " + sentence(rng, 40)) for i in range(5)]
    docs += [(200, sentence(rng, 55) + "\n" + " ".join(edited).upper() + "\n" + sentence(rng, 20))]
    got = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r["doc_id"] for r in got} == {101, 102, 103, 104, 200}
    assert {r["other_doc_id"] for r in got} <= {100, 101, 102, 103, 104}
    assert all(r["stop"] - r["start"] >= 65 and r["identity"] >= 0.9 for r in got)
    exact = next(r for r in got if r["doc_id"] == 101)
    assert (exact["start"], exact["stop"]) == (31, 101)


def test_passages_on_both_sides_of_a_bad_gap_are_found(spark):
    rng = random.Random(13)
    docs, want = [], {}
    for n, gap in enumerate((10, 30, 50, 120, 250, 400, 600)):
        head, foot = sentence(rng, 60), sentence(rng, 60)
        for place, other in ((2 * n, gap), (2 * n + 1, gap if n % 2 else 0)):      # a gap in both texts, or in the first only
            docs.append((place, head + " " + sentence(rng, other) + " " + foot))
        want[2 * n + 1] = [(0, 60), (60 + other, 120 + other)]
    got = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    for place, spans in want.items():
        for start, stop in spans:
            assert any(r["doc_id"] == place and r["start"] <= start and r["stop"] >= stop for r in got), (place, start)


def uncovered(docs, got, size=50):
    """Words in runs of ``size`` words that an earlier document holds, outside of the passages of their document."""
    first, missed = {}, []
    spans: dict = {}
    for r in got:
        spans.setdefault(r["doc_id"], []).append((r["start"], r["stop"]))
    for doc_id, text in sorted(docs):
        words, need = text.lower().split(), set()
        for i in range(len(words) - size + 1):
            if first.setdefault(tuple(words[i: i + size]), doc_id) != doc_id:
                need |= set(range(i, i + size))
        missed += [(doc_id, i) for i in sorted(need) if not any(a <= i < b for a, b in spans.get(doc_id, ()))]
    return missed


def test_every_run_that_an_earlier_document_holds_is_covered(spark):
    rng = random.Random(17)
    whole = [sentence(rng, 60).split() for _ in range(4)]
    halves = [part for w in whole for part in (w[:30], w[30:])]
    texts = [sentence(rng, 70) + " " + " ".join(h) + " " + sentence(rng, 70) for h in halves]       # earlier holders of halves
    texts += [sentence(rng, 20 + i) + " " + " ".join(w) + " " + sentence(rng, 30) for i in range(6) for w in whole]
    texts += ["lo " * 400 + sentence(rng, 50), sentence(rng, 50) + " lo" * 300, " ".join("ba de fi".split() * 200)]
    texts += [" ".join("ba de fi".split() * 90) + " " + sentence(rng, 80), texts[9], texts[9] + " " + " ".join(whole[0][5:55])]
    docs = list(enumerate(texts))
    out = []
    for parts in (1, 7):
        frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
        out.append(sorted(map(tuple, (got := substring_dedup.shared_passages(frame).collect()))))
        assert uncovered(docs, got) == []
    assert out[0] == out[1]


def test_a_passage_after_a_quote_of_its_start_is_found(spark):
    rng = random.Random(19)
    exact, fuzzy = sentence(rng, 120).split(), sentence(rng, 120).split()
    edited = [w if i % 30 else "other" for i, w in enumerate(fuzzy, 1)]     # no equal run of 50 words
    quoting = lambda start, passage: " ".join([sentence(rng, 40), *start, sentence(rng, 300), *passage, sentence(rng, 40)])
    docs = [(1, quoting(exact[:70], exact)), (2, sentence(rng, 20) + " " + " ".join(exact)),
            (3, " ".join(fuzzy) + " " + sentence(rng, 20)), (4, quoting(edited[:70], edited))]
    got = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert uncovered(docs, got) == []
    assert any(r["doc_id"] == 2 and r["other_doc_id"] == 1 and r["start"] <= 20 and r["stop"] >= 140 for r in got)
    assert any(r["doc_id"] == 4 and r["other_doc_id"] == 3 and r["start"] <= 410 and r["stop"] >= 529 for r in got)


# --- learned operators ----------------------------------------------------------------------

def test_language_gradients_and_held_out_accuracy(spark):
    rng = np.random.default_rng(0)
    shapes = ((2, 256, 9), (2, 3, 9), (2, 3), (6, 4), (4,))
    net = language_id.Network(*[rng.normal(0, 0.3, s) for s in shapes], ("a", "b", "c", "d"))
    data, lengths, target = rng.integers(0, 256, (5, 7)), np.array([7, 3, 5, 1, 6]), np.array([0, 1, 2, 3, 0])
    _, grads = language_id._gradients(net, data, lengths, target)
    for p, g in zip((net.u, net.c, net.o, net.b), grads[1:]):
        at = tuple(0 for _ in p.shape)
        before = p[at]
        losses = []
        for step in (1e-2, -1e-2):
            p[at] = before + step
            losses.append(language_id._gradients(net, data, lengths, target)[0])
        p[at] = before
        assert abs((losses[0] - losses[1]) / 2e-2 - g[at]) < 1e-3
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_id(docs, steps=250).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) > 0.97 * len(got)
    assert all(r["held_out"] and 0 <= r["score"] <= 1 for r in got)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").collect()
    hits = sum(r["predicted"] == r["toxic"] for r in got)
    false = sum(r["predicted"] == 1 and r["toxic"] == 0 for r in got)
    assert hits > 0.97 * len(got) and false < 0.01 * len(got)


# --- the pipeline ---------------------------------------------------------------------------

def test_pipeline_matches_brute_force(spark):
    """Each stage against a plain version on the rows that the one before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ws, stage = Workspace(spark), {}
    for name, f in corpus_pipeline.STAGES:
        before, docs = docs, ws.stage(name, f(spark, docs, SF))
        stage[name] = (before.collect(), docs.collect())
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    before, after = stage["line_dedup"]
    seen, want = set(), {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        lines, gone = r["text"].split("\n"), set()
        full = [(i, x.strip(" \t\n\x0b\x0c\r")) for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        for j in range(len(full) - 2):
            window = tuple(x for _, x in full[j: j + 3])
            gone |= set(range(full[j][0], full[j + 2][0] + 1)) if window in seen else set()
            seen.add(window)
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        if left.split() or not gone:
            want[r["doc_id"]] = left
    assert {r["doc_id"]: r["text"] for r in after} == want
    before, after = stage["simhash_near_dedup"]
    fps = {r["doc_id"]: simhash.fingerprint(r["text"].encode(), 4) for r in before}
    ids = sorted(fps)
    groups = components_of(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4])
    assert sorted(r["doc_id"] for r in after) == sorted(set(groups.values()))
    kept = {r["doc_id"] for r in stage["benchmark_decontamination"][1]}
    assert {r["doc_id"] for r in stage["best_fit_packing"][1]} == kept
    pieces = lambda rows: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert pieces(corpus_pipeline.run(spark, SF).collect()) == pieces(stage["best_fit_packing"][1])


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
