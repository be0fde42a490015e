"""Licence scan: probes with near relatives, a plain version of the whole scan, needed terms, inheritance at the root."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from test_operators import SF, sentence

from memberpulse.llm import license_scan

FSF = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU {}General Public License as "
       "published by\n# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.")
PROBES = [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("GNU General Public License, version 2", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
    ("This work is licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    ("GNU Affero General Public License version 3", "AGPL-3.0"),
    ("SPDX: GPL-2.0", "GPL-2.0"), ("SPDX: BSD-2-Clause", "BSD-2-Clause"), ("SPDX: Apache-1.1", "Apache-1.1"), ("SPDX: MIT", "MIT"),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("SPDX-License-Identifier: ISC", "ISC"), ("SPDX-License-Identifier: CC-BY-SA-3.0", "CC-BY-SA-3.0"),
    ("Licensed under CC BY 4.0", "CC-BY-4.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
    ("Licensed under the Mozilla Public License, version 1.1", "MPL-1.1"),
    (FSF.format("", 3), "GPL-3.0"), (FSF.format("", 2), "GPL-2.0"), (FSF.format("Affero ", 3), "AGPL-3.0"),
    ("    Apache License\n   Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\n   TERMS", "Apache-2.0"),
    ("Released under\nthe MIT\nLicense", "MIT"),
    # no licence, or none that could be told
    ("this code is not released under the MIT License", None), ("It was never licensed under the Apache License, Version 2.0", None),
    ("GNU General Public License", None), ("Apache License", None), ("Released under the Foo License", None),
    ("we like the general public and version 2.0 of the software", None), ("numbers 2 0 3 1 4 0 2 1 0 2 0", None),
]


@pytest.fixture(scope="module")
def scanned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "concat('c/', doc_id) AS path", "text")
    probes = spark.createDataFrame([(10 ** 6 + i, f"p/{i}", f"intro words\n{text}\nmore words of code") for i, (text, _) in enumerate(PROBES)],
                                   "doc_id bigint, path string, text string")
    files = docs.union(probes)
    return files.collect(), license_scan.license_scan(files).collect()


def test_relatives_are_told_apart(scanned):
    got = {r["doc_id"]: r["own_license"] for r in scanned[1]}
    assert [(t, got[10 ** 6 + i]) for i, (t, _) in enumerate(PROBES)] == PROBES


def plain_scan(files: list, threshold: float = 0.75, margin: float = 0.02) -> dict:
    """Every rule of the scan in loops over whole texts."""
    words_of = {r["doc_id"]: re.findall("[a-z0-9]+", r["text"].lower()) for r in files if r["text"] is not None}
    df, n = Counter(t for ws in words_of.values() for t in set(ws)), len(files)
    idf = lambda t: math.log((1 + n) / (1 + df[t])) + 1
    tells = lambda t: t.isdigit() or t in license_scan.VARIANTS
    found: dict = {}
    for name, text in license_scan.TEMPLATES:
        order = re.findall("[a-z0-9]+", text.lower())
        raw = {t: (order.count(t) * idf(t)) ** 2 for t in order}
        tell, rest = sum(w for t, w in raw.items() if tells(t)), sum(w for t, w in raw.items() if not tells(t))
        factor = math.sqrt(rest / tell) if tell and rest else 1.0
        vector = {t: order.count(t) * idf(t) * (factor if tells(t) else 1) for t in order}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        left, needed = norm ** 2, set()
        for t in sorted(vector, key=lambda t: (-vector[t] ** 2 / norm ** 2 / (1 + df[t]), t)):
            if left < (threshold * norm) ** 2 * (1 - 1e-9):
                break
            needed.add(t)
            left -= vector[t] ** 2
        extra = math.ceil(len(order) / 4)
        for doc, words in words_of.items():
            for place, term in enumerate(words):
                if term not in needed:
                    continue
                for at in [i for i, t in enumerate(order) if t == term]:
                    for start, size in [(place - at, len(order))] + [(place - at - e, len(order) + extra) for e in range(extra + 1)]:
                        start = max(0, start)
                        window = words[start: start + size]
                        own = {t: window.count(t) * idf(t) * (factor if tells(t) else 1) for t in window}
                        score = round(sum(w * vector.get(t, 0) for t, w in own.items()) / norm / math.sqrt(sum(w * w for w in own.values())), 6)
                        if score >= threshold:
                            lead = next(i for i, t in enumerate(window) if t in vector)
                            ahead = (words[max(0, start - 2): start] + window[:lead])[-2:]
                            meant = not set(ahead) & set(license_scan.DENIALS)
                            best = found.setdefault((doc, place), {})
                            best[name] = max(best.get(name, (0, False)), (score, meant))
    out: dict = {}
    for (doc, _), rivals in found.items():
        (score, meant, name), *others = sorted(((s, m, name) for name, (s, m) in rivals.items()), reverse=True)
        if meant and not (others and others[0][0] >= score - margin):
            out.setdefault(doc, []).append((-score, name))
    return {doc: (min(v)[1], -min(v)[0]) for doc, v in out.items()}


def test_scan_equals_a_plain_version(scanned):
    files, got = scanned
    want = plain_scan(files)
    for r in got:
        licence, score = want.get(r["doc_id"], (None, None))
        assert r["own_license"] == licence, r["doc_id"]
        assert r["own_score"] == (None if score is None else pytest.approx(score, abs=2e-6))
    assert sum(r["own_license"] is not None for r in got) > 25


def test_windows_without_a_needed_term_cannot_reach_the_threshold():
    """Vectors without the needed terms have a smaller cosine, whatever else they hold."""
    rng = random.Random(2)
    terms = sorted({t for _, text in license_scan.TEMPLATES for t in re.findall("[a-z0-9]+", text.lower())})
    df = {t: rng.randrange(0, 1000) for t in terms}
    vectors = license_scan.template_vectors(license_scan.TEMPLATES, {t: math.log(1001 / (1 + df[t])) + 1 for t in terms})
    for v in vectors:
        needed = license_scan.needed_terms(v, 0.75, df)
        assert sum(w for t, w in v.squared.items() if t not in needed) < 0.75 ** 2
        assert abs(sum(v.squared.values()) - 1) < 1e-9


def test_no_join_of_all_pairs(spark):
    docs = spark.createDataFrame([(i, f"r/{i}", sentence(random.Random(i), 20)) for i in range(20)], "doc_id bigint, path string, text string")
    vectors = license_scan.template_vectors(license_scan.TEMPLATES[:20], {t: 1.0 for _, x in license_scan.TEMPLATES for t in re.findall("[a-z0-9]+", x.lower())})
    plan = license_scan.windows(docs.selectExpr("doc_id AS key", "text"), vectors, 0.75, {})._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
