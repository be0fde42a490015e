"""Licence scan: sparse TF-IDF cosine of term windows to templates, then inheritance from the nearest directory.

No Python on the data path.  Templates are the names, SPDX lines and header sentences of
common licences together with their near relatives, so that the nearest one decides;
windows run over line breaks.  Document frequencies of all terms come from all files.  In
every template the terms that tell versions and variants apart carry half of the weight, on
both sides of the comparison: a notice of another version is far from it.  Where two
licences are nearly as close, or the notice is denied, none is given.

A window can only reach the threshold if it holds one of a template's heaviest terms at its
place (the others together are too light): the places of those terms are joined with the
templates that need them, exactly.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace, row_key

# SPDX identifiers and names of common licences.
LICENCES = (
    ("Apache-1.1", "Apache Software License, Version 1.1"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Artistic-2.0", "Artistic License 2.0"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("CC0-1.0", "CC0 1.0"),
    ("CC-BY-3.0", "CC BY 3.0"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-3.0", "CC BY-SA 3.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-3.0", "CC BY-NC 3.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-SA-3.0", "CC BY-NC-SA 3.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
    ("EPL-1.0", "Eclipse Public License, version 1.0"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("MIT", "MIT License"),
    ("MPL-1.1", "Mozilla Public License, version 1.1"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("Unlicense", "Unlicense"),
    ("Zlib", "zlib License"),
)
# Sentences that name a licence ({name}, {id}).
PHRASES = ("SPDX-License-Identifier: {id}", "SPDX: {id}", "Licensed under the {name}", "Released under the {name}",
           "This work is licensed under the {name}")
# Header notices and the heads of licence texts.
_FSF = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
        "the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-1.1", "The Apache Software License, Version 1.1 Copyright (c) 2000 The Apache Software Foundation. All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following 2 conditions are met"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following 3 conditions are met"),
    ("GPL-2.0", _FSF.format("General Public License", 2)),
    ("GPL-3.0", _FSF.format("General Public License", 3)),
    ("LGPL-2.1", _FSF.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", _FSF.format("Lesser General Public License", 3)),
    ("AGPL-3.0", _FSF.format("Affero General Public License", 3)),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software"),
)
# Terms besides numbers that tell relatives apart, and words that deny the notice that follows.
VARIANTS = ("lesser", "affero", "nc", "sa", "nd", "lgpl", "agpl", "software")
DENIALS = ("not", "never", "nor", "neither")
#: Base names of licence files, whose licence holds for their directory.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([-._].*)?$"
TERM = "[a-z0-9]+"
GAP = "[^a-z0-9]+"
#: Share of a template's squared weight that its telling terms have.
TELLING = 0.5


def templates_of(licences=LICENCES, phrases=PHRASES, notices=NOTICES) -> tuple[tuple[str, str], ...]:
    """``(licence, text)``: every phrase about every licence, and the notices."""
    made = [(i, p.format(id=i, name=name)) for i, name in licences for p in phrases]
    return tuple(dict.fromkeys(made + list(notices)))


TEMPLATES = templates_of()


def _terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def telling(term: str) -> bool:
    """Numbers and the names of variants: what two relatives differ in."""
    return term.isdigit() or term in VARIANTS


@dataclass(frozen=True)
class Template:
    """A unit vector of squared weights by term, the factor of its telling terms and its terms in order."""

    licence: str
    squared: dict[str, float]
    factor: float
    order: tuple[str, ...]

    def size(self) -> int:
        return len(self.order)


def template_vectors(templates, idf: dict[str, float]) -> list[Template]:
    """Vectors of the templates; telling terms, where there are some, are scaled to ``TELLING`` of the squared weight."""
    out = []
    for name, text in templates:
        words = _terms(text)
        raw = {t: (words.count(t) * idf[t]) ** 2 for t in words}
        tell, rest = (sum(w for t, w in raw.items() if telling(t) is k) for k in (True, False))
        factor = math.sqrt(TELLING / (1 - TELLING) * rest / tell) if tell and rest else 1.0
        scaled = {t: w * (factor ** 2 if telling(t) else 1.0) for t, w in raw.items()}
        norm = sum(scaled.values())
        out.append(Template(name, {t: w / norm for t, w in scaled.items()}, factor, tuple(words)))
    return out


def needed_terms(template: Template, threshold: float, df: dict[str, int]) -> list[str]:
    """Terms of which a window within ``threshold`` of the template must hold one.

    The remaining terms have a squared weight below the threshold's square; a window that
    shares only those has a smaller cosine, whatever else it holds.  Heavy terms of few
    documents come first, so that few places have to be looked at.
    """
    left, needed = 1.0, []
    for term, weight in sorted(template.squared.items(), key=lambda x: (-x[1] / (1 + df.get(x[0], 0)), x[0])):
        if left < threshold * threshold * (1 - 1e-9):
            break
        needed.append(term)
        left -= weight
    return needed


def term_counts(files: DataFrame, text_col: str) -> DataFrame:
    """``(term, df)``: in how many texts each term occurs, over all files."""
    terms = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), GAP))
    return files.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def any_term(terms: set[str]) -> str:
    """A pattern that finds one of the ``terms`` in lower-case text; terms of one first letter share a branch."""
    by_letter: dict[str, list[str]] = {}
    for t in sorted(terms):
        by_letter.setdefault(t[0], []).append(t[1:])
    branches = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_letter.items())
    return rf"(?<![a-z0-9])(?=[{''.join(by_letter) or '-'}])(?:{branches or '-'})(?![a-z0-9])"


def windows(files: DataFrame, vectors: list[Template], threshold: float, df: dict[str, int]) -> DataFrame:
    """``(key, place, template, window, denied)``: runs of a text's terms that may reach ``threshold`` with a template.

    ``files`` is ``(key, text)``.  For every place of a needed term the window begins as many
    terms before it as the template has; windows of a quarter more terms, with others in
    between, begin at up to as many places before that.  ``denied``: a denial stands within
    two terms before the first term that the window shares.
    """
    spark, least = files.sparkSession, threshold * threshold * (1 - 1e-9)
    needed = [needed_terms(v, threshold, df) for v in vectors]
    pattern = any_term({t for ts in needed for t in ts})
    anchors, cuts = [], []
    for i, v in enumerate(vectors):
        extra = math.ceil(v.size() / 4)
        for at, term in enumerate(v.order):
            if term in needed[i]:
                spans = [(at, v.size())] + [(at + e, v.size() + extra) for e in range(extra + 1)]
                anchors += [(term, i, before, size) for before, size in spans]
    for i, v in enumerate(vectors):
        cuts.append((i, sorted(v.squared.items())))
    # both hold some rows a template
    anchors = F.broadcast(spark.createDataFrame(anchors, "term string, template int, before int, size int").distinct())
    weights = F.broadcast(spark.createDataFrame(cuts, "template int, weights array<struct<term: string, w: double>>"))
    held = files.where(F.lower("text").rlike(pattern)).select("key", F.array_remove(F.split(F.lower("text"), GAP), "").alias("terms"))
    placed = held.select("key", "terms", F.posexplode("terms").alias("place", "term")).join(anchors, "term")
    start = F.greatest(F.lit(0), F.col("place") - F.col("before"))
    cut = placed.select("key", "place", "template", F.slice("terms", start + 1, F.col("size")).alias("window"),
                        F.slice("terms", F.greatest(F.lit(0), start - 2) + 1, F.least(F.lit(2), start)).alias("before"))
    mine = F.filter("weights", lambda x: F.array_contains("window", x["term"]))
    shared = F.aggregate(mine, F.lit(0.0), lambda a, x: a + x["w"])
    own = F.transform("weights", lambda x: x["term"])
    near = cut.join(weights, "template").where(shared >= least)
    lead = F.array_position(F.transform("window", lambda x: F.array_contains(own, x)), True)
    ahead = F.concat("before", F.slice("window", 1, F.greatest(F.lit(0), lead.cast("int") - 1)))
    last = F.slice(ahead, F.greatest(F.lit(1), F.size(ahead) - 1), 2)
    return near.select("key", "place", "template", "window", F.arrays_overlap(last, F.array(*map(F.lit, DENIALS))).alias("denied"))


def scores(held: DataFrame, vectors: list[Template], counts: DataFrame, idf: dict[str, float], n: int, threshold: float) -> DataFrame:
    """``(template, window, score)`` of every distinct window that reaches ``threshold``.

    Templates' own terms, which most windows hold, get their weights by broadcast; the others
    are joined with ``counts``.
    """
    spark = held.sparkSession
    terms = (held.select("template", "window").distinct().select("template", "window", F.explode("window").alias("term"))
             .groupBy("template", "window", "term").agg(F.count("*").alias("tf")))
    # some rows a template
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))
    others = terms.join(known, "term", "left_anti")
    weighed = others.select("term").distinct().join(counts, "term").select("term", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    terms = terms.join(known, "term").unionByName(others.join(weighed, "term"))
    factors = F.broadcast(spark.createDataFrame([(i, v.factor) for i, v in enumerate(vectors)], "template int, factor double"))
    table = F.broadcast(spark.createDataFrame([(i, t, math.sqrt(w)) for i, v in enumerate(vectors) for t, w in sorted(v.squared.items())],
                                              "template int, term string, w double"))
    tells = F.col("term").rlike("^[0-9]+$") | F.col("term").isin(*VARIANTS)
    v = F.col("tf") * F.col("idf") * F.when(tells, F.col("factor")).otherwise(1.0)
    rows = terms.join(factors, "template").join(table, ["template", "term"], "left").select(
        "template", "window", v.alias("v"), F.coalesce("w", F.lit(0.0)).alias("w"))
    return rows.groupBy("template", "window").agg(F.round(
        F.sum(F.col("v") * F.col("w")) / F.sqrt(F.sum(F.col("v") * F.col("v"))), 6).alias("score")).where(F.col("score") >= threshold)


def own_licences(held: DataFrame, scored: DataFrame, vectors: list[Template], margin: float) -> DataFrame:
    """``(key, licence, score)``: every file's best notice.

    The windows around one place compete: the best licence there counts if no other is
    within ``margin`` of it and its window isn't denied.  Of the places the best counts;
    ties: the first licence name.
    """
    names = F.broadcast(held.sparkSession.createDataFrame([(i, v.licence) for i, v in enumerate(vectors)], "template int, licence string"))
    found = held.join(scored, ["template", "window"]).join(names, "template")
    each = found.groupBy("key", "place", "licence").agg(F.max(F.struct("score", (~F.col("denied")).alias("meant"))).alias("best"))
    # one row a licence, of which there are few
    rivals = each.groupBy("key", "place").agg(F.sort_array(F.collect_list(F.struct(
        F.col("best.score").alias("score"), F.col("best.meant").alias("meant"), "licence")), asc=False).alias("r"))
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    clear = rivals.where(first["meant"] & (F.coalesce(second["score"], F.lit(0.0)) < first["score"] - margin))
    best = clear.groupBy("key").agg(F.min(F.struct((-first["score"]).alias("less"), first["licence"].alias("licence"))).alias("best"))
    return best.select("key", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("score"))


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def nearest_folder(folders: DataFrame, licensed: DataFrame) -> DataFrame:
    """``(folder, inherited, inherited_from)``: the licence of the nearest licensed ancestor, the folder itself included.

    ``folders(folder)`` are distinct, so a folder with many files is joined once; a path
    of depth d gives d + 1 ancestors.
    """
    parts = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).select(
        "folder", "depth", F.array_join(F.slice(F.split("folder", "/"), 1, F.col("depth")), "/").alias("ancestor")).where(
        "folder <> '' OR depth = 0")
    found = above.join(licensed, above.ancestor == licensed.at).groupBy("folder").agg(
        F.max(F.struct("depth", "inherited", "ancestor")).alias("best"))
    return found.select("folder", F.col("best.inherited").alias("inherited"), F.col("best.ancestor").alias("inherited_from"))


def license_scan(files: DataFrame, templates=TEMPLATES, threshold: float = 0.75, margin: float = 0.02, id_col: str = "doc_id",
                 path_col: str = "path", text_col: str = "text") -> DataFrame:
    """``(doc_id, path, own_license, own_score, license, inherited_from)`` of every file.

    ``own_license``: the template of highest cosine with a run of the file's terms, of about
    the template's length, if at least ``threshold`` and more than ``margin`` above those of
    other licences at that place, and if the notice isn't denied.  Files named like a
    licence file give their folder its licence (several in one folder: the highest score,
    then the first name).  ``license``: the file's own, else that of the nearest folder
    above; ``inherited_from`` is that folder (empty text: the root).  NULL and empty texts
    have no own licence; a NULL path inherits none and gives none.  Repeated rows get equal
    results; other columns are ignored.
    """
    ws = Workspace(files.sparkSession)
    texts = files.select(row_key(id_col, path_col, text_col).alias("key"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    n, counts = files.count(), ws.stage("counts", term_counts(files, text_col))
    wanted = sorted({t for _, text in templates for t in _terms(text)})
    df = {r["term"]: r["df"] for r in counts.where(F.col("term").isin(wanted)).collect()}      # one row per template term
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in wanted}
    vectors = template_vectors(templates, idf)
    held = ws.stage("windows", windows(texts, vectors, threshold, df))
    scored = ws.stage("scores", scores(held, vectors, counts, idf, n, threshold))
    own = ws.stage("own", own_licences(held, scored, vectors, margin))
    ws.drop("windows", "scores", "counts")
    key = row_key(id_col, path_col, text_col).alias("key")
    rows = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), key, _folder(F.col(path_col)).alias("folder"))
    rows = rows.join(own, "key", "left").select("id", "path", "folder", "licence", "score")
    named = F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE)
    licensed = rows.where(named & F.col("licence").isNotNull()).groupBy(F.col("folder").alias("at")).agg(
        F.min(F.struct((-F.col("score")).alias("less"), "licence")).alias("best")).select("at", F.col("best.licence").alias("inherited"))
    folders = rows.where("path IS NOT NULL").select("folder").distinct()
    near = ws.stage("folders", nearest_folder(folders, licensed))
    result = rows.join(near, "folder", "left")
    inherits = F.col("licence").isNull()
    return result.select(
        F.col("id").alias(id_col), F.col("path").alias(path_col), F.col("licence").alias("own_license"), F.col("score").alias("own_score"),
        F.coalesce("licence", "inherited").alias("license"), F.when(inherits, F.col("inherited_from")).alias("inherited_from"))
