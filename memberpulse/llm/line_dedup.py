"""Line dedup: repeated windows of consecutive lines, found globally, later occurrences removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import KEY, Workspace, row_key, slices, utf8


def _windows(text: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """``(hash high, hash low, first line, last line)`` of every window of ``size`` non-blank lines."""
    lines = [(i, xxhash.xxh3_128_digest(s)) for i, s in enumerate(map(bytes.strip, text.split(b"\n"))) if s]
    out = []
    for j in range(len(lines) - size + 1):
        h = xxhash.xxh3_128_digest(b"".join(d for _, d in lines[j: j + size]))
        out.append((int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True),
                    lines[j][0], lines[j + size - 1][0]))
    return out


def line_windows(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(hi, lo, id, key, first, last)``: the 128-bit hash of every window and the lines it spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [_windows(t or b"", size) for t in utf8(part.column("text"))]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.array([w for ws in found for w in ws], np.int64).reshape(-1, 4)
                at = pa.array(np.repeat(np.arange(len(found)), counts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat[:, 0]), pa.array(flat[:, 1]), part.column("id").take(at), part.column("key").take(at),
                     pa.array(flat[:, 2], pa.int32()), pa.array(flat[:, 3], pa.int32())],
                    ["hi", "lo", "id", "key", "first", "last"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")
                       ).mapInArrow(run, f"hi bigint, lo bigint, id {id_type}, key {KEY}, first int, last int")


#: A window with more than one in so many of all occurrences, and more than so many, is told its origin by broadcast.
SHARES, LEAST_SHARE = 10_000, 2_000


def later_occurrences(windows: DataFrame, ws: Workspace) -> DataFrame:
    """``(key, first, last)`` of every window occurrence but its first by (id, key, line).

    Occurrences of very common windows stay in their tasks: there are at most ``SHARES`` such
    windows, whatever the input's size.
    """
    place = F.struct("id", "key", "first")
    origin = windows.groupBy("hi", "lo").agg(F.min(place).alias("origin"), F.max(place).alias("final"), F.count("*").alias("n"))
    repeated = ws.stage("origins", origin.where("origin <> final").select("hi", "lo", "origin", "n"))
    share = max(LEAST_SHARE, windows.count() // SHARES)
    common, rest = repeated.where(F.col("n") > share), repeated.where(F.col("n") <= share)
    found = windows.join(F.broadcast(common), ["hi", "lo"]).unionByName(
        windows.join(F.broadcast(common.select("hi", "lo")), ["hi", "lo"], "left_anti").join(rest, ["hi", "lo"]))
    return found.where(~place.eqNullSafe(F.col("origin"))).select("key", "first", "last")


def _without(text: Column, spans: Column) -> tuple[Column, Column]:
    """The text without the lines of the sorted ``spans``, and the number of lines removed."""
    lines = F.split(text, "\n", -1)
    gap = lambda start, stop: F.struct(start.alias("start"), (stop - start).alias("size"))
    empty = F.array().cast("array<struct<start:int,size:int>>")

    def merge(acc: Column, s: Column) -> Column:
        gaps = F.when(s["first"] > acc["next"], F.concat(acc["gaps"], F.array(gap(acc["next"], s["first"])))).otherwise(acc["gaps"])
        return F.struct(gaps.alias("gaps"), F.greatest(acc["next"], s["last"] + 1).alias("next"))

    def close(acc: Column) -> Column:
        return F.concat(acc["gaps"], F.array(gap(acc["next"], F.size(lines))))

    kept = F.aggregate(spans, F.struct(empty.alias("gaps"), F.lit(0).alias("next")), merge, close)
    left = F.flatten(F.transform(kept, lambda g: F.slice(lines, g["start"] + 1, g["size"])))
    return F.array_join(left, "\n"), F.size(lines) - F.size(left)


def dedup_lines(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, with ``text_col`` cleaned, plus ``n_lines`` and ``n_removed``.

    Lines are split at ``\\n`` and compared without surrounding ASCII white space; windows
    are ``size`` consecutive non-blank lines.  Of equal windows the first by (id, line)
    stays; every other occurrence is covered, and the lines of merged covered spans go,
    blank ones inside a span included.  Texts with fewer non-blank lines than ``size`` and
    NULL texts (``n_lines`` 0) stay as they are.  A NULL id sorts first.  Repeated rows
    share their places, so they all stay or lose the same lines; a repeated id with another
    text is a document of its own.
    """
    ws = Workspace(docs.sparkSession)
    windows = ws.stage("windows", line_windows(docs, size, id_col, text_col))
    later = later_occurrences(windows, ws)
    spans = ws.stage("spans", later.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans")))
    ws.drop("windows", "origins")
    whole = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("key")).join(
        spans.hint("merge"), "key", "left")     # spans grow with the input: the same plan at every size
    text = F.col("row")[text_col]
    cleaned, removed = _without(text, F.col("spans"))
    hit = F.col("spans").isNotNull()
    whole = whole.select(
        "row", F.when(hit, cleaned).otherwise(text).alias("cleaned"),
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias("n_lines"),
        F.when(hit, removed).otherwise(0).cast("long").alias("n_removed"))
    kept = [F.col("cleaned").alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in docs.columns if c not in ("n_lines", "n_removed")]
    return whole.select(*kept, "n_lines", "n_removed")
