"""SimHash near-duplicates: 64-bit fingerprints linked within a Hamming radius, bit-sliced comparison.

Candidates come from block tables: the 64 bits are cut into ``blocks`` blocks; two
fingerprints within ``radius`` differing bits agree on at least ``blocks - radius`` of
them, so each choice of that many blocks is one table and no link is lost.  Inside a
bucket, bit planes are stored vertically (one bit position of 64 fingerprints per
machine word) and 64 distances at a time are counted with carry-save adders; a block of
lanes is abandoned once every lane exceeds the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from memberpulse.llm.common import KEY, Workspace, row_key, slices, utf8
from memberpulse.llm.components import connected_components, forest

BITS = 64
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Larger buckets are cut into cells of this many fingerprints, spread over tasks.
CELL = 4096


# --- fingerprints ---------------------------------------------------------------------------

def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of one text: bit set if set in over half of the shingles' XXH64 (seed 42); no word: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1:].tolist()
    else:
        starts, ends = [0], [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[s:e], 42) for s, e in zip(starts, ends)], np.uint64, len(starts))
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo: lo + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, fp)`` for every row: its id, row key and fingerprint as a signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fps = np.array([fingerprint(t, shingle) for t in utf8(part.column("text"))], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.array(fps.view(np.int64))], ["id", "key", "fp"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")
                       ).mapInArrow(run, f"id {id_type}, key {KEY}, fp bigint")


# --- bit-sliced comparison ------------------------------------------------------------------

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """``(64, ceil(n / 64))`` words: lane ``i`` of plane ``b`` is bit ``b`` of fingerprint ``i``."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return _pack(bits)


def _pack(bits: np.ndarray) -> np.ndarray:
    lanes = bits.shape[-1]
    padded = np.zeros((*bits.shape[:-1], -(-lanes // BITS) * BITS), np.uint8)
    padded[..., :lanes] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


def query_masks(fps: np.ndarray) -> np.ndarray:
    """``(64, n)``: all ones where a query's bit is set, else zero."""
    shifts = np.arange(BITS, dtype=np.uint64)[:, None]
    return np.where((fps[None, :] >> shifts) & np.uint64(1), ONES, np.uint64(0))


def within(planes: np.ndarray, masks: np.ndarray, radius: int) -> np.ndarray:
    """Lanes at distance <= ``radius``: planes ``(64, *S)`` against masks ``(64, *T)``, broadcast.

    Three difference planes at a time go through a full adder; its sum and carry are added
    to a bitwise counter of ``digits`` planes per lane, whose overflow is sticky.
    """
    digits = (radius + 1).bit_length()
    shape = np.broadcast_shapes(planes.shape[1:], masks.shape[1:])
    counter = [np.zeros(shape, np.uint64) for _ in range(digits)]
    over = np.zeros(shape, np.uint64)

    def add(bit: np.ndarray, digit: int) -> None:
        nonlocal over
        for k in range(digit, digits):
            counter[k], bit = counter[k] ^ bit, counter[k] & bit
        over |= bit

    for b in range(0, BITS, 3):
        x = planes[b] ^ masks[b]
        if b + 2 < BITS:
            y, z = planes[b + 1] ^ masks[b + 1], planes[b + 2] ^ masks[b + 2]
            half = x ^ y
            add((x & y) | (half & z), 1)
            x = half ^ z
        add(x, 0)
        if b in (30, 45) and not (~(over | _exceeds(counter, radius))).any():
            return np.zeros(shape, np.uint64)     # abandon: every lane is beyond the radius
    return ~(over | _exceeds(counter, radius))


def _exceeds(counter: list[np.ndarray], radius: int) -> np.ndarray:
    greater, equal = np.uint64(0), ONES
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal = equal & counter[k]
        else:
            greater = greater | (equal & counter[k])
            equal = equal & ~counter[k]
    return greater


def link_small(groups: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside groups of up to 64 fingerprints, one machine word per group."""
    out_a, out_b = [], []
    for lo in range(0, len(groups), 1024):
        part = groups[lo: lo + 1024]
        width = max(map(len, part))
        table = np.zeros((len(part), BITS), np.uint64)
        lanes = np.zeros(len(part), np.uint64)
        for g, fps in enumerate(part):
            table[g, : len(fps)] = fps
            lanes[g] = ONES >> np.uint64(BITS - len(fps))
        planes = bit_planes(table.reshape(-1)).reshape(BITS, 1, len(part))
        masks = query_masks(table[:, :width].T.reshape(-1)).reshape(BITS, width, len(part))
        hits = within(planes, masks, radius) & lanes
        later = ONES << np.arange(1, width + 1, dtype=np.uint64)     # lanes after the query: each pair once
        if width == BITS:
            later[-1] = 0
        hits &= later[:, None]
        query, group = np.nonzero(hits)
        bits = np.unpackbits(hits[query, group].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(bits)
        inside = np.array([len(p) for p in part])[group[row]] > query[row]
        row, lane = row[inside], lane[inside]
        out_a.append(table[group[row], query[row]])
        out_b.append(table[group[row], lane])
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def link_large(fps: np.ndarray, radius: int, seeds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of a large group: each fingerprint queries the lanes that no component holds yet.

    ``seeds``: only the first that many rows start a search (rows of the other side of a
    cell pair are reached, and then query too).
    """
    rest = np.arange(len(fps))
    queue: list[np.ndarray] = []
    out_a, out_b, start = [], [], 0
    limit = len(fps) if seeds is None else seeds
    open_rows = np.ones(len(fps), bool)
    while True:
        if not queue:
            while start < limit and not open_rows[start]:
                start += 1
            if start >= limit:
                break
            open_rows[start] = False
            queue = [np.array([start])]
            rest = np.flatnonzero(open_rows)
        queries, queue = queue[0], queue[1:]
        for lo in range(0, len(queries), BITS):
            q = queries[lo: lo + BITS]
            masks = query_masks(fps[q])[:, :, None]
            for at in range(0, len(rest), 64 * BITS):
                lanes = rest[at: at + 64 * BITS]
                hits = within(bit_planes(fps[lanes])[:, None, :], masks, radius)
                bits = np.unpackbits(hits.view(np.uint8).reshape(len(q), -1), axis=1, bitorder="little")[:, : len(lanes)]
                found = np.flatnonzero(bits.any(0) & open_rows[lanes])
                if len(found):
                    out_a.append(fps[q[bits[:, found].argmax(0)]])
                    out_b.append(fps[lanes[found]])
                    open_rows[lanes[found]] = False
                    queue.append(lanes[found])
            rest = rest[open_rows[rest]]
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


# --- candidate tables -----------------------------------------------------------------------

def table_masks(radius: int, blocks: int) -> list[int]:
    """Bit masks of the block tables: every choice of ``blocks - radius`` of the ``blocks`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(block, blocks - radius)]


def blocks_for(n: int, radius: int) -> int:
    """Smallest block count whose keys are at least as many as the ``n`` fingerprints."""
    blocks = radius + 1
    while (1 << (BITS * (blocks - radius) // blocks)) < n and blocks < 2 * radius + 4:
        blocks += 1
    return blocks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _links_of_buckets(radius: int, has_side: bool):
    """Arrow function over rows sorted by bucket: spanning links of each bucket's fingerprints."""
    def emit(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        a, b = forest(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def links(bucket: np.ndarray, fps: np.ndarray, side: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]).any(1), [True])))
        sizes = np.diff(edges)
        small = [fps[edges[g]: edges[g + 1]] for g in np.flatnonzero((sizes > 1) & (sizes <= BITS))] if not has_side else []
        for lo in range(0, len(small), 1 << 15):
            a, b = link_small(small[lo: lo + (1 << 15)], radius)
            if len(a):
                yield emit(a, b)
        for g in np.flatnonzero(sizes > (0 if has_side else BITS)):
            part = slice(edges[g], edges[g + 1])
            a, b = link_large(fps[part], radius, int(side[part].sum()) if has_side else None)
            if len(a):
                yield emit(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            cols = [np.asarray(batch.column(c)) for c in ("t", "key", "cell", "fp", "side")]
            bucket, fps, side = np.stack(cols[:3], 1).astype(np.int64), cols[3].astype(np.int64).view(np.uint64), cols[4]
            if not len(fps):
                continue
            last = np.flatnonzero((bucket != bucket[-1]).any(1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut or (held and (held[-1][0][-1] != bucket[0]).any()):
                parts = [*held, (bucket[:cut], fps[:cut], side[:cut])]
                yield from links(*(np.concatenate(x) for x in zip(*parts)))
                held = []
            held.append((bucket[cut:], fps[cut:], side[cut:]))
        if held:
            yield from links(*(np.concatenate(x) for x in zip(*held)))
    return run


def near_links(fps: DataFrame, radius: int, ws: Workspace, blocks: int | None = None, cell: int = CELL) -> DataFrame:
    """Links ``(a, b)`` that join the same components as all pairs of distinct ``fp`` within ``radius`` bits.

    A task emits a star for each component that it finds, at most one link per fingerprint.

    ``blocks`` defaults to the smallest number that gives as many bucket keys as
    fingerprints, so that buckets of spread fingerprints stay small at any input size.
    A bucket beyond ``cell`` rows is cut: rows near its smallest fingerprint link to that
    one directly and need no comparison among themselves; all other pairs of cells are
    compared, each pair of cells in a task of its own.
    """
    masks = table_masks(radius, blocks or blocks_for(fps.count(), radius))
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for t, m in enumerate(masks)])).alias("k")).select("k.t", "k.key", "fp")
    hot = ws.stage("hot_buckets", keyed.groupBy("t", "key").agg(
        F.count("*").alias("n"), F.min("fp").alias("leader")).where(F.col("n") > cell))
    plain, links = keyed, []
    if not hot.isEmpty():
        plain = keyed.join(hot, ["t", "key"], "left_anti")
        rows = keyed.join(hot, ["t", "key"]).withColumn(
            "near", F.bit_count(F.col("fp").bitwiseXOR(F.col("leader"))) <= radius)
        links.append(rows.where("near and fp <> leader").select(F.col("fp").alias("a"), F.col("leader").alias("b")))
        links.append(_cell_links(rows, radius, cell))
    first = _bucket_rows(plain.select("*", F.lit(0).alias("cell"), F.lit(True).alias("side"))).mapInArrow(
        _links_of_buckets(radius, False), "a bigint, b bigint")
    for other in links:
        first = first.union(other)
    return first


def _bucket_rows(rows: DataFrame) -> DataFrame:
    return rows.repartition("t", "key", "cell").sortWithinPartitions("t", "key", "cell", F.desc("side"), "fp")


def _cell_links(rows: DataFrame, radius: int, cell: int) -> DataFrame:
    """Links of hot buckets: each cell of far rows against itself, every other far cell and every near cell."""
    per = rows.groupBy("t", "key", "near").agg(F.count("*").alias("m")).groupBy("t", "key").agg(
        F.ceil(F.coalesce(F.sum(F.when(~F.col("near"), F.col("m"))), F.lit(0)) / cell).cast("int").alias("far_cells"),
        F.ceil(F.coalesce(F.sum(F.when(F.col("near"), F.col("m"))), F.lit(0)) / cell).cast("int").alias("near_cells"))
    at = F.pmod(F.xxhash64("fp"), F.when(F.col("near"), F.col("near_cells")).otherwise(F.col("far_cells"))).cast("int")
    placed = rows.join(per, ["t", "key"]).where("far_cells > 0").withColumn("at", at)
    total = F.col("far_cells") + F.col("near_cells")
    own = F.when(F.col("near"), F.col("far_cells") + F.col("at")).otherwise(F.col("at"))
    # cell (i, j): far cell i searches among the rows of cell j >= i (far) or of a near cell
    partner = F.when(F.col("near"), F.transform(F.sequence(F.lit(0), F.col("far_cells") - 1),
                                                lambda i: F.struct(i.alias("i"), own.alias("j"))))
    partner = partner.otherwise(F.transform(F.sequence(F.lit(0), total - 1), lambda j: F.struct(
        F.least(j, own).alias("i"), F.greatest(j, own).alias("j"))))
    cells = placed.select("t", "key", "fp", own.alias("own"), total.alias("total"), F.explode(partner).alias("c"))
    cells = cells.select("t", "key", "fp", (F.col("c.i") * F.col("total") + F.col("c.j")).cast("int").alias("cell"),
                         (F.col("own") == F.col("c.i")).alias("side"))
    return _bucket_rows(cells).mapInArrow(_links_of_buckets(radius, True), "a bigint, b bigint")


def simhash_groups(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
                   text_col: str = "text", blocks: int | None = None, cell: int = CELL) -> DataFrame:
    """``(doc_id, fingerprint, component_id, component, key)`` for every row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the
    smallest ``doc_id`` reachable over links, itself included.  NULL, empty and wordless
    texts have fingerprint zero, which links like any other.  A NULL ``doc_id`` takes part
    but is never a component's id (NULL only where a component has no id at all).
    Repeated rows are returned as often as given.  ``component`` names the group, ``key``
    the row's id and text.  Other columns are ignored.
    """
    ws = Workspace(docs.sparkSession)
    rows = ws.stage("fingerprints", fingerprints(docs, shingle, id_col, text_col))
    distinct = ws.stage("distinct", rows.groupBy("fp").agg(F.min("id").alias("least_id")))
    links = ws.stage("links", near_links(distinct.select("fp"), radius, ws, blocks, cell))
    found = connected_components(links, ws)
    grouped = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component"))
    ids = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labels = ws.stage("labels", grouped.join(ids, "component").select("fp", "component", "component_id"))
    ws.drop("links", "distinct", "hot_buckets")
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        "component", "key")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text",
             **options) -> DataFrame:
    """The rows of ``docs``, all their columns: of each group only the row with the smallest id stays.

    Ids that are NULL come last; rows of equal id and text are one row.
    """
    groups = simhash_groups(docs, shingle, radius, id_col, text_col, **options)
    chosen = groups.groupBy("component").agg(
        F.min(F.struct(F.col(id_col).isNull().alias("without"), F.col(id_col).alias("id"), "key")).alias("c"))
    whole = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("key"))
    kept = whole.join(chosen.select(F.col("c.key").alias("key")), "key", "left_semi")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return kept.withColumn("nth", nth).where("nth = 1").select("row.*")
