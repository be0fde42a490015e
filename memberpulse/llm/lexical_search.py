"""Ranked lexical search of a query set against all documents by dense blocked matrix products.

Documents become sparse impacts over the terms of the query items (one pass over the texts,
staged); counts over that table give every term's weight.  Then tiles of documents meet
tiles of items: an item tile has a compact vocabulary, the terms of its items, and both
sides are laid out densely over slices of it and multiplied by BLAS in float64.  A slice is
narrow enough that no partial sum reaches 2^53, so each product is exact; slices are added
as 64-bit integers.  Every task keeps the best documents of each item, equal scores told
apart by id, and two rounds of ranks merge the tasks' lists.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace, slices, utf8, word_hashes

#: Bytes of terms after lower-casing A-Z: digits, letters and everything beyond ASCII.
TERM_BYTE = np.zeros(256, dtype=bool)
TERM_BYTE[48:58] = TERM_BYTE[97:123] = TERM_BYTE[128:] = True
#: Documents, items and terms of a tile: 16 MB, 2 MB and 1 MB for the two factors and the product.
DOC_TILE, ITEM_TILE, TERM_TILE = 1024, 128, 2048
#: Items of one pass over the documents' impacts; more are searched in further passes.
BLOCK_ITEMS = 4096
#: No impact exceeds this: (SCALE * tf) div (1000 * tf + ...).
SCALE, IMPACT_BOUND = 1_000_000_000, 1_000_000


# --- terms ----------------------------------------------------------------------------------

def term_spans(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of many texts at once: joined lower-cased bytes, starts, ends, each text's first term (and the end)."""
    data = np.frombuffer((b" ".join(t or b"" for t in texts) + b" ").lower(), np.uint8)
    inside = np.concatenate(([False], TERM_BYTE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    offsets = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    return data, edges[0::2], edges[1::2], np.searchsorted(edges[0::2], offsets)


def terms_of(text: str | None) -> list[str]:
    data, starts, ends, _ = term_spans([(text or "").encode()])
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]


class Vocabulary:
    """Terms by number; finds byte ranges by hash and then compares their bytes, so no hash is trusted."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(t) for t in raw], dtype=np.int64)
        hashes = word_hashes(self.data, ends - [len(t) for t in raw], ends) if raw else np.zeros(0, np.uint64)
        # terms with one hash, if any, are told apart in turn
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.number = hashes[order], order
        self.starts, self.ends = (ends - [len(t) for t in raw])[order] if raw else ends, ends[order]
        same = np.diff(np.flatnonzero(np.concatenate(([True], self.hashes[1:] != self.hashes[:-1], [True])))) if raw else [1]
        self.twins = int(max(same))

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of every byte range's term, -1 for others."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.hashes) or not len(starts):
            return out
        h = word_hashes(data, starts, ends)
        low = np.searchsorted(self.hashes, h)
        for twin in range(self.twins):
            at = np.minimum(low + twin, len(self.hashes) - 1)
            hit = np.flatnonzero((self.hashes[at] == h) & (self.ends[at] - self.starts[at] == ends - starts) & (out < 0))
            out[hit] = np.where(self._equal(data, starts[hit], at[hit]), self.number[at[hit]], -1)
        return out

    def _equal(self, data: np.ndarray, starts: np.ndarray, at: np.ndarray, block: int = 1 << 16) -> np.ndarray:
        equal = np.ones(len(starts), bool)
        for lo in range(0, len(starts), block):
            part = slice(lo, lo + block)
            length = self.ends[at[part]] - self.starts[at[part]]
            first = np.cumsum(length) - length
            within = np.arange(length.sum()) - np.repeat(first, length)
            same = data[within + np.repeat(starts[part], length)] == self.data[within + np.repeat(self.starts[at[part]], length)]
            equal[part] = np.logical_and.reduceat(same, first) if len(first) else True
        return equal


def impacts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``(id, n, terms, counts)`` of each document ``(id, text)`` with a term: its length, its item terms and how often it has each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(terms)
        for batch in batches:
            for part in slices(batch, "text"):
                data, starts, ends, first = term_spans(utf8(part.column("text")))
                number = known.find(data, starts, ends)
                hit = np.flatnonzero(number >= 0)
                doc = np.searchsorted(first, hit, side="right") - 1
                pair, count = np.unique(doc * len(terms) + number[hit], return_counts=True)
                n = np.diff(first)
                kept = np.flatnonzero(n)
                edges = np.searchsorted(pair // max(1, len(terms)), np.append(kept, part.num_rows))
                offsets = pa.array(edges, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(kept)), pa.array(n[kept].astype(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array((pair % max(1, len(terms))).astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32)))], ["id", "n", "terms", "counts"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {id_type}, n bigint, terms array<int>, counts array<int>")


# --- tiles ----------------------------------------------------------------------------------

def weight(n_docs: int, df: int) -> int:
    """A term's integer weight; never negative."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths_norm(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """``m`` of each document length: 100 - 50 + (50 * n * N) div L, exactly."""
    if len(n) and int(n.max()) * 50 * n_docs >= 1 << 62:
        return np.array([50 + 50 * int(x) * n_docs // total for x in n], np.int64)
    return 50 + 50 * n * n_docs // total


@dataclass(frozen=True)
class Block:
    """Query items by number: ``terms[starts[i]:starts[i + 1]]`` are item i's term numbers; ``weights`` by term."""

    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def width(self) -> int:
        """Terms of a slice whose weighted impacts can't add up to 2^53."""
        heaviest = max(1, int(self.weights.max(initial=1)))
        return max(1, min(TERM_TILE, ((1 << 53) - 1) // (heaviest * IMPACT_BOUND)))

    def tiles(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(first item, last item, vocabulary, item column, term row)`` of every item tile."""
        for lo in range(0, len(self.starts) - 1, ITEM_TILE):
            hi = min(lo + ITEM_TILE, len(self.starts) - 1)
            held = self.terms[self.starts[lo]: self.starts[hi]]
            column = np.repeat(np.arange(hi - lo), np.diff(self.starts[lo: hi + 1]))
            vocabulary, row = np.unique(held, return_inverse=True)
            yield lo, hi, vocabulary, column, row


def tile_scores(block: Block, lists: np.ndarray, terms: np.ndarray, impact: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(first item, scores)`` of a document tile for each item tile; ``lists``: each document's first impact (and the end)."""
    n, width = len(lists) - 1, block.width()
    doc = np.repeat(np.arange(n), np.diff(lists))
    for lo, hi, vocabulary, column, row in block.tiles():
        at = np.searchsorted(vocabulary, terms)
        inside = vocabulary[np.minimum(at, len(vocabulary) - 1)] == terms if len(vocabulary) else np.zeros(len(terms), bool)
        d, at, value = doc[inside], at[inside], impact[inside]
        total = np.zeros((n, hi - lo), np.int64)
        for first in range(0, len(vocabulary), width):
            size = min(width, len(vocabulary) - first)
            mine = (at >= first) & (at < first + size)
            if not mine.any():
                continue
            left = np.zeros((n, size))
            left[d[mine], at[mine] - first] = value[mine]
            held = (row >= first) & (row < first + size)
            right = np.zeros((size, hi - lo))
            right[row[held] - first, column[held]] = block.weights[vocabulary[row[held]]]
            total += (left @ right).astype(np.int64)
        yield lo, total


class Best:
    """The ``k`` best documents of each item so far: higher scores, then smaller ids, NULL ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)             # a score of 0 is no hit
        self.item, self.score, self.place = (np.zeros(0, np.int64) for _ in range(3))
        self.ids: pa.Array | None = None

    def add(self, item: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        if not len(item):
            return
        ids = pa.concat_arrays([self.ids, ids]) if self.ids is not None else ids
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        # ids are compared by Arrow, whatever their type; NULLs come last
        by_id = np.empty(len(ids), np.int64)
        by_id[np.asarray(pc.sort_indices(ids, null_placement="at_end"))] = np.arange(len(ids))
        order = np.lexsort((by_id, -score, item))
        first = np.searchsorted(item[order], item[order])
        order = order[np.arange(len(order)) - first < self.k]
        self.item, self.score, self.ids = item[order], score[order], ids.take(pa.array(order))
        full = np.flatnonzero(np.bincount(self.item, minlength=len(self.floor)) == self.k)
        last = np.searchsorted(self.item, full, side="right") - 1
        self.floor[full] = self.score[last]


def search_block(postings: DataFrame, block: Block, item_ids: pa.Array, item_type: str, n_docs: int, total: int, k: int) -> DataFrame:
    """``(item_id, id, score)``: every task's ``k`` best documents of each item of the block."""
    # plain arrays: broadcast values are read without this library
    shared = postings.sparkSession.sparkContext.broadcast((block.starts, block.terms, block.weights, item_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *arrays, names = shared.value
        items = Block(*arrays)
        best = Best(len(names), k)
        for batch in batches:
            for lo in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(lo, DOC_TILE)
                lists = part.column("terms")
                offsets = np.asarray(lists.offsets).astype(np.int64)
                tf = np.asarray(part.column("counts").flatten()).astype(np.int64)
                m = np.repeat(lengths_norm(np.asarray(part.column("n")), n_docs, total), np.diff(offsets))
                found = []
                for first, scores in tile_scores(items, offsets - offsets[0], np.asarray(lists.flatten()), SCALE * tf // (1000 * tf + 20 * m)):
                    doc, item = np.nonzero(scores >= best.floor[first: first + scores.shape[1]])
                    found.append((item + first, scores[doc, item], doc))
                item, score, doc = (np.concatenate(c) for c in zip(*found))
                best.add(item, score, part.column("id").take(pa.array(doc)))
        if best.ids is not None:
            yield pa.RecordBatch.from_arrays([names.take(pa.array(best.item)), best.ids, pa.array(best.score)], ["item_id", "id", "score"])

    id_type = postings.schema["id"].dataType.simpleString()
    return postings.mapInArrow(run, f"item_id {item_type}, id {id_type}, score bigint")


def merged(found: DataFrame, k: int, parts: int) -> DataFrame:
    """The ``k`` best of each item over all tasks, as ``rank``: first among groups of tasks, then among the groups."""
    order = (F.col("score").desc(), F.col("id").asc_nulls_last())
    salted = found.withColumn("group", F.spark_partition_id() % max(1, math.isqrt(parts)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "group").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k).select(
        "item_id", "rank", "id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 50, block_items: int = BLOCK_ITEMS, id_col: str = "doc_id",
                   text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every item, by integer scores.

    A document's score sums over the item's distinct terms the term's weight times its
    impact (saturating in the count, falling with the document's length).  Only scores above
    0 are hits.  Equal scores rank by id, NULL ids last.  Repeated rows are documents of
    their own, each with a rank; NULL, empty and termless texts are none.  Rows of
    ``items`` with one id are one item with all their terms, NULL ids too; items without a
    term have no rows.  No document or no item: an empty table.  Other columns are ignored.

    Items are searched in blocks of about ``block_items``, chosen by the id's hash; a
    block's items and their terms are held by the driver and every task.
    """
    ws = Workspace(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    queries = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text IS NOT NULL")
    blocks = -(-queries.count() // block_items)
    item_type, id_type = (f.dataType.simpleString() for f in (queries.schema["item_id"], rows.schema["id"]))
    result = None
    for number in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).toArrow()
        terms, block, names = item_block(mine)
        if not terms:
            continue
        postings = ws.stage(f"impacts_{number}", impacts(rows, terms))
        n_docs, total = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(map(tuple, postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))   # a row per item term
        weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(terms))], np.float64)
        parts = postings.rdd.getNumPartitions()
        found = merged(search_block(postings, Block(block.starts, block.terms, weights), names, item_type, n_docs, total, k), k, parts)
        found = ws.stage(f"best_{number}", found)                    # at most k rows an item
        ws.drop(f"impacts_{number}")
        result = found if result is None else result.union(found)
    if result is None:
        result = docs.sparkSession.createDataFrame([], f"item_id {item_type}, rank int, id {id_type}, score bigint")
    return result.select(F.col("item_id").alias(item_id), "rank", F.col("id").alias(id_col), "score")


def item_block(table: pa.Table) -> tuple[list[str], Block, pa.Array]:
    """Terms by number, items over them (weights to come) and the items' ids."""
    held: dict = {}
    for name, text in zip(table.column("item_id").to_pylist(), table.column("text").to_pylist()):
        held.setdefault(name, set()).update(terms_of(text))
    terms = sorted(set().union(*held.values()))
    number = {t: i for i, t in enumerate(terms)}
    lists = [sorted(number[t] for t in found) for found in held.values()]
    block = Block(np.cumsum([0] + [len(x) for x in lists]), np.array([t for x in lists for t in x], np.int64), np.zeros(len(terms)))
    return terms, block, pa.array(list(held), table.schema.field("item_id").type)
