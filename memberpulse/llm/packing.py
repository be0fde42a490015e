"""Best-fit packing of tokenised documents into fixed-length sequences, certified by lower bounds.

Every partition packs its pieces by best-fit decreasing and computes a lower bound on its
bin count from dual-feasible functions.  A partition that meets its bound is certified;
the others put the pieces of their unfilled bins (and certified ones those of their
emptiest bin) into a common pool, which is dealt out anew and packed again, as long as the
total falls and stays above the bound of the whole input.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace, slices

#: Pieces packed together in one task.
PART_PIECES = 20_000
#: Any other character sends its text through the slower library (see ``Encoder``).
PLAIN = re.compile("[^\x00-\x1b\x20-\x7e\xa1-ɏ‐-‧‰-⁞€]")


# --- tokens ---------------------------------------------------------------------------------

class Encoder:
    """The ids that ``tokenizers`` gives a text with its settings of the file and ``add_special_tokens=False``.

    ``ranks_path`` names the same vocabulary as merge ranks; that library gives equal ids
    several times faster and serves texts of Latin letters and common punctuation, where
    both libraries' character classes are the same.  All other texts go through
    ``tokenizers`` itself, as do texts that hold the string of one of its added tokens (one
    id there, which the ranks don't have), and all texts when ``ranks_path`` is None.
    """

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str):
        from tokenizers import Tokenizer

        self._slow, self._fast = Tokenizer.from_file(json_path), None
        added = [re.escape(t.content) for t in self._slow.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(added), re.IGNORECASE) if added else None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self._fast is not None and not PLAIN.search(text) and not (self._added and self._added.search(text)):
            return self._fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)


def public_bpe() -> dict:
    """Arguments of ``Encoder`` for the installed public byte-level vocabulary, found on the executor."""
    import public_tokenizers as P

    return {"json_path": P.path("byte_bpe_50k.json"), "ranks_path": P.path("byte_bpe_50k.tiktoken"), "pattern": P.PATTERN}


def cut(total: int, capacity: int) -> np.ndarray:
    """Starts of the pieces of ``total`` ids: all but the first piece have ``capacity`` ids."""
    first = (total - 1) % capacity + 1
    return np.concatenate(([0], np.arange(first, total, capacity)))


def token_pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary=public_bpe, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` of every document's ids followed by ``end_id``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(**vocabulary())
        for batch in batches:
            for part in slices(batch, "text"):
                row, piece, start, length, crc = [], [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = np.append(encode(text) if text else np.zeros(0, np.uint32), end_id).astype("<u4")
                    starts = cut(len(ids), capacity)
                    ends = np.append(starts[1:], len(ids))
                    row += [i] * len(starts)
                    piece += range(len(starts))
                    start += starts.tolist()
                    length += (ends - starts).tolist()
                    crc += [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint")


# --- bounds and best fit --------------------------------------------------------------------

def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Least bins for ``counts[x]`` items of each size ``x``: the best of three families of dual-feasible functions."""
    x = np.arange(capacity + 1)
    counts = counts.astype(object) if counts.sum() > 1 << 40 else counts.astype(np.int64)
    best = -(-int((counts * x).sum()) // capacity)
    for t in range(1, capacity // 2 + 1):
        rounded = np.where(x > capacity - t, capacity, np.where(x < t, 0, x))
        best = max(best, -(-int((counts * rounded).sum()) // capacity))
        m = capacity // t
        share = np.where(2 * x > capacity, m - (capacity - x) // t, np.where(x < t, 0, 1))
        best = max(best, -(-int((counts * share).sum()) // m))
    for k in range(1, 33):
        exact = (k + 1) * x % capacity == 0
        scaled = np.where(exact, k * x, (k + 1) * x // capacity * capacity)     # in units of 1 / (k * capacity)
        best = max(best, -(-int((counts * scaled).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bin, offset)`` of every item, given in falling order, and every bin's fill.

    Open bins are stacked by free space; one integer marks the non-empty stacks, so the
    tightest fit is its lowest set bit from the item's size on.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    marks, fill, where, offset = 0, [], [], []
    for size in lengths.tolist():
        fitting = marks >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            chosen = stacks[free].pop()
            if not stacks[free]:
                marks ^= 1 << free
        else:
            free, chosen = capacity, len(fill)
            fill.append(0)
        where.append(chosen)
        offset.append(fill[chosen])
        fill[chosen] += size
        free -= size
        if free:
            stacks[free].append(chosen)
            marks |= 1 << free
    return np.array(where, np.int64), np.array(offset, np.int64), np.array(fill, np.int64)


def _pack(capacity: int, level: int):
    """Arrow function: pack one partition; a row per piece, with its bin's fill and the partition's certificate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by(
            [("length", "descending"), ("id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = np.asarray(table.column("length"))
        where, offset, fill = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        base = (level << 52) | (TaskContext.get().partitionId() << 28)
        emptiest = where == int(fill.argmin())
        again = fill[where] < capacity if len(fill) > bound else emptiest & (fill[where] < capacity)
        n = len(lengths)
        columns = {"sequence_id": where + base, "offset": offset, "pooled": again,
                   "bins": np.full(n, len(fill)), "bound": np.full(n, bound), "leads": offset == 0}
        for name, values in columns.items():
            table = table.append_column(name, pa.array(values))
        yield from table.combine_chunks().to_batches()
    return run


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary=public_bpe, rounds: int = 6,
                   part_pieces: int = PART_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for every piece of every document.

    NULL and empty texts are the end id alone.  Every row of ``docs`` is packed, repeated
    rows and NULL ids too; other columns are ignored.  No row: an empty table.  Full pieces
    are sequences of their own.
    """
    ws = Workspace(docs.sparkSession)
    pieces = ws.stage("pieces", token_pieces(docs, capacity, end_id, vocabulary, id_col, text_col))
    columns = ["id", "piece", "start", "length", "ids_crc32"]
    full = pieces.where(F.col("length") == capacity).select(
        *columns, (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    accepted, settled, pool = [full], 0, pieces.where(F.col("length") < capacity)
    sizes = pool.groupBy("length").count().collect()                  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in sizes:
        counts[r["length"]] = r["count"]
    goal, n, before = lower_bound(counts, capacity), int(counts.sum()), None
    schema = pool.schema.simpleString()[7:-1] + ",sequence_id:bigint,offset:bigint,pooled:boolean,bins:bigint,bound:bigint,leads:boolean"
    for level in range(rounds if n else 0):
        parts = -(-n // part_pieces)
        dealt = pool.repartition(parts, F.xxhash64("id", "piece", "ids_crc32", F.lit(level)))
        packed = ws.stage(f"packed_{level}", dealt.mapInArrow(_pack(capacity, level), schema.replace(":", " ")))
        bins, n, again = packed.agg(F.count_if("leads"), F.count_if("pooled"), F.count_if(F.col("leads") & F.col("pooled"))).first()
        if before is not None and settled + bins >= before[0]:
            accepted.append(before[1])                                # no gain: the pool keeps its former bins
            pool = None
            break
        if settled + bins == goal or not n or level == rounds - 1:
            accepted.append(packed.select(*columns, "sequence_id", "offset"))
            break
        accepted.append(packed.where("NOT pooled").select(*columns, "sequence_id", "offset"))
        before = (settled + bins, packed.where("pooled").select(*columns, "sequence_id", "offset"))
        settled += bins - again
        pool = packed.where("pooled").select(*columns)
    result = accepted[0]
    for part in accepted[1:]:
        result = result.union(part)
    return result.withColumnRenamed("id", id_col)
