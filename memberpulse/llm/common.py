"""Helpers shared by the operators: staged tables, row keys, Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberpulse.session import shared_dir


_scopes: ContextVar[tuple[list[Workspace], ...]] = ContextVar("scopes", default=())


@contextmanager
def temporary_tables() -> Iterator[None]:
    """Inside, staged tables belong to the caller: all of them are removed at the end.

    An operator's lazy result reads tables that it has staged, so it is written or counted
    inside: ``with temporary_tables(): dedup_lines(docs).write.parquet(path)``.  Without it
    those tables stay under the shared folder.
    """
    opened: list[Workspace] = []
    token = _scopes.set((*_scopes.get(), opened))
    try:
        yield
    finally:
        _scopes.reset(token)
        for ws in opened:
            ws.close()


class Workspace:
    """Tables written to the cluster's shared folder by one operator call.

    ``stage`` cuts lineage with a Parquet table (a lost executor rereads it, nothing is
    recomputed); ``drop`` removes tables whose readers are finished, ``close`` all of them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = shared_dir(spark)
        if _scopes.get():
            _scopes.get()[-1].append(self)

    def close(self) -> None:
        remove(self.spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, self.path(name))

    def release(self) -> None:
        """Let Spark's cleaner remove the shuffle files of finished stages now.

        It removes those that the driver no longer refers to, but only learns of them when
        the driver's JVM collects garbage, which a mostly idle driver rarely does.  The last
        query is still referred to until another one takes its place.
        """
        self.spark.range(1).count()
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path in whatever store Spark reaches it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Type of :func:`row_key` where Arrow functions pass it on.
KEY = "struct<a: bigint, b: bigint>"


def row_key(*columns: str) -> Column:
    """128-bit key of a row's columns, as two hashes: defined for NULLs; repeated rows share it."""
    held = [F.col(c) for c in columns]
    return F.struct(F.xxhash64(*held).alias("a"), F.xxhash64(F.lit("second"), *held).alias("b"))


def id_share(ids: DataFrame, bound: int, id_col: str = "id") -> DataFrame:
    """The rows with the smallest id hashes, about ``bound`` distinct ids; all if there are fewer.  ``ids`` are distinct."""
    share = min(1.0, bound / max(1, ids.count()))
    return ids.where(F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))


def bounded_sample(rows: DataFrame, size: Column, bound: int, id_col: str = "id") -> pa.Table:
    """The rows with the smallest id hashes whose sizes add up to ``bound`` at most, in that order, on the driver.

    ``rows``: staged, one per id, some thousands.  Their sizes come first, so no more than
    the bound (but at least one row) is brought over.
    """
    order = F.xxhash64(id_col, F.lit("bound"))
    sizes = sorted(map(tuple, rows.select(order, size).collect()))
    upto = np.cumsum([s for _, s in sizes], dtype=np.int64)
    kept = max(1, int(np.searchsorted(upto, bound, side="right"))) if sizes else 0
    held = rows.withColumn("sample_order", order)
    if kept < len(sizes):
        held = held.where(F.col("sample_order") < sizes[kept][0])
    return held.toArrow().sort_by("sample_order").drop_columns(["sample_order"])


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices whose ``column`` holds about ``max_bytes`` (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), max_bytes, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit polynomial hash of each byte range ``[start, end)`` of ``data`` (ranges not empty).

    Works through about ``block`` bytes at a time, so the temporary arrays stay small.
    """
    lengths = ends - starts
    out = np.empty(len(starts), np.uint64)
    upto = np.cumsum(lengths)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + block, side="right")))
        part, first = lengths[lo:hi], upto[lo:hi] - lengths[lo:hi]
        within = np.arange(first[0], upto[hi - 1]) - np.repeat(first, part)
        power = np.cumprod(np.full(int(part.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
        values = (data[within + np.repeat(starts[lo:hi], part)].astype(np.uint64) + np.uint64(1)) * power[within]
        out[lo:hi] = np.add.reduceat(values, first - first[0])
        lo = hi
    return mix(out ^ (lengths.astype(np.uint64) << np.uint64(56)))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def split_words(texts: list[bytes | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space) of many texts at once.

    Returns the joined bytes, word starts, word ends and each text's first word index
    (one entry more than texts).  ``lower`` maps A-Z to a-z.
    """
    joined = b" ".join(t or b"" for t in texts) + b" "
    if lower:
        joined = joined.lower()
    data = np.frombuffer(joined, dtype=np.uint8)
    inside = np.concatenate(([False], ~SPACE[data]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    return data, starts, ends, np.searchsorted(starts, offsets)
