"""Toxicity by non-negative positive-unlabelled learning of a linear word model in numpy.

Confirmed toxic documents are the positives; a sample of all documents is the unlabelled
set, in which a share ``prior`` is toxic too.  The risk of calling unlabelled text clean is
corrected by that prior and kept from going negative (a step that would push it below zero
is reversed).  Features are a text's distinct words and the first bytes of longer words;
only those whose rate among the positives clearly exceeds that of the unlabelled set enter
the model, so noise words of long clean texts add nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace, bounded_sample, id_share, slices, utf8, word_hashes

#: Feature space: 2 ** FEATURE_BITS hash buckets.
FEATURE_BITS = 20
#: Words longer than this also give their first so many bytes as a feature.
PREFIX = 7

LETTER = np.zeros(256, dtype=bool)
LETTER[48:58] = LETTER[97:123] = LETTER[128:] = True


@dataclass(frozen=True)
class Model:
    """Weights of the selected feature buckets and the bias (log-odds of a text without any)."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        full = np.zeros(1 << FEATURE_BITS)
        full[self.buckets] = self.weights
        return full


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(text index, bucket)`` of the distinct words and word prefixes of every text, by text index."""
    joined = (b" ".join(t or b"" for t in texts) + b" ").lower()
    data = np.frombuffer(joined, np.uint8)
    inside = np.concatenate(([False], LETTER[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    doc = np.searchsorted(offsets, starts, side="right") - 1
    h = word_hashes(data, starts, ends)
    _, first = np.unique((doc.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)), return_index=True)
    starts, ends, doc, h = starts[first], ends[first], doc[first], h[first]
    longer = ends - starts > PREFIX
    prefix = word_hashes(data, starts[longer], starts[longer] + PREFIX) ^ np.uint64(0x5555555555555555)
    doc = np.concatenate([doc, doc[longer]])
    bucket = (np.concatenate([h, prefix]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    order = np.argsort(doc, kind="stable")
    return doc[order], bucket[order]


def fit_nnpu(doc: np.ndarray, bucket: np.ndarray, n: int, positive: np.ndarray, unlabelled: np.ndarray, prior: float,
             min_z: float = 5.0, min_docs: int = 3, steps: int = 200, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Non-negative PU risk minimisation by full-batch Adam over ``n`` texts' features.

    ``positive`` / ``unlabelled``: masks of texts.  A bucket is selected if it occurs in
    ``min_docs`` positives and its rate there exceeds the unlabelled rate by ``min_z``
    standard errors.
    """
    size = 1 << FEATURE_BITS
    pair = np.unique(doc.astype(np.int64) << FEATURE_BITS | bucket)
    d, b = pair >> FEATURE_BITS, pair & (size - 1)
    del pair
    n_pos, n_un = int(positive.sum()), int(unlabelled.sum())
    in_pos, in_un = np.bincount(b[positive[d]], minlength=size), np.bincount(b[unlabelled[d]], minlength=size)
    pooled = (in_pos + in_un) / (n_pos + n_un)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / n_pos + 1 / n_un))
    chosen = np.flatnonzero(((in_pos / n_pos - in_un / n_un) >= min_z * error) & (in_pos >= min_docs))
    column = np.full(size, -1)
    column[chosen] = np.arange(len(chosen))
    f = column[bucket]
    doc, f = doc[f >= 0], f[f >= 0]
    w = np.zeros(len(chosen) + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = w[-1] + np.bincount(doc, w[f], n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean_risk = np.logaddexp(0, z[unlabelled]).mean() - prior * np.logaddexp(0, z[positive]).mean()
        pull = np.zeros(n)
        if clean_risk >= 0:
            pull[unlabelled] += p[unlabelled] / n_un
            pull[positive] -= prior / n_pos      # toxic term (p - 1) less the correction p
        else:
            pull[unlabelled] -= p[unlabelled] / n_un
            pull[positive] += prior * p[positive] / n_pos
        grad = np.append(np.bincount(f, pull[doc], len(chosen)) + decay * w[:-1], pull.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(chosen, w[:-1], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, fold: Column, positives: int = 2000, unlabelled: int = 5000,
          sample_features: int = 6_000_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          least_prior: float = 1e-6, most_prior: float = 0.5, **fit) -> Model | None:
    """Fit on about ``positives`` confirmed toxic and ``unlabelled`` other documents, ``sample_features`` (text, bucket) pairs at most.

    These are the documented bounds of what the driver holds: a row per id (its first text
    in order, however many rows it has), and rows by the smallest hashes of their ids as
    long as their features fit.  ``fold``: a condition over ``id``; labels outside it are
    never read.  An id with several labels is toxic if one says so; NULL labels and ids are
    ignored.  ``prior`` is the toxic share of the labelled ids, held between ``least_prior``
    and ``most_prior`` (the risk needs a share in between; beyond a half, unlabelled text is
    no sample of clean text).  None: no confirmed toxic or no unlabelled document.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
             .where(fold).groupBy("id").agg(F.max("toxic").alias("toxic")))
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        return None
    prior = min(max(toxic / n, least_prior), most_prior)
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    pos = id_share(ids.join(known.where("toxic = 1"), "id", "left_semi"), positives).select("id", F.lit(True).alias("pos"))
    sample = id_share(ids, unlabelled).select("id", F.lit(True).alias("un")).join(pos, "id", "full").select(
        "id", F.coalesce("pos", F.lit(False)).alias("pos"), F.coalesce("un", F.lit(False)).alias("un"))
    ws = Workspace(docs.sparkSession)
    # bounded by the two parameters: safe to broadcast
    chosen = F.broadcast(ws.stage("sample", sample))
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id")
             .groupBy("id", "pos", "un").agg(F.min("text").alias("text")))
    rows = ws.stage("features", texts.select("pos", "un", "text", "id").mapInArrow(
        _feature_rows, "pos boolean, un boolean, id string, buckets array<int>"))
    table = bounded_sample(rows, F.size("buckets"), sample_features)
    ws.drop("sample", "features")
    lists = table.column("buckets").combine_chunks()
    counts = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    pos, un = (np.asarray(table.column(c)).astype(bool) for c in ("pos", "un"))
    if not pos.any() or not un.any():
        return None
    doc, bucket = np.repeat(np.arange(len(counts), dtype=np.int32), counts), np.asarray(lists.flatten())
    del table, lists
    return fit_nnpu(doc, bucket, len(counts), pos, un, prior, **fit)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            doc, bucket = features(utf8(part.column("text")))
            ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("pos"), part.column("un"), part.column("id").cast(pa.string()), lists],
                                             ["pos", "un", "id", "buckets"])


def score(docs: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``score_col``, the toxicity of the whole text from 0 to 1.

    NULL, empty and featureless texts get the model's base rate; without a model every
    score is 0.
    """
    if model is None:
        return docs.withColumn(score_col, F.lit(0.0))
    toxic = F.pandas_udf(_scorer(model), "double")
    return docs.withColumn(score_col, toxic(F.col(text_col)))


def _scorer(model: Model):
    import pandas as pd

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = model.dense()
        for part in parts:
            texts = [t.encode() if t is not None else None for t in part]
            out, lo, size = np.empty(len(texts)), 0, 0
            for hi in range(1, len(texts) + 1):
                size += len(texts[hi - 1] or b"")
                if size >= 8 << 20 or hi == len(texts):
                    doc, bucket = features(texts[lo:hi])
                    out[lo:hi] = model.bias + np.bincount(doc, weights[bucket], hi - lo)
                    lo, size = hi, 0
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return run


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, id_col: str = "doc_id",
             text_col: str = "text", **options) -> DataFrame:
    """All columns of ``docs`` plus ``held_out``, ``score`` and ``predicted`` (1 if score >= 0.5).

    ``held_out``: condition over ``id`` whose labels are never learned (default: crc32 of
    the id's text divisible by 5).  Repeated rows get equal scores; a NULL id is not held out.
    Columns of these three names in ``docs`` are replaced.
    """
    rule = held_out if held_out is not None else F.crc32(F.col("id").cast("string")) % 5 == 0
    model = train(docs, labels, ~rule, id_col=id_col, text_col=text_col, **options)
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    scored = score(docs.select(*kept), model, text_col)
    named = scored.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
    return named.select("row.*", F.coalesce(rule, F.lit(False)).alias("held_out")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
