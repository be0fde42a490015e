"""Quality classifier: supervised subword embeddings averaged per document, softmax output, numpy SGD.

A document's features are its words, the character n-grams of each word between the marks
``<`` and ``>``, and pairs of neighbouring words, all hashed into one table of vectors
(pairs of equal words share one vector).  The document's vector is the mean over all of
them, with repeats; a linear layer and softmax give class probabilities.  Vectors and layer
are learned together by stochastic gradient descent, one document a step.  For scoring the
layer is multiplied into the vectors, so a feature is one number per class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace, bounded_sample, id_share, mix, slices, split_words, utf8, word_hashes

#: Feature space: 2 ** BITS vectors.
BITS = 20
#: Lengths of the character n-grams.
GRAMS = (3, 4, 5)
SAME_WORD = np.uint64(0x51ED270B0A1F39C5)


@dataclass(frozen=True)
class Model:
    """Per class: the weight of each trained feature bucket, and the bias.  Buckets that training never met weigh 0."""

    classes: tuple
    buckets: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def dense(self) -> np.ndarray:
        full = np.zeros((len(self.classes), 1 << BITS), np.float32)
        full[:, self.buckets] = self.weights
        return full


# --- features -------------------------------------------------------------------------------

def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - BITS)).astype(np.int64)


def subwords(words: list[bytes], block: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(word index, bucket)`` of the character n-grams of ``<word>``, some ``block`` bytes of words at a time."""
    lo = 0
    upto = np.cumsum([len(w) + 2 for w in words])
    while lo < len(words):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + block, side="right")))
        points = np.frombuffer((b"<" + b"><".join(words[lo:hi]) + b">").decode(errors="replace").encode("utf-32-le"), np.uint32)
        # marks at word edges: no word holds white space, so edges are found by the words' own lengths
        length = np.array([len(w.decode(errors="replace")) + 2 for w in words[lo:hi]])
        word = np.repeat(np.arange(lo, hi), length)
        h = np.zeros(len(points), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            size = len(points) - n + 1
            if size <= 0:
                break
            h = h[:size] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:].astype(np.uint64) + np.uint64(1)
            if n in GRAMS:
                inside = word[:size] == word[n - 1:]
                yield word[:size][inside], _bucket(h[inside] + np.uint64(n))
        lo = hi


def features(texts: list[bytes | None]) -> tuple:
    """``(first, word, word bucket, words, pair bucket, pair doc)``.

    ``first``: each text's first word (and the end).  ``word``: every occurrence's number
    among the distinct ``words``, whose own buckets are ``word bucket``.
    """
    data, starts, ends, first = split_words(texts, lower=False)
    h = word_hashes(data, starts, ends)
    distinct, at, word = np.unique(h, return_index=True, return_inverse=True)
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    inside = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
    left, right = h[inside], h[inside + 1]
    pair = np.where(left == right, SAME_WORD, left * np.uint64(0xD6E8FEB86659FD93) + right)
    return first, word, _bucket(distinct), words, _bucket(pair), doc[inside]


def document_counts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, bucket, count)`` of all features, by text and bucket."""
    first, word, own, words, pair, pair_doc = features(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    key, times = np.unique(doc * max(1, len(words)) + word, return_counts=True)        # distinct words of each text
    d, w = key // max(1, len(words)), key % max(1, len(words))
    keys, counts = [d << BITS | own[w], pair_doc << BITS | pair], [times, np.ones(len(pair), np.int64)]
    by_word = np.argsort(w, kind="stable")
    edges = np.searchsorted(w[by_word], np.arange(len(words) + 1))
    for gram_word, bucket in subwords(words):
        reach = np.diff(edges)[gram_word]                                              # texts that hold the word
        spread = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(edges[gram_word], reach)
        held = by_word[spread]
        keys.append(d[held] << BITS | np.repeat(bucket, reach))
        counts.append(times[held])
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.bincount(inverse, np.concatenate(counts), len(key)).astype(np.int64)
    return key >> BITS, key & ((1 << BITS) - 1), count


# --- training -------------------------------------------------------------------------------

def forward(vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray, bucket: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A document's mean vector and class probabilities; ``share``: each bucket's part of its features."""
    hidden = share @ vectors[bucket]
    z = hidden @ layer + bias
    e = np.exp(z - z.max())
    return hidden, e / e.sum()


def sgd_step(vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray, bucket: np.ndarray, share: np.ndarray, target: int, rate: float) -> float:
    """One step down the cross-entropy of one document, in place; returns its loss before the step."""
    hidden, p = forward(vectors, layer, bias, bucket, share)
    error = p.copy()
    error[target] -= 1
    back = layer @ error
    layer -= rate * np.outer(hidden, error)
    bias -= rate * error
    vectors[bucket] -= rate * np.outer(share, back)
    return float(-np.log(max(p[target], 1e-300)))


def fit(lists: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, classes: tuple, dim: int = 8, epochs: int = 6,
        rate: float = 2.0, seed: int = 1) -> Model:
    """Vectors and layer from documents ``(bucket, count)`` and their class numbers; the rate falls linearly to 0."""
    rng = np.random.default_rng(seed)
    touched = np.unique(np.concatenate([b for b, _ in lists])) if lists else np.zeros(0, np.int64)
    vectors = rng.uniform(-1 / dim, 1 / dim, (len(touched), dim))
    layer, bias = np.zeros((dim, len(classes))), np.zeros(len(classes))
    rows = [(np.searchsorted(touched, b).astype(np.int32), (c / c.sum()).astype(np.float32)) for b, c in lists]
    total, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            if len(rows[i][0]):
                sgd_step(vectors, layer, bias, *rows[i], int(targets[i]), rate * (1 - step / total))
            step += 1
    return Model(classes, touched, (vectors @ layer).T.astype(np.float32), bias)


def train(docs: DataFrame, labels: DataFrame, fold: Column, sample: int = 2000, sample_features: int = 6_000_000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> Model | None:
    """Fit on about ``sample`` labelled documents with at most ``sample_features`` (bucket, count) pairs.

    These are the documented bounds of what the driver holds.  ``fold``: a condition over
    ``id``; labels outside it are never read.  Documents are taken by the smallest hashes of
    their ids, one text (the first in order) per id.  An id with several labels has the
    largest; NULL labels and ids are ignored.  None: no labelled document.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
             .where(fold).groupBy("id").agg(F.max("label").alias("label")))
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct().join(known, "id")
    ws = Workspace(docs.sparkSession)
    # bounded by ``sample``: safe to broadcast
    chosen = F.broadcast(ws.stage("sample", id_share(ids, sample)))
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(chosen, "id")
             .groupBy("id", "label").agg(F.min("text").alias("text")))
    rows = ws.stage("features", texts.mapInArrow(_feature_rows, f"id {ids.schema['id'].dataType.simpleString()}, "
                                                 f"label {known.schema['label'].dataType.simpleString()}, buckets array<int>, counts array<int>"))
    table = bounded_sample(rows, F.size("buckets"), sample_features)
    ws.drop("sample", "features")
    if not table.num_rows:
        return None
    labels_of = table.column("label").to_pylist()
    classes = tuple(sorted(set(labels_of)))
    flat = [table.column(c).combine_chunks() for c in ("buckets", "counts")]
    offsets = np.asarray(flat[0].offsets) - flat[0].offsets[0].as_py()
    buckets, counts = (np.asarray(f.flatten()) for f in flat)
    lists = [(buckets[a:b], counts[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return fit(lists, np.array([classes.index(x) for x in labels_of]), classes, **options)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            doc, bucket, count = document_counts(utf8(part.column("text")))
            offsets = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (bucket, count)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), *lists], ["id", "label", "buckets", "counts"])


# --- scoring --------------------------------------------------------------------------------

def probabilities(model: Model, weights: np.ndarray, texts: list[bytes | None]) -> np.ndarray:
    """Class probabilities of whole texts, a row each; a text without a word gets the bias's."""
    first, word, own, words, pair, pair_doc = features(texts)
    n = len(texts)
    doc = np.repeat(np.arange(n), np.diff(first))
    value, size = weights[:, own].astype(np.float64), np.ones(len(words))
    for gram_word, bucket in subwords(words):
        size += np.bincount(gram_word, minlength=len(words))
        for c in range(len(weights)):
            value[c] += np.bincount(gram_word, weights[c, bucket], len(words))
    count = np.bincount(doc, size[word], n) + np.bincount(pair_doc, minlength=n)
    z = np.stack([(np.bincount(doc, v[word], n) + np.bincount(pair_doc, w[pair], n)) / np.maximum(count, 1) + b
                  for v, w, b in zip(value, weights, model.bias)], 1)
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def score(docs: DataFrame, model: Model | None, positive=1, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``score_col``, the probability of class ``positive`` for the whole text.

    Without a model, or if training met no document of that class, every score is 0.
    """
    if model is None or positive not in model.classes:
        return docs.withColumn(score_col, F.lit(0.0))
    # plain arrays: broadcast values are read without this library
    shared = docs.sparkSession.sparkContext.broadcast((model.classes, model.buckets, model.weights, model.bias))
    return docs.withColumn(score_col, F.pandas_udf(_scorer(shared, model.classes.index(positive)), "double")(F.col(text_col)))


def _scorer(shared, at: int):
    import pandas as pd

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Model(*shared.value)
        weights = model.dense()
        for part in parts:
            batch = pa.RecordBatch.from_arrays([pa.array(part, pa.string(), from_pandas=True)], ["text"])
            found = [probabilities(model, weights, utf8(s.column("text")))[:, at] for s in slices(batch, "text", 4 << 20)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return run


def quality(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, cut: float = 0.3, id_col: str = "doc_id",
            text_col: str = "text", **options) -> DataFrame:
    """``row`` (all columns of ``docs``), ``held_out``, ``score`` and ``predicted`` (1 if score >= ``cut``).

    ``held_out``: condition over ``id`` whose labels are never learned (default: crc32 of the
    id's text divisible by 5).  NULL, empty and blank texts get the score of the bias alone.
    Repeated rows get equal scores; a NULL id is not held out.  An empty table gives an
    empty one; without labels every score is 0.
    """
    rule = held_out if held_out is not None else F.crc32(F.col("id").cast("string")) % 5 == 0
    model = train(docs, labels, ~rule, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = score(rows, model)
    return scored.select("row", F.coalesce(rule, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))
