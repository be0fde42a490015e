"""Language identification by a bidirectional GRU over bytes, trained in numpy by backpropagation through time.

The network reads segments: words with the space before and after them (cut at about
``SEGMENT`` bytes, between characters).  It labels every byte position with a distribution over languages;
a document's probabilities are the mean over all positions of its whole text.  Since a
segment's labels depend on its bytes alone, equal segments of a task are read once.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace, bounded_sample, slices, split_words, utf8, word_hashes

SEGMENT = 32
SPACE = 32
#: Segments whose results a task keeps between slices of its rows.
MEMO = 400_000


@dataclass(frozen=True)
class Network:
    """Per direction: byte table ``x`` (256, 3H), recurrent ``u`` (H, 3H), bias ``c`` (H); output ``o`` (2H, K), ``b`` (K)."""

    x: np.ndarray
    u: np.ndarray
    c: np.ndarray
    o: np.ndarray
    b: np.ndarray
    langs: tuple[str, ...]


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * a) + 0.5


def _direction(bytes_: np.ndarray, inside: np.ndarray, x: np.ndarray, u: np.ndarray, c: np.ndarray, keep: bool):
    """GRU states over the columns of ``bytes_`` (n, T); the state waits at positions outside a segment."""
    n, steps = bytes_.shape
    size = u.shape[0]
    h = np.zeros((n, size), np.float32)
    states, tape = np.empty((steps, n, size), np.float32), []
    for t in range(steps):
        a, r = x[bytes_[:, t]], h @ u
        gates = _sigmoid(a[:, : 2 * size] + r[:, : 2 * size])
        z, g = gates[:, :size], gates[:, size:]
        inner = r[:, 2 * size:] + c
        new = np.tanh(a[:, 2 * size:] + g * inner)
        mask = inside[:, t, None]
        following = np.where(mask, new + z * (h - new), h)
        if keep:
            tape.append((h, z, g, inner, new, mask))
        states[t] = h = following
    return states, tape


def _backward(bytes_: np.ndarray, d_states: np.ndarray, tape: list, x: np.ndarray, u: np.ndarray):
    """Gradients of one direction by backpropagation through time."""
    steps, n, size = d_states.shape
    dx, du, dc = np.zeros_like(x), np.zeros_like(u), np.zeros(size, np.float32)
    dh, values = np.zeros((n, size), np.float32), np.arange(len(x))
    for t in reversed(range(steps)):
        h, z, g, inner, new, mask = tape[t]
        dh = dh + d_states[t]
        live = dh * mask
        d_new = live * (1 - z) * (1 - new * new)
        d_z = live * (h - new) * z * (1 - z)
        d_g = d_new * inner * g * (1 - g)
        d_a = np.concatenate([d_z, d_g, d_new], 1)
        d_r = np.concatenate([d_z, d_g, d_new * g], 1)
        dx += (bytes_[:, t, None] == values).astype(np.float32).T @ d_a
        du += h.T @ d_r
        dc += (d_new * g).sum(0)
        dh = dh * ~mask + live * z + d_r @ u.T
    return dx, du, dc


def _reverse(bytes_: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Column order that reverses each row's segment and leaves its padding in place."""
    t = np.arange(bytes_.shape[1])
    return np.where(t < lengths[:, None], lengths[:, None] - 1 - t, t)


def label_positions(net: Network, bytes_: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """``(n, T, K)`` probabilities of every position's language, and what backpropagation needs."""
    inside = np.arange(bytes_.shape[1]) < lengths[:, None]
    back = _reverse(bytes_, lengths)
    turned = np.take_along_axis(bytes_, back, 1)
    ahead, tape_a = _direction(bytes_, inside, net.x[0], net.u[0], net.c[0], keep)
    behind, tape_b = _direction(turned, inside, net.x[1], net.u[1], net.c[1], keep)
    size = ahead.shape[2]
    both = np.concatenate([ahead.transpose(1, 0, 2), np.take_along_axis(behind.transpose(1, 0, 2), back[:, :, None], 1)], 2)
    logits = both @ net.o + net.b
    logits -= logits.max(2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(2, keepdims=True)
    return p, (inside, back, turned, tape_a, tape_b, both, size)


def _gradients(net: Network, bytes_: np.ndarray, lengths: np.ndarray, target: np.ndarray):
    """Mean cross-entropy over all positions and its gradients."""
    p, (inside, back, turned, tape_a, tape_b, both, size) = label_positions(net, bytes_, lengths, True)
    count = inside.sum()
    loss = -np.log(np.maximum(np.take_along_axis(p, target[:, None, None], 2)[..., 0], 1e-9))[inside].sum() / count
    d = p.copy()
    d[np.arange(len(target)), :, target] -= 1
    d *= inside[:, :, None] / np.float32(count)
    flat = d.reshape(-1, d.shape[2])
    do, db = both.reshape(len(flat), -1).T @ flat, flat.sum(0)
    d_both = d @ net.o.T
    d_behind = np.take_along_axis(d_both[:, :, size:], back[:, :, None], 1)
    ga = _backward(bytes_, d_both[:, :, :size].transpose(1, 0, 2), tape_a, net.x[0], net.u[0])
    gb = _backward(turned, d_behind.transpose(1, 0, 2), tape_b, net.x[1], net.u[1])
    return loss, [np.stack(pair) for pair in zip(ga, gb)] + [do, db]


def segments(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(data, start, end, text index)`` of every segment of the texts; starts and ends include the spaces around."""
    data, starts, ends, first = split_words([None if t is None else b" " + t for t in texts], lower=False)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    pieces = -(-(ends - starts) // SEGMENT)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(starts, pieces) + nth * SEGMENT
    for _ in range(3):                                               # cut between characters: at most three bytes on
        start += (nth > 0) & (data[np.minimum(start, len(data) - 1)] & 0xC0 == 0x80)
    last = np.append(nth[1:] == 0, True)[: len(nth)]
    end = np.where(last, np.repeat(ends, pieces), np.append(start[1:], 0)[: len(start)])
    full = end > start                                               # a last piece of continuation bytes alone is none
    return data, start[full] - 1, end[full] + 1, np.repeat(doc, pieces)[full]


def _matrix(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    width = int((end - start).max())
    at = start[:, None] + np.arange(width)
    bytes_ = data[np.minimum(at, len(data) - 1)]
    return np.where(at < end[:, None], bytes_, SPACE)


def fit(texts: list[bytes], langs: list[str], hidden: int = 12, steps: int = 700, batch: int = 384, rate: float = 0.01,
        seed: int = 7) -> Network:
    """Train by Adam on random segments, as many of each language in every batch."""
    names = tuple(sorted(set(langs)))
    rng = np.random.default_rng(seed)
    data, start, end, doc = segments(texts)
    of = np.array([names.index(name) for name in langs])[doc]
    pools = [np.flatnonzero(of == k) for k in range(len(names))]
    k = len(names)
    init = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    params = [init(2, 256, 3 * hidden), init(2, hidden, 3 * hidden), np.zeros((2, hidden), np.float32),
              init(2 * hidden, k), np.zeros(k, np.float32)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    each = max(1, batch // k)
    for t in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(pool, each) for pool in pools if len(pool)])
        lengths = end[chosen] - start[chosen]
        _, grads = _gradients(Network(*params, names), _matrix(data, start[chosen], end[chosen]), lengths, of[chosen])
        slow = rate * min(1.0, 2 * (1 - t / (steps + 1)))
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            params[i] = params[i] - np.float32(slow) * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return Network(*[p.astype(np.float32) for p in params], names)


def segment_sums(net: Network, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum over a segment's positions of their language probabilities, for every segment."""
    lengths = end - start
    order = np.argsort(lengths, kind="stable")
    out = np.empty((len(start), len(net.langs)), np.float32)
    for lo in range(0, len(order), 8192):
        part = order[lo: lo + 8192]
        p, (inside, *_) = label_positions(net, _matrix(data, start[part], end[part]), lengths[part])
        out[part] = (p * inside[:, :, None]).sum(1)
    return out


class Pool:
    """Mean position probabilities of whole texts; remembers segments between calls."""

    def __init__(self, net: Network):
        self.net = net
        self.keys, self.sums = np.zeros(0, np.uint64), np.zeros((0, len(net.langs)), np.float32)

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        data, start, end, doc = segments(texts)
        keys, first, inverse = np.unique(word_hashes(data, start, end), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        sums = np.empty((len(keys), len(self.net.langs)), np.float32)
        sums[known] = self.sums[at[known]] if known.any() else 0
        new = first[~known]
        if len(new):
            sums[~known] = segment_sums(self.net, data, start[new], end[new])
        if len(keys) > MEMO:
            self.keys, self.sums = np.zeros(0, np.uint64), self.sums[:0]
        elif len(self.keys) + len(new) > MEMO:
            self.keys, self.sums = keys, sums
        elif len(new):
            joined = np.concatenate([self.keys, keys[~known]])
            order = np.argsort(joined)
            self.keys, self.sums = joined[order], np.concatenate([self.sums, sums[~known]])[order]
        total = np.empty((len(texts), len(self.net.langs)))
        for k in range(total.shape[1]):
            total[:, k] = np.bincount(doc, sums[inverse, k], len(texts))
        positions = np.bincount(doc, end - start, len(texts))
        return total / np.maximum(positions, 1)[:, None]


LETTER = r"\p{L}"


def train(docs: DataFrame, fold: Column, sample_docs: int = 1600, sample_bytes: int = 32 << 20, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang", **options) -> Network | None:
    """Fit on about ``sample_docs`` labelled texts of ``sample_bytes`` at most, equally many of each language.

    These are the documented bounds of what the driver holds: one text (the first in order)
    per id and language, however many rows have them, by the smallest hashes of their ids as
    long as their bytes fit; a longer single text is taken whole.  ``fold``: condition over
    ``id`` of the rows that may be learned from.  None: no row of the fold has a language
    and a word.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        fold & F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    ids = known.select("id", "lang").distinct()
    counts = ids.groupBy("lang").count()
    each = F.lit(float(sample_docs)) / F.count("*").over(_all())
    shares = counts.select("lang", (each / F.col("count")).alias("share"))   # one row per language
    ws = Workspace(docs.sparkSession)
    chosen = ws.stage("sample", ids.join(F.broadcast(shares), "lang").where(
        F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("id", "lang"))
    # bounded by ``sample_docs``: safe to broadcast
    texts = ws.stage("texts", known.join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text")))
    table = bounded_sample(texts, F.octet_length("text"), sample_bytes)
    ws.drop("sample", "texts")
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("id", "text", "lang"))), key=lambda r: (str(r[0]), r[1], r[2]))
    if not rows:
        return None
    return fit([text.encode() for _, text, _ in rows], [lang for _, _, lang in rows], **options)


def _all():
    from pyspark.sql import Window

    return Window.partitionBy()


def identify(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row: the language of highest pooled probability, and that probability.

    ``und`` with score 0 for NULL texts, texts without a letter, and all texts if there is no network.
    """
    langs = np.array(net.langs if net else ("und",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = Pool(net) if net else None
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                letters = np.asarray(pc.fill_null(part.column("letter"), False)).astype(bool)
                if pool:
                    p = pool(utf8(part.column("text")))
                    best, score = langs[p.argmax(1)], np.clip(p.max(1), 0, 1)
                else:
                    best, score, letters = np.full(part.num_rows, "und"), np.zeros(part.num_rows), np.zeros(part.num_rows, bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.where(letters, best, "und").tolist(), pa.string()),
                     pa.array(np.where(letters, score, 0.0))], ["id", "lang_pred", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(text_col).rlike(LETTER).alias("letter")
                       ).mapInArrow(run, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)


def language_id(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs``.

    ``held_out``: condition over ``id`` whose rows are never learned from (default: crc32 of
    the id's text leaves 1 when divided by 3).  A NULL id is not held out, nor learned from.
    Repeated rows get equal results; other columns are ignored.
    """
    rule = held_out if held_out is not None else F.crc32(F.col("id").cast("string")) % 3 == 1
    net = train(docs, ~rule, id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    found = identify(docs, net, id_col, text_col).withColumnRenamed(id_col, "id")
    return found.select(F.col("id").alias(id_col), F.coalesce(rule, F.lit(False)).alias("held_out"), "lang_pred", "score")
