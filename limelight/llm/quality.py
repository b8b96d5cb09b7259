"""Quality classifier: a second-order factorisation machine.

score(x) = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the
pair term is computed in linear time as
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2).

Features: hashed lower-cased words (L2-normalised counts) and structure
statistics of the text. The model is fitted with mini-batch Adam on a bounded
sample of labelled rows (``max_train``, the rows of smallest hash of the id);
scoring reads every whole text.

Defined cases: null and empty texts get the score of their (all-zero) word
features and zero statistics; without usable labels (or with one class only)
the score is the share of label 1 among the training rows (0.5 without rows)
and ``keep_good`` keeps every row; repeated rows are scored each; null ids are scored and never trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C

BUCKETS = 1 << 14
# A word may end in a letter, a digit or one of these without being odd.
_PLAIN = np.ones(256, bool)
_PLAIN[33:48] = False
_PLAIN[list(b".,:;!?\"')")] = True
MARKS = b"!|%$#&*.,:;?-\"'()"


def _stats(data, off, start, end, row, n, h):
    """Structure statistics, one row per text; all 0 for an empty text. ``h`` has the words' hashes."""
    size = np.maximum(np.diff(off), 1).astype(float)
    which = np.searchsorted(off, np.arange(len(data)), "right") - 1
    share = lambda flag: np.bincount(which[flag], minlength=n) / size
    count = np.bincount(row, minlength=n).astype(float)
    length = np.bincount(row, weights=end - start, minlength=n)
    line = np.bincount(which[data == 10], minlength=n) + 1.0
    cols = [np.log1p(count), length / np.maximum(count, 1), np.log1p(size) * (np.diff(off) > 0),
            np.log1p(count / line), share((data >= 65) & (data <= 90)), share((data >= 48) & (data <= 57)),
            share(data >= 128), share(C.WHITE[data])]
    words = np.maximum(count, 1)
    again = np.append(False, (h[1:] == h[:-1]) & (row[1:] == row[:-1])) if len(h) else np.zeros(0, bool)
    letters = np.append(0, np.cumsum((data >= 128) | ((data | 32) >= 97) & ((data | 32) <= 122)))
    bare = letters[end] == letters[start]
    caps = np.append(0, np.cumsum((data >= 97) & (data <= 122)))
    loud = ~bare & (caps[end] == caps[start]) & (end - start > 1)
    odd = ~bare & ~_PLAIN[data[end - 1]] if len(end) else bare
    order = np.lexsort((h, row))  # equal words of a text side by side
    hs, rs = h[order], row[order]
    head = np.flatnonzero(np.append(True, (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1]))) if len(h) else np.zeros(0, np.int64)
    kinds = np.bincount(rs[head], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, rs[head], np.diff(np.append(head, len(h))))
    cols += [np.bincount(row[f], minlength=n) / words for f in (again, bare, loud, odd)] + [kinds / words, most / words, np.log1p(kinds)]
    return np.stack(cols + [share(data == m) for m in MARKS], 1)


N_STATS = 15 + len(MARKS)


def features(col: pa.Array):
    """Sparse word features (row, bucket, value) sorted by row, and dense statistics."""
    data, off = C.text_buffer(col)
    n = len(off) - 1
    start, end, row = C.words(data, off)
    h = C.word_hashes(C.lower_ascii(data), start, end)
    stats = _stats(data, off, start, end, row, n, h)
    bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
    key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    r, b = key // BUCKETS, key % BUCKETS
    norm = np.sqrt(np.bincount(r, weights=count.astype(float) ** 2, minlength=n))
    return r, b, count / norm[r] if len(r) else count.astype(float), stats


@dataclass
class Machine:
    """Weights of hashed words and of statistics; ``constant`` replaces the model if it could not be fitted."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    constant: float | None = None

    def margin(self, r, b, x, stats, n):
        s = (stats - self.mean) / self.scale
        ws, vs = self.w[BUCKETS:], self.v[BUCKETS:]
        linear = self.w0 + np.bincount(r, weights=self.w[b] * x, minlength=n) + s @ ws
        pair = np.zeros(n)
        sums = np.empty((n, self.v.shape[1]))
        for f in range(self.v.shape[1]):
            vx = self.v[b, f] * x
            sums[:, f] = np.bincount(r, weights=vx, minlength=n) + s @ vs[:, f]
            pair += sums[:, f] ** 2 - np.bincount(r, weights=vx**2, minlength=n) - s**2 @ vs[:, f] ** 2
        return linear + 0.5 * pair, s, sums

    def score(self, col: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(col), self.constant)
        r, b, x, stats = features(col)
        z, _, _ = self.margin(r, b, x, stats, len(col))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(rows: list, rank: int = 8, epochs: int = 8, batch: int = 256, rate: float = 0.02, decay: float = 1e-3) -> Machine:
    """Fit on collected rows (label, buckets, values, stats). Deterministic."""
    y = np.array([r["label"] for r in rows], float)
    stats = np.array([r["stats"] for r in rows], float).reshape(-1, N_STATS)
    size = BUCKETS + N_STATS
    rng = np.random.Generator(np.random.PCG64(7))
    m = Machine(0.0, np.zeros(size), rng.normal(0, 0.02, (size, rank)), np.zeros(N_STATS), np.ones(N_STATS))
    if not len(y) or y.min() == y.max():
        m.constant = float(y.mean()) if len(y) else 0.5
        return m
    m.mean, m.scale = stats.mean(0), stats.std(0) + 1e-3
    m.w0 = float(np.log(y.mean() / (1 - y.mean())))
    theta = np.concatenate([m.w[:, None], m.v], 1)
    g1, g2, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            ids = order[lo:lo + batch]
            b = np.concatenate([rows[i]["buckets"] for i in ids]).astype(np.int64)
            x = np.concatenate([rows[i]["values"] for i in ids]).astype(float)
            r = np.repeat(np.arange(len(ids)), [len(rows[i]["buckets"]) for i in ids])
            m.w, m.v = theta[:, 0], theta[:, 1:]
            z, s, sums = m.margin(r, b, x, stats[ids], len(ids))
            d = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[ids]) / len(ids)
            grad = decay * theta
            dx = d[r] * x
            grad[:BUCKETS, 0] += np.bincount(b, weights=dx, minlength=BUCKETS)
            grad[BUCKETS:, 0] += s.T @ d
            for f in range(rank):
                grad[:BUCKETS, 1 + f] += np.bincount(b, weights=dx * (sums[r, f] - m.v[b, f] * x), minlength=BUCKETS)
                grad[BUCKETS:, 1 + f] += s.T @ (d * sums[:, f]) - m.v[BUCKETS:, f] * ((s**2).T @ d)
            step += 1
            g1 = 0.9 * g1 + 0.1 * grad
            g2 = 0.99 * g2 + 0.01 * grad**2
            theta = theta - rate * (g1 / (1 - 0.9**step)) / (np.sqrt(g2 / (1 - 0.99**step)) + 1e-8)
            m.w0 -= 0.05 * float(d.sum())
    m.w, m.v = theta[:, 0].copy(), theta[:, 1:].copy()
    return m


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for p in C.pieces(batches):
        r, b, x, stats = features(p.column("text"))
        at = C.row_bounds(r, p.num_rows)
        lists = lambda a, t: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(a, t))
        yield pa.record_batch([p.column("label").cast(pa.int32()), lists(b, pa.int32()), lists(x, pa.float32()),
                               pa.array(stats.tolist(), pa.list_(pa.float64()))],
                              names=["label", "buckets", "values", "stats"])


def held_out(doc_id) -> F.Column:
    """Rows whose crc32(id as text) leaves 2 when divided by 4; they never train a model."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = 6000) -> Machine:
    """Fit on at most ``max_train`` labelled rows, those of smallest hash of the id among the ids of ``docs``.

    Rows of one id train once, with the smallest of their texts.
    """
    texts = docs.select(F.col("doc_id").alias("_id"), "text")
    sample = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label"))
              .where(F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("_id")))
              .join(texts.select("_id").distinct(), "_id", "left_semi")
              .distinct().orderBy(F.xxhash64("_id"), "_id", "label").limit(max_train))
    rows = (texts.join(F.broadcast(sample), "_id")  # at most max_train rows
            .groupBy("_id", "label").agg(F.min("text").alias("text")))
    found = rows.mapInArrow(_training_rows, "label int, buckets array<int>, values array<float>, stats array<double>")
    return fit(sorted(found.collect(), key=lambda r: (r["label"], r["stats"], r["buckets"])))


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id and score of every row of ``docs``."""

    def run(batches):
        for p in C.pieces(batches):
            yield pa.record_batch([p.column("doc_id"), pa.array(model.score(p.column("text")), pa.float64())],
                                  names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Machine, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, all columns unchanged.

    All rows where no model could be fitted: a constant says nothing about a document.
    """
    if model.constant is not None:
        return docs
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for p in C.pieces(batches):
            yield p.filter(pa.array(model.score(p.column(at)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op7(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    found = score(docs.select(C.long_ids(), "text"), train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))
