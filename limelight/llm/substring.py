"""Substring removal by relative Lempel-Ziv parsing.

The reference is the corpus itself, kept as blocks of phrases indexed by anchor
(``phrases``; a block is one partition of the shuffle by anchor). Each document
is parsed against the blocks: a phrase that stands earlier, somewhere, is a
factor, and factors that follow one another join to longer ones; every factor
covers at least one whole window, so it is long enough by construction. At
factor boundaries, where a phrase shares its anchor but not its whole span with
earlier text, windows are checked one by one.

Phrases are cut at content-defined places instead of strictly from left to right, which
lets any block be addressed by hash and the blocks be parsed independently.

Words ``[^\\x20\\x09-\\x0D]+``; a window repeats if its words start earlier (smaller
id, or the same id and an earlier place). Words are compared by 64-bit hashes.

Defined cases: null, empty and short texts keep all words; rows of one doc_id
stand at the same places, so equal rows do not remove each other, and what is
removed from one is removed at the same places of the others; a null doc_id
comes before all other ids; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limelight.llm import common as C
from limelight.llm import phrases as P


def _collapsed(key: np.ndarray, ids: pa.Array, row: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Windows of a batch: the first of equal ones asks the corpus, the others are ``later`` for sure and meet nobody."""
    doc = np.asarray(P.pc_fill(ids))[row]
    order = np.lexsort((start, doc, key))
    key, doc, row, start = key[order], doc[order], row[order], start[order]
    new = np.append(True, key[1:] != key[:-1])
    head = np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(key))))
    later = (doc != doc[head]) | (start != start[head])
    own = C.mix(key + (np.arange(len(key)) + 1).astype(np.uint64) * C.STEP)
    return pa.record_batch([pa.array(np.where(later, own, key).view(np.int64)), ids.take(pa.array(row)),
                            pa.array(start.astype(np.int32)), pa.array(later)], names=["window", "doc", "start", "later"])


def _boundary_windows(window: int):
    def run(batches):
        for p in C.pieces(batches):
            code, bounds = P._units(p.column("text"), True)
            if len(code) < window:
                continue
            hasher = P.Hasher(code)
            rows, starts = [], []
            for i, runs in enumerate(p.column("runs").to_pylist()):
                room = bounds[i + 1] - bounds[i] - window + 1
                for r in runs:
                    if r["open"]:
                        at = np.arange(r["start"], min(r["start"] + r["count"], room))
                        rows.append(np.full(len(at), i))
                        starts.append(at)
            if rows:
                row, start = np.concatenate(rows), np.concatenate(starts)
                if len(row):
                    yield _collapsed(hasher(bounds[row] + start, window), p.column("doc_id"), row, start)

    return run


def _kept(window: int):
    def run(batches):
        for p in C.pieces(batches):
            out = []
            for doc, text, runs, more in zip(*(p.column(c).to_pylist() for c in ("doc_id", "text", "runs", "more"))):
                words = (text or "").encode().split()
                spans = [(r["start"], r["count"]) for r in runs or [] if r["done"]] + [(s, 1) for s in more or []]
                gone = P.covered(spans, window, len(words))
                kept = [w for w, g in zip(words, gone) if not g] if spans else words
                out.append((doc, len(words), len(words) - len(kept), b" ".join(kept).decode()))
            doc, n, gone, kept = zip(*out)
            yield pa.record_batch([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                  names=["doc_id", "n_words", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, window: int = 20, gram: int = 5) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words that stay, joined by one space)."""
    texts = docs.select(C.long_ids(), "text")
    runs = C.cut(P.settle(P.phrase_rows(texts, True, window, gram, True), True))
    on = F.col("doc_id").eqNullSafe(F.col("doc"))
    open_ = runs.where(F.exists("runs", lambda r: r["open"]))
    found = texts.join(open_, on).select("doc_id", "text", "runs").mapInArrow(_boundary_windows(window), "window long, doc long, start int, later boolean")
    place = F.struct("doc", "start")
    first = F.min(place).over(Window.partitionBy("window"))
    repeats = found.select("doc", "start", (F.col("later") | (place != first)).alias("later")).where("later")
    more = repeats.groupBy(F.col("doc").alias("doc2")).agg(F.collect_set("start").alias("more"))
    both = texts.join(runs, on, "left").drop("doc").join(more, F.col("doc_id").eqNullSafe(F.col("doc2")), "left")
    return both.select("doc_id", "text", "runs", "more").mapInArrow(_kept(window), "doc_id long, n_words long, n_removed long, kept string")


def op3(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
