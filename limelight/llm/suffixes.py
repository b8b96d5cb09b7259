"""Suffix-array removal: column-wise construction over many strings.

Repeated windows of bytes share an anchor at the same place (``phrases``), so the
strings to be sorted are the distinct phrases of each shared anchor, aligned at
the anchor. For such a collection the order of all suffixes is built column by
column from the right: each round inserts one symbol per string, moves the
strings to their new order by a stable sort on that symbol (the column of the
Burrows-Wheeler transform), and updates the common prefixes of neighbours by a
range minimum over the old order. A window repeats where the common prefix with
a neighbour reaches the window's length.

The strings come from the sorted shuffle files of a partition and are read
sequentially, whole anchors at a time, ``BLOCK`` bytes of strings a batch. Memory
is the batch plus two integers per string. Phrases that are equal as a whole
collapse beforehand: they repeat everywhere. An anchor of more than
``phrases.CROWD`` distinct phrases (the edge of a passage that stands in a great
many documents) is no group for one task: its windows are dealt out by their own
hash instead and counted as a stream, which is exact as well.

Defined cases: null and empty texts have no bytes; every row counts as a text of
its own, so a repeated row is removed wherever it has a window; rows of one
doc_id share what is removed, by place; a null doc_id is an id; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C
from limelight.llm import phrases as P

BLOCK = 4_000_000


def repeats(strings: list[bytes], group: np.ndarray, place: np.ndarray, count: np.ndarray, window: int):
    """For each string the flags of its first ``count`` windows that stand in another string of its group.

    ``place`` is the offset of the anchor in each string: strings of a group are aligned there.
    """
    m = len(strings)
    size = np.array([len(s) for s in strings])
    data = np.frombuffer(b"".join(strings), np.uint8)
    base = np.cumsum(size) - size
    left = -place  # column of the first and behind the last symbol, the anchor being column 0
    right = size - place
    flags = [np.zeros(c, bool) for c in count]
    if not m:
        return flags
    flat = np.zeros(int(count.sum()), bool)
    fbase = np.cumsum(count) - count
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int64)  # strings that have begun, and common[i] of order[i-1], order[i]
    starting = np.argsort(-right, kind="stable")
    given = 0
    for column in range(int(right.max()) - 1, int(left.min()) - 1, -1):
        new = given
        while new < m and right[starting[new]] > column:
            new += 1
        if new > given:  # strings that end here: their suffix was empty
            order = np.concatenate([starting[given:new], order])
            common = np.concatenate([np.zeros(new - given, np.int64), common])
            given = new
        live = left[order] <= column
        if not live.all():
            common = _least_between(common, np.flatnonzero(live))
            order = order[live]
        if not len(order):
            continue
        symbol = data[base[order] + column - left[order]]
        key = group[order] * 256 + symbol
        to = np.argsort(key, kind="stable")
        key = key[to]
        alike = np.append(False, key[1:] == key[:-1])
        after = np.zeros(len(to), np.int64)
        y = np.flatnonzero(alike)
        if len(y):
            lo, hi = to[y - 1] + 1, to[y] + 1
            after[y] = 1 + np.minimum.reduceat(np.append(common, 0), np.stack([lo, hi], 1).ravel())[::2]
        order, common = order[to], after
        reach = common >= window
        if reach.any():
            hit = reach.copy()
            hit[:-1] |= reach[1:]
            string = order[hit]
            at = column - left[string]
            ok = at < count[string]
            flat[fbase[string[ok]] + at[ok]] = True
    return [flat[b:b + c] for b, c in zip(fbase, count)]


def _least_between(common: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Common prefixes of the neighbours that remain when only the places ``keep`` do."""
    if len(keep) < 2:
        return np.zeros(len(keep), np.int64)
    pairs = np.stack([keep[:-1] + 1, keep[1:] + 1], 1).ravel()
    return np.append(0, np.minimum.reduceat(np.append(common, 0), pairs)[::2])


ROWS = "key long, doc long, start int, count int, at int, done boolean, bytes binary"


def _strings(window: int):
    """What has to be compared: the bytes of open phrases, to be dealt by anchor, and the
    windows of crowded anchors (``at`` -1, ``count`` how often in this batch), by their hash."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
    names = [c.split()[0] for c in ROWS.split(", ")]

    def windows(p, crowded):
        data, off = C.text_buffer(p.column("text"))
        hasher = P.Hasher(C.BYTE_CODE[data])
        row, start, done = ([], [], [])
        for i, r in crowded:
            at = np.arange(r["start"], max(r["start"], min(r["start"] + r["count"], off[i + 1] - off[i] - window + 1)))
            row.append(np.full(len(at), i))
            start.append(at)
            done.append(np.full(len(at), r["done"]))
        row, start, done = map(np.concatenate, (row, start, done))
        key = hasher(off[row] + start, window)
        order = np.argsort(key, kind="stable")
        new = np.append(True, key[order][1:] != key[order][:-1]) if len(order) else np.zeros(0, bool)
        times = np.diff(np.append(np.flatnonzero(new), len(order)))
        # the first of equal windows speaks for the batch; the others are repeats for sure and meet nobody
        own = C.mix(key[order] + (np.arange(len(order)) + 1).astype(np.uint64) * C.STEP)
        key = np.where(new, key[order], own).view(np.int64)
        n = len(order)
        return pa.record_batch(
            [pa.array(key), p.column("doc_id").take(pa.array(row[order])), pa.array(start[order].astype(np.int32)),
             pa.array(np.repeat(times, times).astype(np.int32)), pa.array(np.full(n, -1, np.int32)), pa.array(done[order]), pa.nulls(n, pa.binary())],
            names=names)

    def run(batches):
        for p in C.pieces(batches):
            out, crowded = [], []
            for i, (doc, text, runs) in enumerate(zip(*(p.column(c).to_pylist() for c in ("doc_id", "text", "runs")))):
                raw = (text or "").encode()
                for r in runs:
                    if r["open"] and r["crowded"]:
                        crowded.append((i, r))
                    elif r["open"]:
                        out.append((r["key"], doc, r["start"], r["count"], r["at"], r["done"], raw[r["start"]:r["start"] + r["count"] - 1 + window]))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
            if crowded:
                yield windows(p, crowded)

    return run


def _sorted_strings(window: int):
    """Runs of repeated windows, from rows that come sorted by key and ``at``."""

    def solve(rows):
        rows = [r for r in rows if len(r[6]) >= window]
        if not rows:
            return []
        group = np.unique(np.array([r[0] for r in rows]), return_inverse=True)[1]
        count = np.array([min(r[3], len(r[6]) - window + 1) for r in rows])
        out = []
        for r, flag in zip(rows, repeats([r[6] for r in rows], group, np.array([r[4] for r in rows]), count, window)):
            if not r[5] and flag.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
                out += [(r[1], r[2] + int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]
        return out

    def batch(out):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32()))], names=["doc", "start", "count"])

    def run(batches):
        held, size, single = [], 0, None
        for b in batches:
            out = []
            for r in zip(*(b.column(i).to_pylist() for i in range(7))):
                if r[4] < 0:  # a window: it repeats if its batch had several, or another batch has one
                    met = single is not None and single[0] == r[0]
                    if met and not single[5] and single[3] == 1:
                        out.append((single[1], single[2], 1))
                    if (met or r[3] > 1) and not r[5]:
                        out.append((r[1], r[2], 1))
                    single = (*r[:3], 2 if met else r[3], *r[4:])
                    continue
                if size > BLOCK and r[0] != held[-1][0]:
                    out += solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[6])
            if out:
                yield batch(out)
        if held and (out := solve(held)):
            yield batch(out)

    return run


def _kept(window: int):
    def run(batches):
        for p in C.pieces(batches):
            out = []
            for doc, text, runs, more in zip(*(p.column(c).to_pylist() for c in ("doc_id", "text", "runs", "more"))):
                raw = (text or "").encode()
                spans = [(r["start"], r["count"]) for r in runs or [] if r["done"]] + [(r["start"], r["count"]) for r in more or []]
                n_spans, kept = 0, raw
                if spans:
                    gone = P.covered(spans, window, len(raw))
                    n_spans = int(np.count_nonzero(np.diff(np.append(0, gone.view(np.int8))) == 1))
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((doc, len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                  names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, window: int = 200, gram: int = 64) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay)."""
    texts = docs.select(C.long_ids(), "text")
    runs = C.cut(P.settle(P.phrase_rows(texts, False, window, gram, False), False))
    on = F.col("doc_id").eqNullSafe(F.col("doc"))
    open_ = runs.where(F.exists("runs", lambda r: r["open"]))
    strings = texts.join(open_, on).select("doc_id", "text", "runs").mapInArrow(_strings(window), ROWS)
    found = strings.repartition("key").sortWithinPartitions("key", "at").mapInArrow(_sorted_strings(window), "doc long, start int, count int")
    more = found.groupBy(F.col("doc").alias("doc2")).agg(F.collect_list(F.struct("start", "count")).alias("more"))
    both = texts.join(runs, on, "left").drop("doc").join(more, F.col("doc_id").eqNullSafe(F.col("doc2")), "left")
    return both.select("doc_id", "text", "runs", "more").mapInArrow(
        _kept(window), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op4(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).drop("kept")
