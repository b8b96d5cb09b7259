"""Content-defined phrases: how repeated passages of any texts find each other.

Every window of ``window`` symbols (words or bytes) has an anchor: the run of
``gram`` symbols inside it with the smallest hash. Equal windows have equal anchors
at equal places, wherever they stand, so looking up phrases by anchor loses no
repeat. A phrase is a maximal run of windows with one anchor; its span covers
them. Phrases with equal spans settle all their windows at once; only phrases
that share an anchor but not a span (at the ends of repeated passages) have to
be looked at symbol by symbol.

Rows are collapsed inside each block of about ``common.CHUNK_BYTES`` of text before
anything is shuffled, so a passage that stands in a third of all rows sends one
row per block and distinct span.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limelight.llm import common as C

#: An anchor with more distinct spans than this is looked at window by window instead of as one group.
CROWD = 1000
NONE = np.uint64(2**64 - 1)
INVERSE = np.uint64(pow(int(C.BASE), -1, 2**64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(n, 0), base, np.uint64)]))


class Hasher:
    """Hash of any run of symbols in constant time, from prefix sums."""

    def __init__(self, code: np.ndarray):
        n = len(code)
        self.back = powers(INVERSE, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * powers(C.BASE, n)[:n], dtype=np.uint64)])

    def __call__(self, start: np.ndarray, size) -> np.ndarray:
        return C.mix((self.sums[start + size] - self.sums[start]) * self.back[start] + np.asarray(size).astype(np.uint64))


def _least(value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of value[i:i+width] for each i, and where it first stands."""
    n = len(value) - width + 1
    low, at, have = value, np.arange(len(value), dtype=np.int32), 1
    while have * 2 <= width:
        less = low[have:] < low[:-have]
        at = np.where(less, at[have:], at[:-have])
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    shift = width - have
    less = low[shift:shift + n] < low[:n]
    return np.minimum(low[:n], low[shift:shift + n]), np.where(less, at[shift:shift + n], at[:n])


def phrases(code: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """(row, start in row, number of windows, anchor hash, span hash, anchor's place in the span) of every phrase."""
    n = len(code)
    empty = np.zeros(0, np.int64)
    if n < window:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty
    hasher = Hasher(code)
    end = np.repeat(bounds[1:], np.diff(bounds))  # end of the row of each symbol
    place = np.arange(n)
    grams = hasher(place[: n - gram + 1], gram)
    grams[place[: n - gram + 1] + gram > end[: n - gram + 1]] = NONE
    low, at = _least(grams, window - gram + 1)
    i = np.flatnonzero(place[: n - window + 1] + window <= end[: n - window + 1])
    if not len(i):
        return phrases(code[:0], bounds, window, gram)
    p = at[i]
    head = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (i[1:] != i[:-1] + 1)]))
    first = i[head]
    count = np.diff(np.append(head, len(i)))
    row = np.searchsorted(bounds, first, "right") - 1
    inside = p[head] - first
    span = hasher(first, count + window - 1) + inside.astype(np.uint64) * C.STEP
    return row, first - bounds[row], count, low[first], span, inside


def merged(row: np.ndarray, start: np.ndarray, count: np.ndarray):
    """Join runs of windows (row, start, count) that touch or overlap; input in any order."""
    if not len(row):
        return row, start, count
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], (start + count)[order]
    shifted = row * (np.int64(2) ** 40)
    reach = np.maximum.accumulate(shifted + end)
    new = np.concatenate([[True], shifted[1:] + start[1:] > reach[:-1]])
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(row)) - 1
    return row[head], start[head], reach[last] - shifted[head] - start[head]


ROWS = "key long, span long, doc long, start int, count int, at int, n int, done boolean"


def _units(col: pa.Array, words: bool):
    """Symbol codes and row bounds of the texts of a batch."""
    data, off = C.text_buffer(col)
    if not words:
        return C.BYTE_CODE[data], off
    start, end, row = C.words(data, off)
    return C.word_hashes(data, start, end), C.row_bounds(row, len(off) - 1)


def phrase_rows(docs: DataFrame, words: bool, window: int, gram: int, ordered: bool) -> DataFrame:
    """Phrases to look up, and runs of windows already known to be repeats within their block (``done``).

    ``ordered``: a window repeats only what starts earlier (id, then place), else whatever stands anywhere else.
    """

    def run(batches):
        for p in C.pieces(batches):
            ids = p.column("doc_id")
            known = np.asarray(pc_fill(ids))
            row, start, count, key, span, at = phrases(*_units(p.column("text"), words), window, gram)
            if not len(row):
                continue
            order = np.lexsort((start, known[row], span, key))
            k, s = key[order], span[order]
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])])
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(order)))
            rep = order[head]
            if ordered:  # rows of one id and place are one place
                later = ~new & ((known[row[order]] != np.repeat(known[row[rep]], size)) | (start[order] != np.repeat(start[rep], size)))
                sure = order[later]
            else:
                sure = order[np.repeat(size > 1, size)]
            drow, dstart, dcount = merged(row[sure], start[sure], count[sure])
            many = len(drow)
            salt = C.mix(known[drow].astype(np.uint64) * C.STEP + dstart.astype(np.uint64))
            cat = lambda a, b, t: pa.array(np.concatenate([a, b]).astype(t))
            yield pa.record_batch(
                [cat(key[rep].view(np.int64), salt.view(np.int64), np.int64), cat(span[rep].view(np.int64), np.zeros(many), np.int64),
                 ids.take(pa.array(np.concatenate([row[rep], drow]))), cat(start[rep], dstart, np.int32), cat(count[rep], dcount, np.int32),
                 cat(at[rep], np.zeros(many), np.int32), cat(np.minimum(size, 2**30), np.zeros(many), np.int32),
                 pa.array(np.concatenate([np.zeros(len(rep), bool), np.ones(many, bool)]))],
                names=["key", "span", "doc", "start", "count", "at", "n", "done"])

    return docs.select(C.long_ids(), "text").mapInArrow(run, ROWS)


def pc_fill(ids: pa.Array) -> pa.Array:
    """Ids for ordering: a null comes before all others."""
    return ids.fill_null(-(2**63))


def settle(rows: DataFrame, ordered: bool) -> DataFrame:
    """Per doc the list ``runs`` of struct(start, count, at, key, done, open, crowded).

    ``done``: all windows of the run are repeats. ``open``: its windows have to be
    compared with those of other phrases of the anchor (one phrase for each distinct
    span); ``crowded``: more than CROWD of them have this anchor. One shuffle by
    anchor; both windows go over one sort.
    """
    same, anchor = Window.partitionBy("key", "span"), Window.partitionBy("key")
    place = F.struct("doc", "start")
    seen = rows.repartition("key").select(
        "*", F.min(place).over(same).alias("first"), F.sum("n").over(same).alias("times")
    )
    is_first = place == F.col("first")
    seen = seen.select("*", F.count(F.when(is_first & ~F.col("done"), 1)).over(anchor).alias("spans"))
    done = F.col("done") | (~is_first if ordered else F.col("times") > 1)
    rows = seen.select("doc", "start", "count", "at", "key", done.alias("done"),
                       (~F.col("done") & (F.col("spans") > 1) & is_first).alias("open"),
                       (F.col("spans") > CROWD).alias("crowded")).where("done or open")
    return rows.groupBy("doc").agg(F.collect_list(F.struct("start", "count", "at", "key", "done", "open", "crowded")).alias("runs"))


def covered(runs: list[tuple[int, int]], window: int, n: int) -> np.ndarray:
    """Flags of the n symbols that lie in a window of the runs (start, number of windows)."""
    edge = np.zeros(n + 1, np.int32)
    if runs:
        a = np.array(runs, np.int64)
        np.add.at(edge, np.minimum(a[:, 0], n), 1)
        np.add.at(edge, np.minimum(a[:, 0] + a[:, 1] - 1 + window, n), -1)
    return np.cumsum(edge[:n]) > 0
