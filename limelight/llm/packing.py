"""Sequence packing by non-negative least squares.

1. Each whole text becomes token ids plus an end id; a document is cut into
   pieces of the window's length and one remainder, in one pass over the text.
2. Remainders are binned by length (rounded up to ``UNIT`` ids). Shallow
   combinations of at most three bins that fill a window are the columns of a
   matrix; repeat counts x >= 0 that minimise |A x - h| for the length histogram
   h come from projected coordinate descent.
3. Counts are rounded down, remainders are dealt to the combinations, and what
   is left is packed greedily (best fit, longest first). A sequence whose ids
   number a power of two needs no padding.

The histogram is over every remainder of a shard. A shard is a hash class of
documents with a bounded expected number of pieces, so memory per task does not
grow with the corpus; each shard loses at most a few partly filled windows.

Defined cases: null and empty texts are one end id; repeated rows are packed
each; null ids are allowed; an empty table gives no rows; a long text gives
full windows, which need no dealing.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C

WINDOW = 2048
UNIT = 8
END = 1


@lru_cache(maxsize=2)
def encoder(path: str | None = None):
    """Byte-level BPE over the ranks of ``path`` (default: the public byte_bpe_50k vocabulary).

    The ids equal those of the same vocabulary in the ``tokenizers`` library
    (tests compare them); this encoder needs about a sixth of the CPU time.
    Special strings inside a text are ordinary text.
    """
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PIECES = "doc_id long, part long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_documents(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Pieces of every document: full windows, then the remainder. ``part`` tells rows of the input apart."""

    def run(batches):
        encode = encoder(path)._core_bpe.encode_ordinary
        for p in C.pieces(batches):
            out = []
            for doc, part, text in zip(*(p.column(i).to_pylist() for i in range(3))):
                ids = encode(text) if text else []
                ids.append(END)
                raw = np.array(ids, "<u4").tobytes()
                n = len(ids)
                out += [(doc, part, lo, min(window, n - lo), zlib.crc32(raw[4 * lo:4 * (lo + window)]), n) for lo in range(0, n, window)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)],
                                  names=["doc_id", "part", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(C.long_ids(), F.monotonically_increasing_id().alias("part"), "text")
    return rows.mapInArrow(run, PIECES)


@lru_cache(maxsize=2)
def combinations(bins: int) -> np.ndarray:
    """All multisets of one to three bin sizes that sum to ``bins``, as rows (a, b, c), 0 for none."""
    pairs = [(a, bins - a, 0) for a in range((bins + 1) // 2, bins)]
    triples = [(a, b, bins - a - b) for a in range(bins // 3, bins) for b in range((bins - a + 1) // 2, min(a, bins - a - 1) + 1)]
    return np.array([(bins, 0, 0), *pairs, *triples])


def solve(hist: np.ndarray, tolerance: float = 0.5, rounds: int = 4000) -> np.ndarray:
    """Non-negative repeat counts of the combinations that best explain ``hist`` (index: bin size).

    Coordinate descent on |A x - h|^2 with x >= 0: a column has at most three
    entries, so one step is exact and costs three reads; it goes on with the
    columns of largest gradient until no count would move by ``tolerance``.
    """
    bins = len(hist) - 1
    combos = combinations(bins)
    member = np.stack([combos, np.zeros_like(combos)])[0]
    weight = np.zeros((len(combos), 3))  # multiplicity of each distinct bin of a column
    rest = hist.astype(float).copy()
    rest[0] = 0
    for j in range(3):
        weight[:, j] = sum((combos[:, i] == combos[:, j]) for i in range(3)) * (combos[:, j] > 0)
        for i in range(j):  # a bin that stands earlier already counts
            weight[combos[:, i] == combos[:, j], j] = 0
    norm = (weight**2).sum(1)
    x = np.zeros(len(combos))
    for _ in range(rounds):
        move = np.maximum((weight * rest[member]).sum(1) / norm, -x)
        order = np.argsort(-np.abs(move) * np.sqrt(norm))[:64]
        if np.abs(move[order[0]]) < tolerance:
            break
        for k in order:
            step = max(float(weight[k] @ rest[member[k]]) / norm[k], -x[k])
            x[k] += step
            np.subtract.at(rest, member[k], weight[k] * step)
    return x


def pack(lengths: np.ndarray, window: int = WINDOW, unit: int = UNIT) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of ``lengths`` (each at most ``window``)."""
    size = -(-lengths // unit)
    bins = window // unit
    seq = np.full(len(lengths), -1, np.int64)
    order = np.argsort(size, kind="stable")
    first = np.searchsorted(size[order], np.arange(bins + 2))
    used = first[:-1].copy()  # next free piece of each size in ``order``
    left = np.diff(first)
    n = 0
    x = np.floor(solve(left.astype(float)) + 1e-9).astype(int)
    for k in np.argsort(-x, kind="stable"):
        if not x[k]:
            break
        combo = [int(s) for s in combinations(bins)[k] if s]
        times = min(int(x[k]), *(int(left[s]) // combo.count(s) for s in combo))
        for s in combo:
            seq[order[used[s]:used[s] + times]] = n + np.arange(times)
            used[s] += times
            left[s] -= times
        n += times
    rest = [i for s in range(bins, 0, -1) for i in order[used[s]:first[s + 1]]]
    seq, n = _best_fit(rest, lengths, seq, n, window)
    by = np.argsort(seq, kind="stable")
    ends = np.cumsum(lengths[by])
    heads = np.searchsorted(seq[by], np.arange(n))
    offset = np.empty(len(lengths), np.int64)
    offset[by] = ends - lengths[by] - np.repeat((ends - lengths[by])[heads], np.diff(np.append(heads, len(by))))
    return seq, offset


def _best_fit(rest: list, lengths, seq, n: int, window: int):
    """Longest first, each into the fullest open sequence that takes it."""
    open_by_room: dict[int, list[int]] = {}
    rooms = np.zeros(window + 1, np.int64)
    for i in sorted(rest, key=lambda i: -lengths[i]):
        need = int(lengths[i])
        fits = np.flatnonzero(rooms[need:])
        if len(fits):
            room = need + int(fits[0])
            s = open_by_room[room].pop()
            rooms[room] -= 1
        else:
            room, s = window, n
            n += 1
        seq[i] = s
        open_by_room.setdefault(room - need, []).append(s)
        rooms[room - need] += 1
    return seq, n


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, window: int = WINDOW, per_shard: int = 40_000, path: str | None = None) -> DataFrame:
    """One row per piece with its sequence and offset; the number of shards follows the number of pieces."""
    cuts = C.cut(cut_documents(docs, window, path))
    shards = max(1, -(-cuts.count() // per_shard))

    def run(key, t):
        t = t.combine_chunks().sort_by([("part", "ascending"), ("start", "ascending")])
        seq, offset = pack(t.column("length").to_numpy(), window)
        number = (np.int64(key[0].as_py()) << np.int64(32)) + seq
        return t.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).append_column(
            "sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    # pieces of one long document go to many shards
    shard = F.pmod(F.xxhash64("part", "start"), F.lit(shards)).alias("shard")
    return cuts.select(shard, "*").groupBy("shard").applyInArrow(run, PACKED)


def op10(docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
