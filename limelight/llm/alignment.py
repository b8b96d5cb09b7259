"""Alignment of two tokenizations of one text by merge-path partitioning.

1. Every whole text is encoded by both tokenizers; where the bytes of either one's
   tokens do not add up to the text, there is nothing to align.
2. Aligning is merging two sorted lists: the byte offsets at which A tokens and B tokens
   end. The lists of a block of documents are one merge of len(A) + len(B) steps. For
   every ``piece``-th diagonal of the merge grid a binary search finds the one point
   where the merge path crosses it; the points cut the merge into pieces of equal work
   whatever the lengths of documents, and pieces need nothing of one another.
3. A piece merges its ends. Each distinct end closes the overlap of one A token and one
   B token: that is a link; an end of both closes a group. Where a piece's first end
   is its predecessor's last one (A's copy fell before the cut, B's after it), the two
   are stitched: one link, which also closes a group.
4. Links are counted for the whole corpus by id pair, and documents are scored by the
   counts. Ids of both tokenizations are written once, so texts are encoded once.

Pair counts are sent to the tasks in blocks of at most ``block`` pairs, a pass over the
written ids each; the columns they give are sums, so blocks add up.

Defined cases: null and empty texts and texts whose bytes differ have no tokens (zeros,
empty groups); rows may repeat and ids be null: rows are told apart by their place; an
empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C
from limelight.llm.packing import encoder

PIECE = 2**15
BLOCK_PAIRS = 2_000_000
RADIX = 2**16  # ids of either vocabulary are below
A_FILE, B_FILE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


@lru_cache(maxsize=2)
def pieces_of(path: str | None = None):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(B_FILE))


@lru_cache(maxsize=2)
def token_bytes(a_path: str | None = None, b_path: str | None = None):
    """Per tokenizer: byte length of every id; for B also all bytes, and the place of each id's."""
    ranks = encoder(a_path)._mergeable_ranks
    a_size = np.zeros(RADIX, np.int64)
    for token, i in ranks.items():
        a_size[i] = len(token)
    model = pieces_of(b_path)
    parts = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]
    b_size = np.zeros(RADIX, np.int64)
    b_size[:len(parts)] = [len(p) for p in parts]
    return a_size, b_size, np.frombuffer(b"".join(parts), np.uint8), np.cumsum(b_size) - b_size


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d merged ends are A's, for each diagonal d; at equal ends A's come first."""
    lo, hi = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := lo < hi).any():
        i = (lo + hi) // 2
        j = diagonals - i - 1
        take = a[np.minimum(i, len(a) - 1)] <= b[np.clip(j, 0, len(b) - 1)]
        lo, hi = np.where(open_ & take, i + 1, lo), np.where(open_ & ~take, i, hi)
    return lo


def merge_piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """The links (A token, B token) of one piece in order, the end of each, and whether it closes a group."""
    ends = np.concatenate([a[i0:i1], b[j0:j1]])
    ends.sort(kind="stable")
    again = np.append(False, ends[1:] == ends[:-1])
    both = np.append(again[1:], False)[~again]
    ends = ends[~again]
    return i0 + np.searchsorted(a[i0:i1], ends), j0 + np.searchsorted(b[j0:j1], ends), ends, both


def merge(a: np.ndarray, b: np.ndarray, piece: int = PIECE):
    """All links and group ends of two lists of ends with the same last end."""
    if not len(a):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
    diagonals = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    i = crossings(a, b, diagonals)
    j = diagonals - i
    parts = []
    for k in range(len(diagonals) - 1):
        part = merge_piece(a, b, i[k], i[k + 1], j[k], j[k + 1])
        if parts and part[2][0] == parts[-1][2][-1]:
            parts[-1][3][-1] = True
            part = tuple(x[1:] for x in part)
        if len(part[0]):
            parts.append(part)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _decimals(ids: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of every id followed by its mark, as bytes, and the length of each."""
    size = 1 + sum((ids >= 10**k).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(size + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    for k in range(5):
        has = np.flatnonzero(size > k)
        out[ends[has] - 2 - k] = 48 + ids[has] // 10**k % 10
    return out, size + 1


def groups_text(a_ids, b_ids, a_ends, b_ends, group_ends, doc_ends):
    """Bytes of ``a1,a2|b1;a3|b2,b3`` of all documents one after another, and the n+1 bounds of the documents."""
    ga, gb = np.searchsorted(group_ends, a_ends), np.searchsorted(group_ends, b_ends)
    n = len(group_ends)
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    at_a = np.arange(len(ga)) + (np.cumsum(nb) - nb)[ga]
    at_b = np.arange(len(gb)) + np.cumsum(na)[gb]
    ids, mark = np.empty(len(ga) + len(gb), np.int64), np.full(len(ga) + len(gb), ord(","), np.uint8)
    ids[at_a], ids[at_b] = a_ids, b_ids
    last = np.cumsum(na + nb) - 1  # place of the last B token of each group
    mark[last] = ord(";")
    mark[last - nb] = ord("|")
    text, size = _decimals(ids, mark)
    ends = np.cumsum(size)[last[np.searchsorted(group_ends, doc_ends)]]
    return text, np.append(0, ends)


def _flat(lists) -> np.ndarray:
    return np.concatenate([np.array(x, np.uint16) for x in lists]) if lists else np.zeros(0, np.uint16)


def _encode(texts: list, a_path, b_path):
    """Ids of both tokenizers and token counts of every text; counts are 0 where nothing can be aligned."""
    a_size, b_size, b_bytes, b_at = token_bytes(a_path, b_path)
    encode = encoder(a_path)._core_bpe.encode_ordinary
    full = [k for k, t in enumerate(texts) if t]
    raw = [b" " + texts[k].encode() for k in full]
    b = pieces_of(b_path).encode([texts[k] for k in full], num_threads=1) if full else []
    size = np.array([len(r) for r in raw], np.int64)
    nb = np.array([len(x) for x in b], np.int64)
    ids = _flat(b)
    got = np.add.reduceat(b_size[ids], (np.cumsum(nb) - nb)[nb > 0]) if len(ids) else np.zeros(0, np.int64)
    same = np.zeros(len(full), bool)
    same[nb > 0] = got == size[nb > 0]
    if same.any():  # lengths agree: compare the bytes
        ids = ids[np.repeat(same, nb)]
        n = b_size[ids]
        found = b_bytes[np.arange(int(n.sum())) + np.repeat(b_at[ids] - (np.cumsum(n) - n), n)]
        want = np.frombuffer(b"".join(r for r, s in zip(raw, same) if s), np.uint8)
        heads = (np.cumsum(size[same]) - size[same])
        same[same] = np.logical_and.reduceat(found == want, heads)
    a = {k: encode(" " + texts[k]) for k, s in zip(full, same) if s}
    for k, i in list(a.items()):
        if int(a_size[i].sum()) != len(texts[k].encode()) + 1:  # pragma: no cover - byte-level ids always add up
            del a[k]
    b = {k: x for k, x in zip(full, b) if k in a}
    count = np.zeros((2, len(texts)), np.int64)
    for side, lists in enumerate((a, b)):
        for k, x in lists.items():
            count[side, k] = len(x)
    return _flat(list(a.values())), _flat(list(b.values())), count


def _cut_binary(flat: np.ndarray, count: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(count) * flat.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, a_ids binary, b_ids binary"


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, piece: int = PIECE) -> DataFrame:
    """Per row of ``docs``: numbers of tokens, groups and links, the groups as text, and both lists of ids (16 bits each)."""

    def run(batches):
        for p in C.pieces(batches):
            a, b, count = _encode(p.column("text").to_pylist(), a_path, b_path)
            a_size, b_size = token_bytes(a_path, b_path)[:2]
            ends = np.cumsum(a_size[a]), np.cumsum(b_size[b])
            live = count[0] > 0
            n_groups, n_links = np.zeros(p.num_rows, np.int64), np.zeros(p.num_rows, np.int64)
            text = [""] * p.num_rows
            if live.any():
                _, _, at, both = merge(*ends, piece)
                doc_ends = ends[0][np.cumsum(count[0][live]) - 1]
                n_links[live] = np.diff(np.searchsorted(at, doc_ends, "right"), prepend=0)
                n_groups[live] = np.diff(np.searchsorted(at[both], doc_ends, "right"), prepend=0)
                flat, bounds = groups_text(a, b, *ends, at[both], doc_ends)
                flat = flat.tobytes()
                for k, lo, hi in zip(np.flatnonzero(live), bounds[:-1], bounds[1:]):
                    text[k] = flat[lo:hi - 1].decode()
            yield pa.record_batch(
                [p.column("row"), p.column("doc_id"), *(pa.array(x) for x in (count[0], count[1], n_groups, n_links)), pa.array(text, pa.string()),
                 _cut_binary(a, count[0]), _cut_binary(b, count[1])],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "a_ids", "b_ids"])

    return docs.select(F.monotonically_increasing_id().alias("row"), C.long_ids(), F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def _linked(batch: pa.RecordBatch, a_path, b_path, piece):
    """The id pair of every link of a batch of written ids, as a * RADIX + b, and the number of links before each row."""
    ids, ends = [], []
    for name, size in zip(("a_ids", "b_ids"), token_bytes(a_path, b_path)[:2]):
        flat = np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint16).astype(np.int64)
        ids.append(flat)
        ends.append(np.cumsum(size[flat]))
    i, j, _, _ = merge(*ends, piece)
    return ids[0][i] * RADIX + ids[1][j], np.append(0, np.cumsum(batch.column("n_links").to_numpy()))


def _blocks(batches, size: int = 1_000_000):
    """Parts of batches of about ``size`` links."""
    for b in batches:
        ends = np.cumsum(b.column("n_links").to_numpy())
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def pair_counts(aligned: DataFrame, a_path: str | None = None, b_path: str | None = None, piece: int = PIECE) -> DataFrame:
    """(pair, n, best): links of each id pair in the whole corpus; best: no pair of the same B id has more."""

    def run(batches):
        for part in _blocks(batches):
            pair, n = np.unique(_linked(part, a_path, b_path, piece)[0], return_counts=True)
            yield pa.record_batch([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])

    rows = aligned.where("n_links > 0").select("a_ids", "b_ids", "n_links")
    counts = C.cut(rows.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    most = counts.groupBy((F.col("pair") % RADIX).alias("b")).agg(F.max("n").alias("most"))  # at most one row a B id
    return counts.join(F.broadcast(most), F.col("pair") % RADIX == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame, a_path: str | None = None, b_path: str | None = None,
                piece: int = PIECE, block: int = BLOCK_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of every row with links: links whose pair is best, and the sum of their pairs' counts."""
    sc = aligned.sparkSession.sparkContext
    counts = C.cut(counts)
    blocks = max(1, -(-counts.count() // block))

    def scored(sent):
        def run(batches):
            pairs, n, best = sent.value
            for part in _blocks(batches):
                pair, bounds = _linked(part, a_path, b_path, piece)
                at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
                held = pairs[at] == pair
                sums = [np.diff(np.append(0, np.cumsum(x[at] * held))[bounds]) for x in (best.astype(np.int64), n)]
                yield pa.record_batch([part.column("row"), *map(pa.array, sums)], names=["row", "n_best", "count_sum"])

        return run

    rows = aligned.where("n_links > 0").select("row", "a_ids", "b_ids", "n_links")
    out = None
    for k in range(blocks):
        t = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k).toArrow().sort_by("pair")
        if not t.num_rows:
            continue
        sent = sc.broadcast(tuple(t.column(c).to_numpy() for c in ("pair", "n", "best")))
        one = rows.mapInArrow(scored(sent), "row long, n_best long, count_sum long")
        out = one if out is None else out.unionAll(one)
    if out is None:
        return aligned.sparkSession.createDataFrame([], "row long, n_best long, count_sum long")
    return out if blocks == 1 else out.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def op11(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, piece: int = PIECE, block: int = BLOCK_PAIRS) -> DataFrame:
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = C.cut(align(docs, a_path, b_path, piece).withColumn("groups_sha256", digest).drop("groups"))
    scores = link_scores(rows, pair_counts(rows, a_path, b_path, piece), a_path, b_path, piece, block)
    return (rows.drop("a_ids", "b_ids").join(scores, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256"))
