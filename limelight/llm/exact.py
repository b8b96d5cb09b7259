"""Exact duplicates: Golomb-coded fingerprints are exchanged, suspects are compared byte by byte.

1. Every row gets a 64-bit fingerprint and a SHA-256 digest of its normalised text
   (one scan; only these narrow rows are written).
2. A chunk (at most 2**20 rows of one partition) sends its sorted distinct
   fingerprints, cut to the bits that the number of rows asks for, to their owners: a
   range of fingerprints each. A message is the gaps between neighbours in Golomb code.
3. An owner decodes the messages of its range and answers each with a bitmap: bit i
   says that the message's i-th fingerprint also stands in another message.
4. Chunks read their bitmaps. Rows whose fingerprint is marked, or repeats inside the
   chunk, are suspects; all other rows are settled: no other row has their text.
5. Only texts of suspects are shuffled: an aggregate by the text itself, combined
   before the shuffle, compares them byte by byte. Where each digest has one text
   (unless SHA-256 is broken, all have), rows are grouped by digest; rows of a digest
   with several texts are grouped by the texts.

Owners hold about OWNER_ROWS fingerprints whatever the number of rows; a text that a
third of all rows hold is one fingerprint a chunk and one text a task.

Defined cases: null text counts as empty; equal means equal after lower-casing A-Z; the
row with the largest doc_id stays (null is below all ids); of rows that have the same
largest doc_id, one stays; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C

CHUNK_BITS = 20
OWNER_ROWS = 2**21
SPARE_BITS = 14  # a row without a copy is a suspect with probability about 2**-14
BROADCAST_PRINTS = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(norm.cast("binary"), 256))


def golomb(gaps: np.ndarray, shift: int) -> tuple[bytes, bytes]:
    """Golomb code with divisor 2**shift: quotients in unary, and remainders of ``shift`` bits."""
    stops = np.cumsum((gaps >> np.uint64(shift)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1 if len(stops) else 0, np.uint8)
    unary[stops] = 1
    rest = (gaps[:, None] >> np.arange(shift, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(unary).tobytes(), np.packbits(rest.astype(np.uint8).ravel()).tobytes()


def ungolomb(unary: bytes, rest: bytes, n: int, shift: int) -> np.ndarray:
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.uint64) << np.uint64(shift)
    bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * shift).reshape(n, shift).astype(np.uint64)
    return gaps | (bits << np.arange(shift, dtype=np.uint64)).sum(1, dtype=np.uint64)


def _cut_bits(h: np.ndarray, bits: int) -> np.ndarray:
    return h.astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)


MESSAGE = "owner long, chunk long, n int, shift int, unary binary, rest binary"


def _messages(bits: int, owner_bits: int):
    """One row per chunk and owner: the chunk's fingerprints in the owner's range, in Golomb code."""
    low = np.uint64(bits - owner_bits)

    def send(chunk: int, parts: list):
        v = np.unique(_cut_bits(np.concatenate(parts), bits))
        owner = v >> low
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        for lo, hi in zip(heads, np.append(heads[1:], len(v))):
            place = v[lo:hi] & np.uint64((1 << int(low)) - 1)
            gaps = place.copy()
            gaps[1:] -= place[:-1] + np.uint64(1)
            shift = max(0, int(np.log2(max(1.0, 0.69 * float(gaps.mean())))))
            yield (int(owner[lo]), chunk, hi - lo, shift, *golomb(gaps, shift))

    def batch(rows):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["owner", "chunk", "n", "shift", "unary", "rest"])

    def run(batches):
        now, parts = None, []
        for b in batches:
            chunk, h = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in C.runs(chunk):
                if now is not None and chunk[lo] != now:
                    yield batch(list(send(now, parts)))
                    parts = []
                now = int(chunk[lo])
                parts.append(h[lo:hi].copy())
        if parts:
            yield batch(list(send(now, parts)))

    return run


def _answer(key, messages):
    """The owner of a range: which fingerprints of each message stand in more than one message."""
    n, shift = messages.column("n").to_pylist(), messages.column("shift").to_pylist()
    lists = [np.cumsum(ungolomb(u, r, k, s) + np.uint64(1)) for u, r, k, s in zip(
        messages.column("unary").to_pylist(), messages.column("rest").to_pylist(), n, shift)]
    values = np.concatenate(lists)
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    twice = np.zeros(len(values), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    ends = np.cumsum(n)
    return pa.table({"chunk": messages.column("chunk"), "owner": messages.column("owner"), "n": messages.column("n"),
                     "bitmap": pa.array([np.packbits(twice[e - k:e]).tobytes() for e, k in zip(ends, n)], pa.binary())})


def _mark(bits: int):
    """A chunk and its bitmaps: its rows with ``suspect``."""

    def run(key, rows, answers):
        answers = answers.sort_by("owner")
        marked = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=k) for b, k in zip(
            answers.column("bitmap").to_pylist(), answers.column("n").to_pylist())]).astype(bool)
        _, place, count = np.unique(_cut_bits(rows.column("h").to_numpy(), bits), return_inverse=True, return_counts=True)
        return rows.drop_columns("chunk").append_column("suspect", pa.array((marked | (count > 1))[place]))

    return run


def fingerprints(docs: DataFrame, digest=sha256, fingerprint=F.xxhash64) -> DataFrame:
    """(doc_id, row, chunk, h, digest) of every row, written once; ``row`` is unique and fixed by the writing."""
    rows = docs.select(C.long_ids(), normalised().alias("norm")).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), fingerprint(F.col("norm")).alias("h"), digest(F.col("norm")).alias("digest"))
    return C.cut(rows).withColumn("chunk", F.shiftright("row", CHUNK_BITS))


def suspects(rows: DataFrame, owner_rows: int = OWNER_ROWS) -> DataFrame:
    """(doc_id, row, h, digest, suspect): suspect is true wherever another row may have the same text."""
    spark = rows.sparkSession
    n = rows.count()
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // owner_rows))
    owner_bits = (owners - 1).bit_length()
    bits = min(62, max(owner_bits, n.bit_length()) + SPARE_BITS)
    messages = rows.select("chunk", "h").mapInArrow(_messages(bits, owner_bits), MESSAGE)
    answers = messages.groupBy("owner").applyInArrow(_answer, "chunk long, owner long, n int, bitmap binary")
    return (rows.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_mark(bits), "doc_id long, row long, h long, digest binary, suspect boolean"))


def _grouped(rows: DataFrame, key: str) -> DataFrame:
    """Adds keep_id, group_size and kept to rows (doc_id, row, key, ...)."""
    # written first: then the join reads both sides from a shuffle, and rows of one large group are split over tasks
    groups = C.cut(rows.groupBy(F.col(key).alias("_key")).agg(
        F.max(F.struct("doc_id", "row")).alias("top"), F.count("*").alias("group_size")))
    return (rows.join(groups, F.col(key) == F.col("_key"))
            .select("doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("top.row")).alias("kept"), "digest"))


def exact_duplicates(docs: DataFrame, digest=sha256, fingerprint=F.xxhash64, owner_rows: int = OWNER_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    ``digest`` and ``fingerprint`` are functions of the normalised text; results are right for any, however
    weak (weak ones cost more comparisons of texts)."""
    rows = C.cut(suspects(fingerprints(docs, digest, fingerprint), owner_rows))
    prints = C.cut(rows.where("suspect").select(F.col("h").alias("_h")).distinct())
    small = prints.count() <= BROADCAST_PRINTS  # 8 bytes each; more are joined by a shuffle
    texts = docs.select(C.long_ids(), normalised().alias("norm")).join(
        F.broadcast(prints) if small else prints, fingerprint(F.col("norm")) == F.col("_h"), "left_semi")
    distinct = texts.groupBy("norm").agg(F.count("*").alias("n")).select(digest(F.col("norm")).alias("_digest"))
    clash = C.cut(distinct.groupBy("_digest").agg(F.count("*").alias("texts")).where("texts > 1").select("_digest"))
    single = rows.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    several = rows.where("suspect").select("doc_id", "row", "digest")
    if clash.isEmpty():
        return single.unionAll(_grouped(several, "digest"))
    odd = C.cut(texts.withColumn("digest", digest(F.col("norm"))).join(clash, F.col("digest") == F.col("_digest"), "left_semi")
                .withColumn("row", F.monotonically_increasing_id()))
    plain = several.join(clash, F.col("digest") == F.col("_digest"), "left_anti")
    return single.unionAll(_grouped(plain, "digest")).unionAll(_grouped(odd, "norm"))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged: of equal texts the one with the largest doc_id."""
    kept = exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    keyed = docs.withColumn("_own", sha256(normalised()))
    out = keyed.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")), "left_semi")
    again = C.cut(docs.groupBy(C.long_ids().alias("_again")).agg(F.count("*").alias("n")).where("n > 1").select("_again"))
    repeated = F.col("doc_id").cast("long").eqNullSafe(F.col("_again"))  # only ids given twice can leave two rows
    once = out.join(again, repeated, "left_anti")
    twice = out.join(again, repeated, "left_semi").dropDuplicates(["doc_id", "_own"])
    return once.unionAll(twice).drop("_own")


def op12(docs: DataFrame) -> DataFrame:
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = f"""
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT CAST(doc_id AS BIGINT) AS doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
"""
