"""Shared helpers: tables, lineage cuts, and vectorised work on batches of texts.

Texts are handled as UTF-8 byte buffers of a whole Arrow batch; words, word
hashes and shingle hashes come from numpy passes over the buffer, so Python
never loops over words. Batches are cut to about ``CHUNK_BYTES`` of text, which
bounds the memory of a task whatever the partition size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limelight.session import checkpointed, shared_dir, ship_package  # noqa: F401 (shared_dir: for the pipeline)

CHUNK_BYTES = 2_000_000
LONG_WORD = 512
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def ready(spark: SparkSession) -> None:
    """Make the package importable in Python workers and keep Arrow batches of whole texts small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    return checkpointed(df)


class Rounds:
    """Tables that the rounds of a loop write to the shared folder; those no longer needed are deleted."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_dir(spark).rstrip('/')}/rounds-{uuid.uuid4().hex}"
        self.held: list[tuple[DataFrame, str]] = []

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((table, path))
        return table

    def keep(self, *tables: DataFrame) -> None:
        """Delete what has been written, but for ``tables``."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table, path in self.held:
            if not any(table is t for t in tables):
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(conf).delete(at, True)
        self.held = [(table, path) for table, path in self.held if any(table is t for t in tables)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over 64 output bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about CHUNK_BYTES of text (or one longer text)."""
    for b in batches:
        if not b.num_rows:
            continue
        at = b.schema.get_field_index(text)
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(at)), 0)))
        lo = 0
        while lo < b.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the n+1 offsets of its rows."""
    col = pc.fill_null(col, "").cast(pa.large_binary())
    col = pa.concat_arrays([col]) if col.offset else col
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def words(data: np.ndarray, off: np.ndarray, sep: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, end byte and row of every word (maximal run of non-separator bytes in a row)."""
    inside = ~sep[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: eight bytes at a time go through the finaliser, one after another.

    Each step is a bijection of the bytes it takes in, and a product never stands alone, so
    unlike in a polynomial no pattern of letters cancels out."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from every place on
    size = (end - start).astype(np.int64)
    h = mix(size.astype(np.uint64) * BASE + STEP)
    live, at = np.arange(len(start)), 0
    while len(live):
        left = size[live] - at
        chunk = eight[start[live] + at] & np.where(left >= 8, ~np.uint64(0), (np.uint64(1) << (8 * np.clip(left, 0, 7)).astype(np.uint64)) - np.uint64(1))
        h[live] = mix((h[live] ^ chunk) + BASE)
        at += 8
        live = live[left > 8]
        if at == LONG_WORD:
            break
    for k in live:  # the rest of very long words, one by one
        h[k] = np.uint64(xxhash.xxh3_64_intdigest(data[start[k] + at:end[k]].tobytes(), seed=int(h[k])))
    return h


def shingle_hashes(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of n words within one row, and the index of its first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = out * STEP + h[j:len(h) - n + 1 + j]
    keep = np.flatnonzero(row[: len(h) - n + 1] == row[n - 1:])
    return mix(out[keep]), keep


def row_bounds(row: np.ndarray, n: int) -> np.ndarray:
    """n+1 bounds of the rows 0..n-1 in a sorted array of row numbers."""
    return np.searchsorted(row, np.arange(n + 1))


def runs(keys: np.ndarray) -> zip:
    """Bounds (lo, hi) of the maximal runs of equal neighbours."""
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return zip(heads, np.append(heads[1:], len(keys)))


def long_ids(col: str = "doc_id"):
    return F.col(col).cast("long").alias(col)
