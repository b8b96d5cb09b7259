"""Text column functions.

Everything except Unicode decomposition (F7) is a JVM expression. Spark has
no Unicode normalisation function, so that step runs in Arrow-batched UDFs:
for scalar text the NFKD + drop-combining-mark step only (the rest stays in
the JVM); for entity-name arrays the distinct names of each batch are folded
once and everything else is Arrow compute (flatten, dictionary encode,
group-by counts).
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.types import ArrayType, StringType

from limelight.functions._util import col_of


def _strip_marks(text: str) -> str:
    if text.isascii():
        return text
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


@pandas_udf(StringType())
def strip_marks(values: pd.Series) -> pd.Series:
    """NFKD-decompose and drop combining marks; NULL stays NULL."""
    return values.map(lambda v: None if v is None else _strip_marks(v))


# Characters Python's ``str.strip()`` removes (``str.isspace``), for ``btrim``.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_NON_ALNUM = re.compile(r"[^a-z0-9]+")


def fold_name(text: str) -> str:
    """F7 in Python for one string: NFKD, drop marks, lower, non [a-z0-9] -> space, squeeze."""
    return _NON_ALNUM.sub(" ", _strip_marks(text).lower()).strip()


def _fold_flat(names: pa.Array, token: str, canonical: str):
    """Flatten a ``list<string>`` batch and fold each element (F8 + F7), folding only
    the distinct names in Python. Returns (folded values, parent row of each)."""
    flat = pc.list_flatten(names)
    parents = pc.list_parent_indices(names)
    valid = pc.is_valid(flat)
    flat, parents = pc.filter(flat, valid), pc.filter(parents, valid)
    encoded = pc.dictionary_encode(flat)
    distinct = encoded.dictionary.to_pylist()
    folded = pa.array([canonical if token in u else fold_name(u) for u in distinct], pa.string())
    return pc.take(folded, encoded.indices), parents


def fold_targets_arrow(names: pa.Array, token: str, canonical: str) -> pa.Array:
    """Per row: the folded names, target variants replaced by ``canonical`` and
    names that fold to ``""`` dropped; NULL lists stay NULL."""
    if isinstance(names, pa.ChunkedArray):
        names = names.combine_chunks()
    n = len(names)
    values, parents = _fold_flat(names, token, canonical)
    keep = pc.not_equal(values, "")
    values, parents = pc.filter(values, keep), pc.filter(parents, keep)
    per_row = np.bincount(parents.to_numpy(), minlength=n) if len(parents) else np.zeros(n, dtype=np.int64)
    offsets = pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=pc.is_null(names))


def fold_targets_udf(token: str, canonical: str):
    """F8 + F7 over an array of lower-cased names as one Arrow UDF (see ``fold_targets_arrow``)."""
    token = token.lower()

    @arrow_udf(ArrayType(StringType()))
    def fold(names: pa.Array) -> pa.Array:
        return fold_targets_arrow(names, token, canonical)

    return fold


def target_counts_arrow(names: pa.Array, token: str, canonical: str) -> pa.StructArray:
    """Per row of a ``list<string>`` array: occurrences of the normalised target and
    of the most frequent normalised name (names folding to ``""`` are dropped).

    Vectorised with Arrow kernels: the lists are flattened and dictionary-encoded,
    only the distinct names of the batch are folded in Python, and the counts are
    an Arrow group-by scattered back to rows with NumPy."""
    if isinstance(names, pa.ChunkedArray):
        names = names.combine_chunks()
    n = len(names)
    mentions = np.zeros(n, dtype=np.int64)
    tops = np.zeros(n, dtype=np.int64)
    values, parents = _fold_flat(names, token, canonical)
    if len(values):
        folded_enc = pc.dictionary_encode(values)
        keys = folded_enc.indices
        labels = folded_enc.dictionary.to_pylist()
        if "" in labels:
            keep = pc.not_equal(keys, labels.index(""))
            keys, parents = pc.filter(keys, keep), pc.filter(parents, keep)
        if len(keys):
            grouped = pa.table({"r": parents, "k": keys}).group_by(["r", "k"]).aggregate([("k", "count")])
            rows = grouped["r"].to_numpy()
            cnt = grouped["k_count"].to_numpy()
            np.maximum.at(tops, rows, cnt)
            if canonical in labels:
                hit = grouped["k"].to_numpy() == labels.index(canonical)
                mentions[rows[hit]] = cnt[hit]
    return pa.StructArray.from_arrays([pa.array(mentions), pa.array(tops)], names=["mentions", "max_mentions"])


def target_counts_udf(token: str, canonical: str):
    """F8 + F7 + A23 + F14 counts as one Arrow UDF over an array of lower-cased
    names; only two integers per row travel back to the JVM."""
    token = token.lower()

    @arrow_udf("mentions bigint, max_mentions bigint")
    def counts(names: pa.Array) -> pa.Array:
        return target_counts_arrow(names, token, canonical)

    return counts


def clean_folded(value) -> Column:
    """JVM tail of F7 on already decomposed text: lower, non [a-z0-9] -> space, squeeze, trim."""
    lowered = F.lower(col_of(value))
    spaced = F.regexp_replace(lowered, r"[^a-z0-9]+", " ")
    return F.trim(F.regexp_replace(spaced, r"\s+", " "))


def normalize_text(value) -> Column:
    """``"  Atlético   Madrid!!"`` -> ``"atletico madrid"``; NULL -> ``""``."""
    return F.coalesce(clean_folded(strip_marks(col_of(value))), F.lit(""))


def squeeze_whitespace(value) -> Column:
    """runs of whitespace -> one space, trimmed."""
    return F.trim(F.regexp_replace(col_of(value), r"\s+", " "))


def strip_ws(value) -> Column:
    """Python ``str.strip()``: trim all leading/trailing whitespace, not only spaces."""
    return F.btrim(col_of(value), F.lit(PY_WHITESPACE))


def strict_int(value) -> Column:
    """digits only -> BIGINT; anything else -> NULL (callers route NULLs to quarantine)."""
    v = strip_ws(col_of(value))
    return F.when(v.rlike(r"^[0-9]+$"), v.try_cast("bigint"))


def dash_to_null(value) -> Column:
    """the unplayed marker ``-`` becomes NULL."""
    return F.nullif(strip_ws(col_of(value)), F.lit("-"))


def first_number(value, sep: str = ",") -> Column:
    """first ``sep``-separated field as DOUBLE; malformed -> NULL (also the Java
    forms ``1.5f`` and ``2d``, which a cast alone would take)."""
    field = F.split_part(col_of(value), F.lit(sep), F.lit(1))
    return F.when(~field.rlike(r"[0-9.][fFdD]\s*$"), field.try_cast("double"))


def source_language(info, stream, translated_stream: str = "translation", default: str = "eng") -> Column:
    """``srclc:xxx`` code of translated rows, ``unknown`` if absent, ``default`` for other feeds."""
    text = F.lower(strip_ws(col_of(info)))
    code = F.regexp_extract(text, r"\bsrclc:([a-z]{2,3})\b", 1)
    parsed = F.when(text.isNotNull() & (code != ""), code).otherwise(F.lit("unknown"))
    return F.when(col_of(stream) == translated_stream, parsed).otherwise(F.lit(default))
