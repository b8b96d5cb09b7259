"""Packed entity lists.

A packed list is ``"Name,offset;Name,offset"`` in one string column. It is
parsed in-row into ``ARRAY<STRUCT<name STRING, offset BIGINT>>`` with higher
order functions, so scoring an article never shuffles: the work per row is
bounded by the size of that row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from limelight.functions._util import col_of
from limelight.functions.text import fold_targets_udf


# One entry: optional blanks, a name that ends in a non-blank, blanks, the last
# comma of the entry, blanks, digits only, blanks, then ``;`` or the end. A
# later comma cannot be followed by digits-only, so the split is on the last one.
# Blanks are Unicode White_Space (Python's ``strip`` also removes U+001C-U+001F).
_W = r"\p{IsWhite_Space}"
ENTRY_PATTERN = f"(?:^|;){_W}*([^;]*?[^;{_W}]){_W}*,{_W}*([0-9]+){_W}*(?=;|$)"


def parse_offset_entries(value) -> Column:
    """``;``-split, split on the last comma, lower-cased trimmed name, all-digit
    offset; malformed entries are skipped; NULL -> empty array.

    Built from codegen-capable functions only: two ``regexp_extract_all`` passes
    over the lower-cased string, an array cast and ``arrays_zip`` (no lambda is
    evaluated per entry)."""
    text = F.lower(F.coalesce(col_of(value), F.lit("")))
    names = F.regexp_extract_all(text, F.lit(ENTRY_PATTERN), F.lit(1))
    offsets = F.regexp_extract_all(text, F.lit(ENTRY_PATTERN), F.lit(2)).try_cast("array<bigint>")
    return F.arrays_zip(names.alias("name"), F.coalesce(offsets, F.array().cast("array<bigint>")).alias("offset"))


def names_of(entries) -> Column:
    """Field of an array of structs as an array (no lambda)."""
    return col_of(entries)["name"]


def offsets_of(entries) -> Column:
    return col_of(entries)["offset"]


def is_target_name(name: Column, token: str) -> Column:
    """token test on the lower-cased name."""
    return F.instr(name, token.lower()) > 0


def normalize_targets(names, token: str, canonical: str) -> Column:
    """F8 + F7 over an array of lower-cased names: names with the token become
    ``canonical``; the rest are folded; names that fold to ``""`` are dropped."""
    return fold_targets_udf(token, canonical)(col_of(names))


def count_of(values, target: str) -> Column:
    """Occurrences of ``target`` in an array."""
    return F.size(F.filter(col_of(values), lambda v: v == F.lit(target)))


def max_multiplicity(values) -> Column:
    """Largest number of equal elements in an array (0 when empty); one linear
    pass over the sorted array, no explode and no shuffle."""
    init = F.struct(F.lit(None).cast("string").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc, x):
        run = F.when(x == acc["prev"], acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("prev"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.array_sort(col_of(values)), init, step, lambda acc: acc["best"])
