"""Data-quality checks and QC summaries.

Each check returns a DataFrame of violations (or counts). A suite over a table
takes one aggregate for all its per-row checks and one group-by per key set;
only the counts reach the driver, in ``enforce``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limelight.session import checkpointed


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q1: NULL count per column from one aggregate, as rows ``(column_name, null_rows)``."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {stack}) as (column_name, null_rows)")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Q2: values that occur more than once (NULLs are not tested, like dbt ``unique``)."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q3: ``group by all having count(*) > 1`` (NULL keys form a group)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def check_week_start_day(df: DataFrame, column: str = "week_start") -> DataFrame:
    """Q4: rows whose period does not start on a Sunday."""
    return df.agg(F.count_if(F.dayofweek(F.col(column)) != 1).alias("non_sunday_rows"))


def check_range(df: DataFrame, column: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Q7: present values outside ``[low, high]``."""
    c = F.col(column)
    return df.agg(F.count_if(c.isNotNull() & ~c.between(low, high)).alias("out_of_range_rows"))


def check_one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Q8: keys duplicated on either side of a join that must be one-to-one."""
    return (
        check_unique_combination(left.select(*keys), keys).withColumn("side", F.lit("left"))
        .unionByName(check_unique_combination(right.select(*keys), keys).withColumn("side", F.lit("right")))
    )


@dataclass
class CheckSpec:
    name: str
    kind: str  # not_null | unique | unique_combination | week_start | range
    columns: list[str] = field(default_factory=list)
    low: float = 0.0
    high: float = 1.0


def _row_measure(spec: CheckSpec):
    """Violations of a per-row check as one aggregate column; None for checks on groups of rows."""
    cols = [F.col(c) for c in spec.columns]
    if spec.kind == "not_null":
        return sum((F.count_if(c.isNull()) for c in cols), F.lit(0))
    if spec.kind == "week_start":
        return F.count_if(F.dayofweek(cols[0]) != 1)
    if spec.kind == "range":
        return F.count_if(cols[0].isNotNull() & ~cols[0].between(spec.low, spec.high))
    if spec.kind not in ("unique", "unique_combination"):
        raise ValueError(f"unknown check kind {spec.kind}")
    return None


def run_checks(df: DataFrame, specs: list[CheckSpec]) -> DataFrame:
    """Q9: one row per check ``(check_name, violations)``: a single aggregate for all
    per-row checks, a group-by for each uniqueness check."""
    out = None
    measures = [(s.name, m) for s in specs if (m := _row_measure(s)) is not None]
    if measures:
        wide = df.agg(*[m.cast("bigint").alias(f"m{i}") for i, (_, m) in enumerate(measures)])
        pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"m{i}").alias("violations")) for i, (n, _) in enumerate(measures)])
        out = wide.select(F.inline(pairs))
    for s in specs:
        if s.kind in ("unique", "unique_combination"):
            found = check_unique(df, s.columns[0]) if s.kind == "unique" else check_unique_combination(df, s.columns)
            rows = found.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(s.name).alias("check_name"), "violations")
            out = rows if out is None else out.unionByName(rows)
    return out


class CheckFailed(Exception):
    pass


def enforce(results: DataFrame) -> None:
    """Q9: raise before downstream tables are built if any check has violations."""
    bad = results.filter(F.col("violations") > 0).collect()  # as long as the list of checks at most
    if bad:
        raise CheckFailed("; ".join(f"{r.check_name}: {r.violations}" for r in bad))


def _with_distinct(df: DataFrame, group: list[str], measures: list[Column], distinct: dict[str, str], stored: bool) -> DataFrame:
    """The measures and the exact distinct counts (output name -> column) per group.

    Every distinct count is a two-step distinct of its own over one narrow column, where
    several in one aggregate would multiply every row. The results, a row a group each,
    are stacked and folded, so no join is needed. A table not ``stored`` is written once,
    for it is read once a count."""
    table = df if stored else checkpointed(df)
    out = table.groupBy(*group).agg(*measures)
    plain = [c for c in out.columns if c not in group]
    for name, column in distinct.items():
        seen = table.where(F.col(column).isNotNull()).select(*group, column).distinct()
        out = out.unionByName(seen.groupBy(*group).agg(F.count(F.lit(1)).alias(name)), allowMissingColumns=True)
    return out.groupBy(*group).agg(*[F.max(c).alias(c) for c in plain], *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in distinct])


def dataset_qc(df: DataFrame, doc_col: str = "DocumentIdentifier", source_col: str = "SourceCommonName",
               feed_col: str = "stream", date_col: str = "gkg_date", stored: bool = False) -> DataFrame:
    """One-row dataset summary; ``stored``: ``df`` is a table on storage, cheap to read again."""
    s = F.col(feed_col)
    out = _with_distinct(df.select(*dict.fromkeys([doc_col, source_col, feed_col, date_col])), [], [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(s == "regular").alias("regular_rows"),
        F.count_if(s == "translation").alias("translation_rows"),
        F.min(date_col).alias("min_gkg_date"),
        F.max(date_col).alias("max_gkg_date"),
        F.count_if(F.col(doc_col).isNull()).alias("missing_document_identifier_rows"),
    ], {"unique_documents": doc_col, "unique_sources": source_col}, stored)
    return out.select("rows", "unique_documents", "unique_sources", "regular_rows", "translation_rows", "min_gkg_date", "max_gkg_date",
                      "missing_document_identifier_rows", (F.col("rows") - F.col("unique_documents")).alias("duplicate_document_rows"))


def feed_qc(df: DataFrame, doc_col: str = "DocumentIdentifier", source_col: str = "SourceCommonName",
            feed_col: str = "stream", date_col: str = "gkg_date", tone_col: str = "tone",
            score_col: str = "salience_score", class_col: str = "salience_class", stored: bool = False) -> DataFrame:
    """A15 + A16: per feed (a NULL feed is its own group) with the score summary; ``stored`` as in ``dataset_qc``."""
    needed = dict.fromkeys([doc_col, source_col, feed_col, date_col, tone_col, score_col, class_col])
    out = _with_distinct(df.select(*needed), [feed_col], [
        F.count(F.lit(1)).alias("rows"),
        F.min(date_col).alias("min_gkg_date"),
        F.max(date_col).alias("max_gkg_date"),
        F.count_if(F.col(doc_col).isNull()).alias("missing_document_identifier_rows"),
        F.count_if(F.col(tone_col).isNull()).alias("missing_tone_rows"),
        *score_measures(score_col, class_col),
    ], {"unique_documents": doc_col, "unique_sources": source_col}, stored)
    front = [feed_col, "rows", "unique_documents", "unique_sources"]
    return out.select(*front, *[c for c in out.columns if c not in front])


def score_measures(score_col: str = "salience_score", class_col: str = "salience_class"):
    s = F.col(score_col)
    present = s.isNotNull()
    return [
        F.count_if(present).alias("rows_with_salience_score"),
        F.count_if(s.isNull()).alias("rows_without_salience_score"),
        F.count_if(present & ~s.between(0.0, 1.0)).alias("salience_score_out_of_range_rows"),
        F.count_if(present & (F.col(class_col) == "high_salience")).alias("high_salience_rows"),
        F.count_if(present & (F.col(class_col) == "medium_salience")).alias("medium_salience_rows"),
        F.count_if(present & (F.col(class_col) == "low_salience")).alias("low_salience_rows"),
    ]


def score_qc(df: DataFrame, score_col: str = "salience_score", class_col: str = "salience_class") -> DataFrame:
    """A16 over the whole table."""
    return df.agg(*score_measures(score_col, class_col))
