"""The raw news-metadata feed.

Files are headerless tab-separated text, 27 string columns, laid out as
``<root>/date=YYYY-MM-DD/stream=<feed>/<timestamp>[.translation].gkg.csv``.
The reader passes an explicit schema (a short first file cannot change the
arity), turns quoting/escaping off, reads only ``*.gkg.csv`` files and lets
partition discovery turn the folder keys into ``feed_date`` and ``stream``. A
date range lists and reads the folders of its days and feeds only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

# Fixed values that must equal the reference for equal results.
GKG_COLUMNS = [
    "GKGRECORDID", "DATE", "SourceCollectionIdentifier", "SourceCommonName", "DocumentIdentifier",
    "Counts", "V2Counts", "Themes", "V2Themes", "Locations", "V2Locations", "Persons", "V2Persons",
    "Organizations", "V2Organizations", "V2Tone", "Dates", "GCAM", "SharingImage", "RelatedImages",
    "SocialImageEmbeds", "SocialVideoEmbeds", "Quotations", "AllNames", "Amounts", "TranslationInfo", "Extras",
]
SEARCH_TEXT_COLUMNS = [
    "DocumentIdentifier", "SourceCommonName", "Counts", "V2Counts", "Themes", "V2Themes", "Locations",
    "V2Locations", "Persons", "V2Persons", "Organizations", "V2Organizations", "AllNames",
]
BRONZE_COLUMNS = [
    "GKGRECORDID", "DATE", "gkg_datetime", "gkg_date", "stream", "SourceCollectionIdentifier",
    "SourceCommonName", "DocumentIdentifier", "V2Tone", "Counts", "V2Counts", "Themes", "V2Themes",
    "Locations", "V2Locations", "Persons", "V2Persons", "Organizations", "V2Organizations", "AllNames",
    "TranslationInfo", "Extras",
]
FILE_GLOB = "*.gkg.csv"

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in GKG_COLUMNS])


def read_raw_feed(spark: SparkSession, paths: list[str] | str, glob: str = FILE_GLOB,
                  base_path: str | None = None) -> DataFrame:
    """S1 + S2: explicit-schema TSV scan. Empty fields are NULL."""
    reader = (
        spark.read.schema(RAW_SCHEMA)
        .option("sep", "\t")
        .option("header", "false")
        .option("quote", "")
        .option("escape", "")
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", glob)
    )
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.csv(paths if isinstance(paths, list) else [paths])


_DATE_TEXT = "_feed_DATE_text"
FEED_READ_SCHEMA = StructType(
    [StructField(_DATE_TEXT if f.name == "DATE" else f.name, f.dataType, True) for f in RAW_SCHEMA.fields]
    + [StructField("date", DateType(), True), StructField("stream", StringType(), True)]
)


def restore_feed_columns(df: DataFrame) -> DataFrame:
    """Folder key ``date`` -> ``feed_date``; the text column back to ``DATE``."""
    return df.withColumnRenamed("date", "feed_date").withColumnRenamed(_DATE_TEXT, "DATE")


FEEDS = ["regular", "translation"]


def _days_glob(root: str, start, end) -> str:
    """One path pattern for the day folders of the range: the root is listed once, and the
    reader's own file index lists what lies below, in parallel where there is much of it."""
    first, last = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    days = ",".join((first + dt.timedelta(n)).isoformat() for n in range((last - first).days + 1))
    return f"{root.rstrip('/')}/date={{{days}}}"


def missing_feed_days(spark: SparkSession, root: str, start, end, streams: list[str] | None = None,
                      glob: str = FILE_GLOB) -> DataFrame:
    """The (feed_date, stream) pairs of the range without a feed file: the expected pairs
    less those seen in the paths of the files. No file is opened."""
    expected = spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("feed_date")).select(
        "feed_date", F.explode(F.array(*[F.lit(s) for s in streams or FEEDS])).alias("stream"))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(_days_glob(root, start, end)).select("path"))
    folder = r"/date=([0-9-]{10})/stream=([^/]+)/[^/]+$"
    seen = files.select(F.regexp_extract("path", folder, 1).try_cast("date").alias("feed_date"),
                        F.regexp_extract("path", folder, 2).alias("stream")).distinct()
    return expected.join(seen, ["feed_date", "stream"], "left_anti")


def _read_days(spark: SparkSession, root: str, start, end, streams: list[str] | None, glob: str) -> DataFrame:
    """S3 + S5: the range's files of the given feeds; folder names become ``feed_date`` and ``stream``.

    The folder key ``date`` equals the feed's own ``DATE`` column up to case, and
    Spark column names are case-insensitive, so the text column is read under a
    temporary name and renamed after the partition column became ``feed_date``.
    Folders of other feeds are pruned."""
    return restore_feed_columns(
        spark.read.schema(FEED_READ_SCHEMA)
        .option("sep", "\t").option("header", "false").option("quote", "").option("escape", "")
        .option("pathGlobFilter", glob)
        .option("basePath", root)
        .csv(_days_glob(root, start, end))
        .where(F.col("stream").isin(streams or FEEDS))
    )


def _nothing(root: str, start, end) -> FileNotFoundError:
    return FileNotFoundError(f"no feed files under {root} for {start}..{end}")


def _missing_pairs(spark: SparkSession, root: str, start, end, streams, glob) -> list:
    """The missing pairs, at most days times feeds; fails if no day folder exists."""
    try:
        return missing_feed_days(spark, root, start, end, streams, glob).orderBy("feed_date", "stream").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise _nothing(root, start, end) from e
        raise


def read_feed_range(spark: SparkSession, root: str, start, end, streams: list[str] | None = None,
                    glob: str = FILE_GLOB) -> DataFrame:
    """S3: every requested day and feed (default: both); fails if one of them has no file."""
    rows = _missing_pairs(spark, root, start, end, streams, glob)
    if rows:
        said = ", ".join(f"{r.feed_date}/{r.stream}" for r in rows)
        raise FileNotFoundError(f"{len(rows)} of the requested days and feeds have no files under {root}: {said}")
    return _read_days(spark, root, start, end, streams, glob)


def read_feed_range_lenient(spark: SparkSession, root: str, start, end, streams: list[str] | None = None,
                            glob: str = FILE_GLOB) -> tuple[DataFrame, DataFrame]:
    """What exists of the range, and the missing ``(feed_date, stream)`` pairs; fails
    only if nothing exists."""
    rows = _missing_pairs(spark, root, start, end, streams, glob)
    days = (dt.date.fromisoformat(str(end)) - dt.date.fromisoformat(str(start))).days + 1
    if len(rows) == days * len(streams or FEEDS):
        raise _nothing(root, start, end)
    return _read_days(spark, root, start, end, streams, glob), spark.createDataFrame(rows, "feed_date date, stream string")


def raw_rows_from_lines(lines: DataFrame, line_col: str = "line", keep: list[str] | None = None) -> DataFrame:
    """S1 for lines that are already a column: tab-split into the 27 raw columns
    (missing trailing fields -> NULL, empty -> NULL)."""
    parts = F.split(F.col(line_col), "\t", -1)
    return lines.select(
        *(keep or []),
        *[F.nullif(F.try_element_at(parts, F.lit(i + 1)), F.lit("")).alias(c) for i, c in enumerate(GKG_COLUMNS)],
    )


def source_tag_from_path(pattern: str = r"stream=([^/]+)") -> F.Column:
    """Feed name from the file path (for layouts without partition discovery)."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def scan_projected(spark: SparkSession, path: str, columns: list[str] = BRONZE_COLUMNS) -> DataFrame:
    """Parquet scan limited to the listed columns (``ReadSchema`` shows the pruning)."""
    return spark.read.parquet(path).select(*columns)
