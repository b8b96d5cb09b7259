"""Date and time column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from limelight.functions._util import col_of

FEED_TIMESTAMP_FORMAT = "yyyyMMddHHmmss"


def parse_feed_timestamp(value, fmt: str = FEED_TIMESTAMP_FORMAT) -> Column:
    """tolerant text -> TIMESTAMP; malformed text gives NULL instead of failing."""
    return F.try_to_timestamp(col_of(value), F.lit(fmt))


def to_day(value) -> Column:
    """timestamp -> DATE in the session time zone (UTC)."""
    return F.to_date(col_of(value))


def week_start(value) -> Column:
    """Sunday that starts the week of ``value`` (Spark: Sunday = 1)."""
    d = col_of(value).cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end(value) -> Column:
    """last day (Saturday) of a week that starts at ``value``."""
    return F.date_add(col_of(value).cast("date"), 6)


def add_days(value, days) -> Column:
    """general day shift; ``days`` may be a column."""
    return F.date_add(col_of(value).cast("date"), days if isinstance(days, Column) else F.lit(days))


def date_from_text(value) -> Column:
    """first ``YYYY/MM/DD`` inside free text as DATE, else NULL."""
    found = F.regexp_extract(col_of(value), r"(\d{4}/\d{2}/\d{2})", 1)
    return F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("yyyy/MM/dd")).cast("date")


def epoch_to_date(value) -> Column:
    """epoch seconds (text or number, UTC) -> DATE."""
    secs = col_of(value).try_cast("bigint")
    return F.to_date(F.timestamp_seconds(secs))


def format_date(value) -> Column:
    """DATE -> ``YYYY-MM-DD`` text."""
    return F.date_format(col_of(value), "yyyy-MM-dd")


def period_of(value, start, days: int) -> Column:
    """S17 row key: start day of the fixed ``days``-long interval that holds ``value``."""
    d = col_of(value).cast("date")
    s = F.lit(start).cast("date") if not isinstance(start, Column) else start.cast("date")
    return F.date_add(s, (F.floor(F.datediff(d, s) / days) * days).cast("int"))
