"""Collector payloads as DataFrames.

Payloads (one JSON document per request) arrive as a string column, one row per
payload, so many payloads parse in parallel. JSON is parsed once into a VARIANT; every
item is typed and judged on its own: ``*_items`` return one row per item with
``error_reason`` (NULL when valid), and one row for a payload that has no list. Strict
parsing (the default) raises on the first item or payload with a reason, as the reference
does; ``strict=False`` skips them, and ``*_rejects`` return them. Match rows arrive as raw
cell texts; typing, checks and rejects are JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limelight.functions._util import col_of
from limelight.functions.dates import date_from_text, epoch_to_date
from limelight.functions.text import dash_to_null, squeeze_whitespace, strict_int

# ---------------------------------------------------------------- JSON payloads

XSSI_GUARD = r"^\)\]\}'[^\n]*\n"
WHOLE = r"^[+-]?[0-9]+$"


def strip_xssi(value) -> Column:
    """Drop a leading ``)]}'`` guard line."""
    return F.regexp_replace(col_of(value), XSSI_GUARD, "")


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _whole(value: Column) -> Column:
    """A whole number, given as a number without fraction or as text of digits; else NULL."""
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "decimal(38,6)")
    fits = number == F.floor(number)
    return (F.when(_kind(value).rlike("^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$") & fits, number.try_cast("bigint"))
            .when((_kind(value) == "STRING") & F.trim(text).rlike(WHOLE), F.trim(text).try_cast("bigint")))


def _items(df: DataFrame, keep: list[str], body: Column, path: str, missing: str) -> DataFrame:
    """(keep..., item_no, _i, _listed): one row per element of the list at ``path``, one without an element where there is none."""
    parsed = df.select(*keep, F.try_variant_get(F.try_parse_json(body), path, "array<variant>").alias("_list"))
    # an empty list has no rows, a missing one a single row that says so
    rows = F.when(F.col("_list").isNull(), F.array(F.lit(None).cast("variant"))).otherwise(F.col("_list"))
    return (parsed.select(*keep, F.col("_list").isNotNull().alias("_listed"), F.posexplode(rows).alias("item_no", "_i"))
            .withColumn("item_no", F.when(F.col("_listed"), F.col("item_no")))
            .withColumn("_missing", F.when(~F.col("_listed"), F.lit(f"payload without {missing}"))))


def _good(items: DataFrame, columns: list[str], strict: bool) -> DataFrame:
    if strict:  # the reason is raised while the value is computed, so no row can leave without the check
        checked = F.when(F.col("error_reason").isNotNull(), F.raise_error(F.col("error_reason"))).otherwise(F.col(columns[-1]))
        return items.select(*columns[:-1], checked.alias(columns[-1]))
    return items.filter(F.col("error_reason").isNull()).select(*columns)


def pageview_items(df: DataFrame, col: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """``{"items": [{"timestamp": "YYYYMMDDHH", "views": n}]}`` -> (keep..., item_no, date, views, error_reason)."""
    rows = _items(df, keep or [], F.col(col), "$.items", "an items list")
    stamp = F.when(_kind(F.try_variant_get("_i", "$.timestamp", "variant")) == "STRING", F.try_variant_get("_i", "$.timestamp", "string"))
    date = F.when(stamp.rlike("^[0-9]{10}$"), F.try_to_timestamp(stamp, F.lit("yyyyMMddHH"))).cast("date")
    views = _whole(F.try_variant_get("_i", "$.views", "variant"))
    reason = F.coalesce("_missing", F.when(date.isNull(), "item without a valid timestamp"), F.when(views.isNull(), "item without whole views"))
    return rows.select(*(keep or []), "item_no", date.alias("date"), views.alias("views"), reason.alias("error_reason"))


def parse_pageviews(df: DataFrame, col: str = "payload", keep: list[str] | None = None, strict: bool = True) -> DataFrame:
    """(keep..., date, views) of every item."""
    return _good(pageview_items(df, col, keep), [*(keep or []), "date", "views"], strict)


def pageview_rejects(df: DataFrame, col: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """Items that are not valid, and payloads without an ``items`` list (item_no NULL)."""
    return pageview_items(df, col, keep).filter(F.col("error_reason").isNotNull())


def timeline_items(df: DataFrame, col: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """S11 + F29: ``default.timelineData[]`` -> (keep..., item_no, week_start, interest, error_reason): epoch
    seconds (UTC) to a date, first value as the interest."""
    rows = _items(df, keep or [], strip_xssi(col), "$.default.timelineData", "a timelineData list")
    seconds = _whole(F.try_variant_get("_i", "$.time", "variant"))
    week = F.when(seconds.between(-62135596800, 253402300799), epoch_to_date(seconds))  # years 1 to 9999
    interest = _whole(F.try_variant_get("_i", "$.value[0]", "variant"))
    reason = F.coalesce("_missing", F.when(week.isNull(), "point without a valid time"), F.when(interest.isNull(), "point without a whole first value"))
    return rows.select(*(keep or []), "item_no", week.alias("week_start"), interest.alias("interest"), reason.alias("error_reason"))


def parse_timeline(df: DataFrame, col: str = "payload", keep: list[str] | None = None, strict: bool = True) -> DataFrame:
    """S11 + F29: (keep..., week_start, interest) of every point."""
    return _good(timeline_items(df, col, keep), [*(keep or []), "week_start", "interest"], strict)


def timeline_rejects(df: DataFrame, col: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """Points that are not valid, and payloads without a ``default.timelineData`` list (item_no NULL)."""
    return timeline_items(df, col, keep).filter(F.col("error_reason").isNotNull())


def select_widget(df: DataFrame, col: str = "payload", widget_id: str = "TIMESERIES", resolution: str = "WEEK") -> DataFrame:
    """S12 + Q5: first widget with ``id = widget_id`` (NULL when absent), whether its declared
    resolution is ``resolution``, and ``error_reason`` (NULL when it is there, has a token and that resolution)."""
    widgets = F.coalesce(F.try_variant_get(F.try_parse_json(strip_xssi(col)), "$.widgets", "array<variant>"), F.array().cast("array<variant>"))
    text = lambda v, path: F.try_variant_get(v, path, "string")
    chosen = F.try_element_at(F.filter(widgets, lambda w: text(w, "$.id") == F.lit(widget_id)), F.lit(1))
    out = df.withColumn("_w", chosen)
    weekly = F.coalesce(text(F.col("_w"), "$.request.resolution") == F.lit(resolution), F.lit(False))
    reason = (F.when(F.col("_w").isNull(), F.lit(f"response without a {widget_id} widget"))
              .when(text(F.col("_w"), "$.token").isNull() | F.try_variant_get("_w", "$.request", "variant").isNull(), F.lit("widget without request or token"))
              .when(~weekly, F.concat(F.lit(f"resolution is not {resolution} but "), F.coalesce(text(F.col("_w"), "$.request.resolution"), F.lit("missing")))))
    return out.withColumns({
        "widget_token": text(F.col("_w"), "$.token"),
        "widget_resolution": text(F.col("_w"), "$.request.resolution"),
        "widget_found": F.col("_w").isNotNull(),
        "weekly_resolution": weekly,
        "error_reason": reason,
    }).drop("_w")


def require_widget(df: DataFrame, col: str = "payload", widget_id: str = "TIMESERIES", resolution: str = "WEEK") -> DataFrame:
    """S12 + Q5, strict: (columns of ``df``, widget_token); raises where ``select_widget`` gives a reason."""
    chosen = select_widget(df, col, widget_id, resolution)
    token = F.when(F.col("error_reason").isNotNull(), F.raise_error(F.col("error_reason"))).otherwise(F.col("widget_token"))
    return chosen.select(*df.columns, token.alias("widget_token"))


# ---------------------------------------------------------------- HTML

def html_fields(df: DataFrame, col: str = "html") -> DataFrame:
    """Simple page fields with regular expressions: title, first h1, number of
    ``<a href>`` links and the document language."""
    h = F.col(col)
    return df.withColumns({
        "title": F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1),
        "h1": F.regexp_extract(h, r"(?is)<h1[^>]*>(.*?)</h1>", 1),
        "links": F.size(F.regexp_extract_all(h, F.lit(r'(?is)<a\s[^>]*href="([^"]*)"'), F.lit(1))).cast("bigint"),
        "lang": F.regexp_extract(h, r'(?is)<html[^>]*\slang="([^"]*)"', 1),
    })


# Fixed values that must equal the reference for equal results.
METRIC_NAME_BY_TITLE = {
    "total time": "total_time",
    "average time": "average_time",
    "goal": "goals",
    "penalty": "penalties",
    "missing penalty": "missed_penalties",
    "yellow card": "yellow_cards",
    "red card": "red_cards",
}
EVENT_METRICS = ["goals", "penalties", "missed_penalties", "yellow_cards", "red_cards"]
MATCH_COLUMNS = ["competition", "match_date", "team1", "score", "team2", "total_time", *EVENT_METRICS]
RAW_MATCH_SCHEMA = (
    "payload_id string, competition string, date_text string, team1 string, score string, team2 string, "
    "total_time_raw string, goals_raw string, penalties_raw string, missed_penalties_raw string, "
    "yellow_cards_raw string, red_cards_raw string, parse_error string"
)
# The competition left out by default is a fixed value too.
EXCLUDED_COMPETITION = "UEFA Youth League"


def metric_name(title) -> Column:
    """a column heading (any case and spacing) to its metric; unknown headings -> NULL."""
    lookup = F.create_map(*[F.lit(x) for pair in METRIC_NAME_BY_TITLE.items() for x in pair])
    return F.try_element_at(lookup, F.lower(squeeze_whitespace(title)))


def type_match_rows(raw: DataFrame) -> DataFrame:
    """F24-F28 + Q6: typed match columns plus ``error_reason`` (NULL when valid):
    digits-only metrics, ``-`` minutes means unplayed and needs all events 0,
    score ``n:m``, a date in the first cell."""
    metric = {m: strict_int(F.col(f"{m}_raw")) for m in EVENT_METRICS}
    unplayed = F.coalesce(squeeze_whitespace("total_time_raw") == "-", F.lit(False))
    total = strict_int(dash_to_null("total_time_raw"))
    reason = (
        F.when(F.col("parse_error").isNotNull(), F.col("parse_error"))
        .when(~F.coalesce(squeeze_whitespace("score").rlike(r"^\d+:\d+$"), F.lit(False)), F.lit("bad score"))
        .when(date_from_text("date_text").isNull(), F.lit("no date"))
        .when(~unplayed & total.isNull(), F.lit("bad total_time"))
    )
    for m in EVENT_METRICS:
        reason = reason.when(metric[m].isNull(), F.lit(f"bad {m}"))
    reason = reason.when(unplayed & (sum((metric[m] for m in EVENT_METRICS), F.lit(0)) != 0),
                         F.lit("unplayed match with events"))
    return raw.select(
        "payload_id",
        squeeze_whitespace("competition").alias("competition"),
        date_from_text("date_text").alias("match_date"),
        squeeze_whitespace("team1").alias("team1"),
        squeeze_whitespace("score").alias("score"),
        squeeze_whitespace("team2").alias("team2"),
        total.alias("total_time"),
        *[metric[m].alias(m) for m in EVENT_METRICS],
        reason.alias("error_reason"),
    )


def typed_matches(raw: DataFrame, exclude_competition: str | None = EXCLUDED_COMPETITION,
                  strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Raw cell texts (RAW_MATCH_SCHEMA) to (valid matches without the excluded
    competition, rejected rows). ``strict`` raises on the first rejected row."""
    typed = type_match_rows(raw)
    bad = typed.filter(F.col("error_reason").isNotNull())
    if strict:
        first = bad.select("payload_id", "error_reason").limit(1).collect()
        if first:
            raise ValueError(f"payload {first[0].payload_id}: {first[0].error_reason}")
    good = typed.filter(F.col("error_reason").isNull())
    if exclude_competition is not None:
        good = good.filter(~F.col("competition").eqNullSafe(F.lit(exclude_competition)))
    return good.select(*MATCH_COLUMNS), bad
