"""Composed pipelines: raw feed -> bronze -> silver articles -> gold tables.

All stages stay lazy; one action per sink. Target entity, feeds and
thresholds are parameters whose defaults are the reference's values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from limelight.functions.text import first_number, source_language
from limelight.functions.urls import with_canonical_url
from limelight.operators.calendar import spine_left_joins
from limelight.operators.dedup import ARTICLE_ORDER, dedup_keep_first, dedup_with_metrics
from limelight.operators.filters import (
    any_column_contains,
    parse_timestamps,
    played_only,
    within_period,
)
from limelight.operators.metrics import (
    ARTICLE_SEGMENTS,
    conditional_max_pivot,
    daily_filtered_metrics,
    period_bounds,
    segment_weights,
    weekly_rollup,
)
from limelight.operators.salience import SALIENCE_COLUMNS, add_salience
from limelight.sources.raw_feed import BRONZE_COLUMNS, SEARCH_TEXT_COLUMNS

# Fixed values that must equal the reference for equal results.
REFERENCE_TOKEN = "mbapp"
REFERENCE_CANONICAL = "kylian mbappe"

# Output column names and their sources (fixed values as well).
ARTICLE_COLUMNS = [
    "GKGRECORDID", "gkg_datetime", "gkg_date", "stream", "SourceCommonName", "DocumentIdentifier",
    "canonical_url", "TranslationInfo", "source_language", "tone", "Themes", "V2Themes", "Persons",
    "V2Persons", "Organizations", "V2Organizations", "AllNames",
]

PAGEVIEW_COLUMNS = {"en": "wikipedia_en_views", "fr": "wikipedia_fr_views", "es": "wikipedia_es_views"}
TREND_COLUMNS = {
    "global": "google_trends_global_avg_interest",
    "fr": "google_trends_fr_avg_interest",
    "es": "google_trends_es_avg_interest",
}
MATCH_METRICS = {
    "total_time": "football_minutes",
    "goals": "football_goals",
    "penalties": "football_penalties",
    "missed_penalties": "football_missed_penalties",
    "yellow_cards": "football_yellow_cards",
    "red_cards": "football_red_cards",
}


def extract_candidates(raw: DataFrame, token: str = REFERENCE_TOKEN,
                       search_columns: list[str] = SEARCH_TEXT_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """P1 + P2 + F1 + F2 + P3: (bronze rows, rejected rows with unparseable timestamps)."""
    candidates = parse_timestamps(raw.filter(any_column_contains(search_columns, token)))
    good = candidates.filter(F.col("gkg_datetime").isNotNull()).select(*BRONZE_COLUMNS)
    bad = candidates.filter(F.col("gkg_datetime").isNull())
    return good, bad


def parse_timestamps_only(raw: DataFrame, token: str = REFERENCE_TOKEN,
                          search_columns: list[str] = SEARCH_TEXT_COLUMNS) -> DataFrame:
    """Candidate rows with parsed ``gkg_datetime``/``gkg_date`` (valid and invalid)."""
    return parse_timestamps(raw.filter(any_column_contains(search_columns, token)))


def extraction_counts(raw: DataFrame, token: str = REFERENCE_TOKEN,
                      search_columns: list[str] = SEARCH_TEXT_COLUMNS) -> DataFrame:
    """K10 as a query: output rows and rejected rows of one extraction, one pass."""
    candidates = parse_timestamps(raw.filter(any_column_contains(search_columns, token)))
    return candidates.agg(
        F.count_if(F.col("gkg_datetime").isNotNull()).alias("total_output_rows"),
        F.count_if(F.col("gkg_datetime").isNull()).alias("invalid_datetime_rows_skipped"),
    )


def process_articles(bronze: DataFrame, token: str = REFERENCE_TOKEN, canonical: str = REFERENCE_CANONICAL) -> DataFrame:
    """Bronze -> silver: canonical URL, keep-first dedup (W1), tone (F4),
    source language (F5), salience (F18); 17 base + 12 salience columns."""
    keyed = with_canonical_url(bronze, "DocumentIdentifier")
    return _enriched(dedup_keep_first(keyed, "canonical_url", ARTICLE_ORDER), token, canonical)


def process_articles_counted(bronze: DataFrame, token: str = REFERENCE_TOKEN,
                             canonical: str = REFERENCE_CANONICAL) -> tuple[DataFrame, Observation, Observation]:
    """``process_articles`` with the dedup counts (A25) observed during its action."""
    keyed = with_canonical_url(bronze, "DocumentIdentifier")
    unique, before, after = dedup_with_metrics(keyed, "canonical_url", ARTICLE_ORDER)
    return _enriched(unique, token, canonical), before, after


def _enriched(unique: DataFrame, token: str, canonical: str) -> DataFrame:
    enriched = unique.withColumns({
        "tone": first_number("V2Tone"),
        "source_language": source_language("TranslationInfo", "stream"),
    })
    scored = add_salience(enriched, token, canonical)
    return scored.select(*ARTICLE_COLUMNS, *SALIENCE_COLUMNS)


def daily_metrics(articles: DataFrame) -> DataFrame:
    """Gold 1 (A1/A2)."""
    return daily_filtered_metrics(articles)


def gold_daily(daily: DataFrame, pageviews: DataFrame, matches: DataFrame) -> DataFrame:
    """Gold 2 (J1): the pageview calendar is the spine; article metrics stay NULL
    on days without feed data; match metrics become 0 on days without a match."""
    views = conditional_max_pivot(pageviews, ["date"], "language", "views", PAGEVIEW_COLUMNS)
    football = played_only(matches).select(
        F.col("match_date").alias("date"),
        F.lit(1).alias("football_appearances"),
        *[F.col(src).alias(dst) for src, dst in MATCH_METRICS.items()],
    )
    zero = {"football_appearances": 0, **{c: 0 for c in MATCH_METRICS.values()}}
    joined = spine_left_joins(views, [daily, football], "date", zero)
    metric_cols = [c for c in daily.columns if c != "date"]
    return joined.select("date", *metric_cols, *PAGEVIEW_COLUMNS.values(), "football_appearances", *MATCH_METRICS.values())


def gold_weekly(daily_gold: DataFrame, trends: DataFrame, segments=ARTICLE_SEGMENTS) -> DataFrame:
    """Gold 3 (A4-A6, J2): Sunday weeks, weighted means, feed availability, interest."""
    measure_cols = [c for c in daily_gold.columns if c != "date"]
    weekly = weekly_rollup(
        daily_gold, measure_cols, segment_weights(segments),
        availability={"gdelt_days_available": "english_coverage"},
    )
    interest = conditional_max_pivot(trends, ["week_start"], "audience_scope", "interest", TREND_COLUMNS)
    return weekly.join(interest, "week_start", "left")


def gold_matches(matches: DataFrame, daily_gold: DataFrame) -> DataFrame:
    """Gold 5 (P5, A7, J4, P6): played matches inside the analysed period."""
    bounds = period_bounds(daily_gold, "date")
    played = played_only(matches).select(
        F.col("match_date").alias("date"), "competition", "team1", "score", "team2",
        F.col("total_time").alias("minutes"), "goals", "penalties", "missed_penalties", "yellow_cards", "red_cards",
    )
    return within_period(played, "date", bounds)
