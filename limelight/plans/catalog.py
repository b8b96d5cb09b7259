"""Registered queries: one per operator family of the inventory, each with its
DuckDB oracle SQL. Every query reads the given test tables (or views Spark
derives from them) whole: no id subsets, samples or row caps. Doubles are
rounded to 6 digits on both sides so the order of floating-point sums across
engines does not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from limelight.operators.spikes import REFERENCE_CONTEXT, REFERENCE_SIGNALS
from limelight.plans import oracle as O
from limelight.plans import pipeline as P
from limelight.plans import testdata as T

DIGITS = 6


@dataclass
class Query:
    name: str
    ids: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, ids, fn, sql)
        return fn

    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every DOUBLE/FLOAT column (reporting precision for cross-engine checks)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def r(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, {DIGITS}) AS {alias or expr}"


# ---------------------------------------------------------------- shared Spark stages

def bronze(spark, sf):
    return P.extract_candidates(T.raw_feed(spark, sf), T.TOKEN)[0]


def articles(spark, sf):
    return P.process_articles(bronze(spark, sf), T.TOKEN, T.CANONICAL)


def gold_daily(spark, sf):
    return P.gold_daily(P.daily_metrics(articles(spark, sf)), T.pageviews(spark, sf), T.matches(spark, sf))


def gold_weekly(spark, sf):
    return P.gold_weekly(gold_daily(spark, sf), T.trends(spark, sf))


def gold_matches(spark, sf):
    return P.gold_matches(T.matches(spark, sf), gold_daily(spark, sf))


SILVER = O.silver_ctes()
GOLD = O.gold_ctes()


# ---------------------------------------------------------------- extraction / silver

@register("candidate_filter", "P1 P3", """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE text ILIKE '%ente%' OR source ILIKE '%ente%' OR lang ILIKE '%ente%'
""")
def q_candidate_filter(spark, sf):
    from limelight.operators.filters import filter_candidates
    docs = T.table(spark, sf, "documents")
    return filter_candidates(docs, ["text", "source", "lang"], T.TOKEN).select("doc_id", "lang", "source", "n_chars")


@register("extract_candidates", "P1 P2 F1 F2 P3",
          O.with_ctes(O.raw_feed_cte(), O.candidates_cte(), O.bronze_cte()) + """
SELECT GKGRECORDID, gkg_datetime, gkg_date, stream, SourceCommonName, DocumentIdentifier, V2Tone, TranslationInfo,
  length(AllNames) AS all_names_chars, length(V2Persons) AS persons_chars
FROM bronze""")
def q_extract_candidates(spark, sf):
    return bronze(spark, sf).select(
        "GKGRECORDID", "gkg_datetime", "gkg_date", "stream", "SourceCommonName", "DocumentIdentifier", "V2Tone",
        "TranslationInfo", F.length("AllNames").cast("bigint").alias("all_names_chars"),
        F.length("V2Persons").cast("bigint").alias("persons_chars"),
    )


@register("extraction_counts", "K10 P2", O.with_ctes(O.raw_feed_cte(), O.candidates_cte()) + """
SELECT count(*) FILTER (WHERE gkg_datetime IS NOT NULL) AS total_output_rows,
  count(*) FILTER (WHERE gkg_datetime IS NULL) AS invalid_datetime_rows_skipped
FROM candidates""")
def q_extraction_counts(spark, sf):
    return P.extraction_counts(T.raw_feed(spark, sf), T.TOKEN)


URLS_SQL = """urls AS (
  SELECT page_id, 0 AS variant, url FROM pages
  UNION ALL
  SELECT page_id, 1 AS variant, regexp_replace(url, '^(https?://)', '\\1WWW.') || '#dup' AS url FROM pages
)"""


@register("canonical_url", "F3", O.with_ctes(URLS_SQL) + f"""
SELECT page_id, variant, url, {O.canonical_url('url')} AS canonical_url FROM urls""")
def q_canonical_url(spark, sf):
    from limelight.functions.urls import canonicalize_url
    return T.url_variants(spark, sf).withColumn("canonical_url", canonicalize_url("url"))


@register("dedup_canonical", "W1", O.with_ctes(URLS_SQL) + f"""
SELECT page_id, variant, url, canonical_url FROM (
  SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY page_id ASC NULLS LAST, variant ASC NULLS LAST) AS rn
  FROM (SELECT *, {O.canonical_url('url')} AS canonical_url FROM urls) WHERE canonical_url IS NOT NULL
) WHERE rn = 1
UNION ALL SELECT page_id, variant, url, canonical_url FROM (SELECT *, {O.canonical_url('url')} AS canonical_url FROM urls)
WHERE canonical_url IS NULL""")
def q_dedup_canonical(spark, sf):
    from limelight.functions.urls import canonicalize_url
    from limelight.operators.dedup import dedup_keep_first
    keyed = T.url_variants(spark, sf).withColumn("canonical_url", canonicalize_url("url"))
    return dedup_keep_first(keyed, "canonical_url", ["page_id", "variant"])


@register("dedup_metrics", "A25", O.with_ctes(*SILVER[:3]) + f"""
SELECT count(*) AS candidate_rows,
  count(*) - (count(DISTINCT ck) + count(*) FILTER (WHERE ck IS NULL)) AS removed_rows,
  count(DISTINCT ck) + count(*) FILTER (WHERE ck IS NULL) AS retained_rows
FROM (SELECT {O.canonical_url('DocumentIdentifier')} AS ck FROM bronze)""")
def q_dedup_metrics(spark, sf):
    from limelight.functions.urls import canonicalize_url
    from limelight.operators.dedup import dedup_counts
    return dedup_counts(bronze(spark, sf).withColumn("canonical_url", canonicalize_url("DocumentIdentifier")), "canonical_url")


@register("source_language", "F5", O.with_ctes(O.raw_feed_cte()) + f"""
SELECT GKGRECORDID, stream, TranslationInfo,
  CASE WHEN stream = 'translation' THEN
    coalesce(nullif(regexp_extract(lower({O.strip_ws('TranslationInfo')}), '\\bsrclc:([a-z]{{2,3}})\\b', 1), ''), 'unknown')
  ELSE 'eng' END AS source_language
FROM raw_feed""")
def q_source_language(spark, sf):
    from limelight.functions.text import source_language
    return T.raw_feed(spark, sf).select(
        "GKGRECORDID", "stream", "TranslationInfo", source_language("TranslationInfo", "stream").alias("source_language"))


@register("first_number", "F4", O.with_ctes(O.raw_feed_cte()) + f"""
SELECT GKGRECORDID, V2Tone, {r("TRY_CAST(split_part(V2Tone, ',', 1) AS DOUBLE)", "tone")},
  TRY_CAST(split_part(SourceCommonName, ',', 1) AS DOUBLE) AS source_number
FROM raw_feed""")
def q_first_number(spark, sf):
    from limelight.functions.text import first_number
    return rounded(T.raw_feed(spark, sf).select(
        "GKGRECORDID", "V2Tone", first_number("V2Tone").alias("tone"),
        first_number("SourceCommonName").alias("source_number")))


@register("offset_entries", "F6 F11", O.with_ctes(O.raw_feed_cte()) + f"""
SELECT GKGRECORDID,
  CAST(len(p) AS BIGINT) AS person_entries, CAST(len(n) AS BIGINT) AS name_entries,
  list_max(list_transform(n, lambda e: e.offset)) AS max_name_offset,
  list_min(list_transform(list_filter(list_concat(p, n), lambda e: instr(e.name, 'ente') > 0), lambda e: e.offset)) AS first_token_offset,
  CAST(len(list_distinct(list_transform(n, lambda e: e.name))) AS BIGINT) AS distinct_names
FROM (SELECT GKGRECORDID, {O.parse_entries('V2Persons')} AS p, {O.parse_entries('AllNames')} AS n FROM raw_feed)""")
def q_offset_entries(spark, sf):
    from limelight.functions.entities import is_target_name, names_of, offsets_of, parse_offset_entries
    df = T.raw_feed(spark, sf).select("GKGRECORDID", parse_offset_entries("V2Persons").alias("p"),
                                      parse_offset_entries("AllNames").alias("n"))
    return df.select(
        "GKGRECORDID",
        F.size("p").cast("bigint").alias("person_entries"),
        F.size("n").cast("bigint").alias("name_entries"),
        F.array_max(offsets_of("n")).alias("max_name_offset"),
        F.array_min(offsets_of(F.filter(F.concat("p", "n"), lambda e: is_target_name(e["name"], T.TOKEN)))).alias("first_token_offset"),
        F.size(F.array_distinct(names_of("n"))).cast("bigint").alias("distinct_names"),
    )


@register("normalize_names", "F7 F8 F9 A23", O.with_ctes(O.raw_feed_cte()) + f"""
SELECT GKGRECORDID, CAST(len(nc) AS BIGINT) AS normalized_names,
  CAST(len(list_distinct(nc)) AS BIGINT) AS distinct_normalized,
  CAST(len(list_filter(nc, lambda x: x = 'ente')) AS BIGINT) AS target_mentions,
  CAST({O.max_mult('nc')} AS BIGINT) AS max_multiplicity
FROM (SELECT GKGRECORDID, {O.normalize_names(O.parse_entries('AllNames'))} AS nc FROM raw_feed)""")
def q_normalize_names(spark, sf):
    from limelight.functions.entities import count_of, max_multiplicity, names_of, normalize_targets, parse_offset_entries
    df = T.raw_feed(spark, sf).select(
        "GKGRECORDID", normalize_targets(names_of(parse_offset_entries("AllNames")), T.TOKEN, T.CANONICAL).alias("nc"))
    return df.select(
        "GKGRECORDID",
        F.size("nc").cast("bigint").alias("normalized_names"),
        F.size(F.array_distinct("nc")).cast("bigint").alias("distinct_normalized"),
        count_of("nc", T.CANONICAL).cast("bigint").alias("target_mentions"),
        max_multiplicity("nc").cast("bigint").alias("max_multiplicity"),
    )


SALIENCE_OUT = ["url_player_signal", "lead_player_signal", "lead_or_url_signal", "first_player_offset",
                "max_entity_offset", "position_score", "player_mentions", "max_mentions_of_any_person",
                "density_score", "rank_score", "salience_score", "salience_class"]
DOUBLE_SALIENCE = {"url_player_signal", "lead_player_signal", "lead_or_url_signal", "position_score",
                   "density_score", "rank_score", "salience_score"}


@register("salience", "F10-F18", O.with_ctes(*SILVER) + "SELECT GKGRECORDID, canonical_url, " + ", ".join(
    r(c) if c in DOUBLE_SALIENCE else c for c in SALIENCE_OUT) + " FROM articles")
def q_salience(spark, sf):
    return rounded(articles(spark, sf).select("GKGRECORDID", "canonical_url", *SALIENCE_OUT))


@register("process_articles", "W1 F3 F4 F5 F18", O.with_ctes(*SILVER) + f"""
SELECT GKGRECORDID, gkg_datetime, gkg_date, stream, SourceCommonName, DocumentIdentifier, canonical_url,
  TranslationInfo, source_language, {r('tone')}, {r('salience_score')}, salience_class
FROM articles""")
def q_process_articles(spark, sf):
    return rounded(articles(spark, sf).select(
        "GKGRECORDID", "gkg_datetime", "gkg_date", "stream", "SourceCommonName", "DocumentIdentifier", "canonical_url",
        "TranslationInfo", "source_language", "tone", "salience_score", "salience_class"))


QC_SCORE_SQL = """count(*) FILTER (WHERE salience_score IS NOT NULL) AS rows_with_salience_score,
  count(*) FILTER (WHERE salience_score IS NULL) AS rows_without_salience_score,
  count(*) FILTER (WHERE salience_score IS NOT NULL AND NOT (salience_score BETWEEN 0.0 AND 1.0)) AS salience_score_out_of_range_rows,
  count(*) FILTER (WHERE salience_score IS NOT NULL AND salience_class = 'high_salience') AS high_salience_rows,
  count(*) FILTER (WHERE salience_score IS NOT NULL AND salience_class = 'medium_salience') AS medium_salience_rows,
  count(*) FILTER (WHERE salience_score IS NOT NULL AND salience_class = 'low_salience') AS low_salience_rows"""


@register("dataset_qc", "A14", O.with_ctes(*SILVER) + """
SELECT count(*) AS rows, count(DISTINCT DocumentIdentifier) AS unique_documents,
  count(DISTINCT SourceCommonName) AS unique_sources,
  count(*) FILTER (WHERE stream = 'regular') AS regular_rows, count(*) FILTER (WHERE stream = 'translation') AS translation_rows,
  min(gkg_date) AS min_gkg_date, max(gkg_date) AS max_gkg_date,
  count(*) FILTER (WHERE DocumentIdentifier IS NULL) AS missing_document_identifier_rows,
  count(*) - count(DISTINCT DocumentIdentifier) AS duplicate_document_rows
FROM articles""")
def q_dataset_qc(spark, sf):
    from limelight.operators.quality import dataset_qc
    return dataset_qc(articles(spark, sf))


@register("feed_qc", "A15 A16", O.with_ctes(*SILVER) + f"""
SELECT stream, count(*) AS rows, count(DISTINCT DocumentIdentifier) AS unique_documents,
  count(DISTINCT SourceCommonName) AS unique_sources, min(gkg_date) AS min_gkg_date, max(gkg_date) AS max_gkg_date,
  count(*) FILTER (WHERE DocumentIdentifier IS NULL) AS missing_document_identifier_rows,
  count(*) FILTER (WHERE tone IS NULL) AS missing_tone_rows,
  {QC_SCORE_SQL}
FROM articles GROUP BY stream""")
def q_feed_qc(spark, sf):
    from limelight.operators.quality import feed_qc
    return feed_qc(articles(spark, sf))


@register("score_qc", "A16", O.with_ctes(*SILVER) + f"SELECT {QC_SCORE_SQL} FROM articles")
def q_score_qc(spark, sf):
    from limelight.operators.quality import score_qc
    return score_qc(articles(spark, sf))


# ---------------------------------------------------------------- gold

DAILY_COLS = O.daily_metric_columns()


def _round_cols(cols, skip=()):
    return ", ".join(c if (c in skip or c.endswith("_coverage") or c.startswith("football") or "views" in c
                           or c in ("days_in_period", "gdelt_days_available") or "interest" in c) else r(c) for c in cols)


@register("daily_article_metrics", "A1 A2 P9", O.with_ctes(*SILVER, O.daily_cte()) +
          f"SELECT date, {_round_cols(DAILY_COLS)} FROM daily")
def q_daily_article_metrics(spark, sf):
    return rounded(P.daily_metrics(articles(spark, sf)))


@register("pageviews_dense", "J5 S16", O.with_ctes(O.event_bounds_cte(), O.spine_cte(), O.pageviews_cte()) +
          "SELECT date, language, article_url, views FROM pageviews")
def q_pageviews_dense(spark, sf):
    return T.pageviews(spark, sf)


@register("pivot_by_key", "A3", """
SELECT CAST(ts AS DATE) AS date,
  max(value) FILTER (WHERE event_type = 'click') AS click_max,
  max(value) FILTER (WHERE event_type = 'view') AS view_max,
  max(value) FILTER (WHERE event_type = 'purchase') AS purchase_max,
  max(value) FILTER (WHERE event_type = 'signup') AS signup_max,
  max(value) FILTER (WHERE event_type = 'error') AS error_max
FROM events GROUP BY 1""")
def q_pivot_by_key(spark, sf):
    from limelight.operators.metrics import conditional_max_pivot
    e = T.table(spark, sf, "events").withColumn("date", F.col("ts").cast("date"))
    mapping = {t: f"{t}_max" for t in ["click", "view", "purchase", "signup", "error"]}
    return conditional_max_pivot(e, ["date"], "event_type", "value", mapping)


GOLD_DAILY_COLS = ["date"] + DAILY_COLS + ["wikipedia_en_views", "wikipedia_fr_views", "wikipedia_es_views",
                                           "football_appearances"] + [d for _, d in O.MATCH_METRICS_SQL]


@register("daily_spine_join", "J1 F23 P5", O.with_ctes(*GOLD) + f"SELECT {_round_cols(GOLD_DAILY_COLS, ('date',))} FROM gold_daily")
def q_daily_spine_join(spark, sf):
    return rounded(gold_daily(spark, sf))


@register("weekly_weighted_rollup", "F19 A4 A5 A6 J2", O.with_ctes(*GOLD) + "SELECT * REPLACE (" + ", ".join(
    f"round({c}, {DIGITS}) AS {c}" for c in DAILY_COLS if not c.endswith("_coverage")) + ") FROM gold_weekly")
def q_weekly_weighted_rollup(spark, sf):
    df = gold_weekly(spark, sf)
    return rounded(df.withColumns({c: F.col(c).cast("bigint") for c in df.columns
                                   if c.endswith("_coverage") or c.startswith("football") or c.endswith("_views")}))


SIGNAL_UNION = " UNION ALL ".join(
    f"SELECT week_start, '{s}' AS signal, CASE WHEN {g} THEN CAST({c} AS DOUBLE) END AS signal_value FROM gold_weekly"
    for s, c, g in [
        ("gdelt_english_coverage", "english_coverage", "days_in_period = 7 AND gdelt_days_available = 7"),
        ("gdelt_french_coverage", "translated_french_coverage", "days_in_period = 7 AND gdelt_days_available = 7"),
        ("gdelt_spanish_coverage", "translated_spanish_coverage", "days_in_period = 7 AND gdelt_days_available = 7"),
        ("wikipedia_en_views", "wikipedia_en_views", "days_in_period = 7"),
        ("wikipedia_fr_views", "wikipedia_fr_views", "days_in_period = 7"),
        ("wikipedia_es_views", "wikipedia_es_views", "days_in_period = 7"),
        ("google_trends_global_interest", "google_trends_global_avg_interest", "days_in_period = 7"),
        ("google_trends_fr_interest", "google_trends_fr_avg_interest", "days_in_period = 7"),
        ("google_trends_es_interest", "google_trends_es_avg_interest", "days_in_period = 7"),
    ])


@register("signals_long", "U1 P7", O.with_ctes(*GOLD) + SIGNAL_UNION)
def q_signals_long(spark, sf):
    from limelight.operators.spikes import REFERENCE_SIGNALS, signals_long
    return signals_long(gold_weekly(spark, sf), REFERENCE_SIGNALS)


@register("period_bounds_filter", "A7 J4 P6 P5", O.with_ctes(*GOLD) + "SELECT * FROM gold_matches")
def q_period_bounds_filter(spark, sf):
    return gold_matches(spark, sf)


# ---------------------------------------------------------------- spikes

SPIKE_COLS = ["week_start", "week_end", "signal_group", "signal", "signal_value", "baseline_observations",
              "baseline_median", "spike_threshold", "spike_ratio"]
SPIKE_SELECT = ", ".join(r(c) if c in ("signal_value", "baseline_median", "spike_threshold", "spike_ratio") else c
                         for c in SPIKE_COLS)


def nation_spikes(spark, sf):
    from limelight.operators.spikes import spikes_from_long
    return spikes_from_long(T.weekly_nation_signals(spark, sf))


@register("weekly_spikes", "W2 W3 P8 F20 F22",
          O.with_ctes(O.weekly_nation_cte(), O.spikes_sql_cte("nation_weekly", "week_start")) + f"SELECT {SPIKE_SELECT} FROM spikes")
def q_weekly_spikes(spark, sf):
    return rounded(nation_spikes(spark, sf))


@register("hourly_spikes", "W2 W3 P8", O.with_ctes("""hourly AS (
  SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS hour_start, event_type AS signal, max(value) AS signal_value
  FROM events GROUP BY ALL)""", O.spikes_sql_cte("hourly", "hour_start", week_end=False)) +
          "SELECT hour_start, signal_group, signal, " + ", ".join(
              r(c) if c in ("signal_value", "baseline_median", "spike_threshold", "spike_ratio") else c
              for c in SPIKE_COLS[4:]) + " FROM spikes")
def q_hourly_spikes(spark, sf):
    from limelight.operators.spikes import spikes_from_long
    return rounded(spikes_from_long(T.hourly_event_signals(spark, sf), order="hour_start", with_week_end=False, chunk=F.to_date("hour_start")))


CONTEXT_SELECT = ", ".join(f"round(CAST(w.{c} AS DOUBLE), {DIGITS}) AS {c}" if c.endswith(("_tone", "_share")) else f"w.{c}" for c in REFERENCE_CONTEXT)
ORDER_SIGNALS_SQL = "order_signals AS (" + " UNION ALL ".join(
    f"SELECT week_start, '{s.signal}' AS signal, CASE WHEN {s.gate} THEN CAST({s.column} AS DOUBLE) END AS signal_value FROM weekly_orders"
    for s in REFERENCE_SIGNALS) + ")"


@register("detect_spikes", "U1 P7 W2 W3 P8 J3 F20 F21 F22", O.with_ctes(
    O.weekly_orders_cte(), ORDER_SIGNALS_SQL, O.spikes_sql_cte("order_signals", "week_start")) + f"""
SELECT {", ".join(r("s." + c, c) if c in ("signal_value", "baseline_median", "spike_threshold", "spike_ratio") else "s." + c for c in SPIKE_COLS)}, {CONTEXT_SELECT}
FROM spikes s JOIN weekly_orders w USING (week_start)""")
def q_detect_spikes(spark, sf):
    from limelight.operators.spikes import detect_spikes
    return rounded(detect_spikes(T.weekly_orders(spark, sf)))


NATION_WEEK_TOTALS_SQL = """week_totals AS (
  SELECT week_start, count(*) AS week_orders, round(sum(o_totalprice), 2) AS week_total
  FROM (SELECT o_totalprice, CAST(CAST(o_orderdate AS DATE) - CAST(dayofweek(CAST(o_orderdate AS DATE)) AS INTEGER) AS DATE) AS week_start FROM orders)
  GROUP BY week_start)"""


def week_totals(spark, sf):
    from limelight.functions.dates import week_start
    o = T.table(spark, sf, "orders")
    return o.groupBy(week_start(F.col("o_orderdate").cast("date")).alias("week_start")).agg(
        F.count(F.lit(1)).alias("week_orders"), F.round(F.sum("o_totalprice"), 2).alias("week_total"))


@register("spike_context", "J3", O.with_ctes(O.weekly_nation_cte(), O.spikes_sql_cte("nation_weekly", "week_start"),
                                             NATION_WEEK_TOTALS_SQL) +
          f"SELECT {SPIKE_SELECT}, week_orders, {r('week_total')} FROM spikes JOIN week_totals USING (week_start)")
def q_spike_context(spark, sf):
    from limelight.operators.spikes import spike_context
    return rounded(spike_context(nation_spikes(spark, sf), week_totals(spark, sf), ["week_orders", "week_total"]))


SPIKE_SUMMARY_SQL = """summary AS (
  SELECT week_start, count(DISTINCT signal_group) AS signal_groups, count(*) AS signals,
    max(coalesce(spike_ratio, 0)) AS max_ratio
  FROM spikes GROUP BY week_start)"""
NATION_SPIKES = [O.weekly_nation_cte(), O.spikes_sql_cte("nation_weekly", "week_start")]


@register("spike_week_summary", "A21", O.with_ctes(*NATION_SPIKES, SPIKE_SUMMARY_SQL) +
          f"SELECT week_start, signal_groups, signals, {r('max_ratio')} FROM summary")
def q_spike_week_summary(spark, sf):
    from limelight.operators.spikes import spike_week_summary
    return rounded(spike_week_summary(nation_spikes(spark, sf)))


@register("top_spike_weeks", "O2", O.with_ctes(*NATION_SPIKES, SPIKE_SUMMARY_SQL) + f"""
SELECT week_start, signal_groups, signals, {r('max_ratio')} FROM summary
ORDER BY signal_groups DESC, signals DESC, max_ratio DESC, week_start ASC LIMIT 5""")
def q_top_spike_weeks(spark, sf):
    from limelight.operators.spikes import top_spike_weeks
    return rounded(top_spike_weeks(nation_spikes(spark, sf)))


@register("top_signals_per_week", "O3", O.with_ctes(*NATION_SPIKES, SPIKE_SUMMARY_SQL) + f"""
SELECT {SPIKE_SELECT}, signal_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY week_start ORDER BY coalesce(spike_ratio, 0) DESC, signal ASC) AS signal_rank
  FROM spikes WHERE week_start IN (
    SELECT week_start FROM summary ORDER BY signal_groups DESC, signals DESC, max_ratio DESC, week_start ASC LIMIT 5))
WHERE signal_rank <= 3""")
def q_top_signals_per_week(spark, sf):
    from limelight.operators.spikes import top_signals_per_week, top_spike_weeks
    spikes = nation_spikes(spark, sf)
    out = top_signals_per_week(spikes, top_spike_weeks(spikes))
    return rounded(out.withColumn("signal_rank", F.col("signal_rank").cast("bigint")))


LANES = [f"NATION_{i}" for i in range(0, 25, 2)]


@register("signal_in_lanes", "P13", O.with_ctes(*NATION_SPIKES) + f"""
SELECT {SPIKE_SELECT}, lane FROM spikes JOIN (SELECT * FROM (VALUES {", ".join(f"('{s}', {i})" for i, s in enumerate(LANES))}) t(signal, lane)) USING (signal)""")
def q_signal_in_lanes(spark, sf):
    from limelight.operators.filters import signal_in_lanes
    return rounded(signal_in_lanes(nation_spikes(spark, sf), LANES))


@register("peak_lookup", "J8", O.with_ctes(*NATION_SPIKES) + f"""
SELECT {SPIKE_SELECT}, {r('CASE WHEN p.series_peak IS NOT NULL AND p.series_peak <> 0 THEN s.signal_value / p.series_peak * 100.0 ELSE s.signal_value END', 'display_value')}
FROM spikes s LEFT JOIN (SELECT signal, max(coalesce(signal_value, 0)) AS series_peak FROM nation_weekly GROUP BY signal) p USING (signal)""")
def q_peak_lookup(spark, sf):
    from limelight.operators.spikes import peak_lookup_long
    return rounded(peak_lookup_long(nation_spikes(spark, sf), T.weekly_nation_signals(spark, sf)))


# ---------------------------------------------------------------- dashboard analytics

@register("kpi_totals", "A18", O.with_ctes(*GOLD) + """
SELECT CAST(sum(coalesce(english_coverage, 0) + coalesce(translated_french_coverage, 0) + coalesce(translated_spanish_coverage, 0)) AS BIGINT) AS articles,
  CAST(sum(coalesce(wikipedia_en_views, 0) + coalesce(wikipedia_fr_views, 0) + coalesce(wikipedia_es_views, 0)) AS BIGINT) AS views,
  CAST(sum(coalesce(football_goals, 0)) AS BIGINT) AS goals, count(*) AS weeks,
  CAST(arg_min(week_start, week_start) + CAST(CASE WHEN arg_min(days_in_period, week_start) = 7 THEN 0 ELSE 7 - arg_min(days_in_period, week_start) END AS INTEGER) AS DATE) AS period_start,
  CAST(arg_max(week_start, week_start) + CAST(arg_max(days_in_period, week_start) - 1 AS INTEGER) AS DATE) AS period_end
FROM gold_weekly""")
def q_kpi_totals(spark, sf):
    from limelight.operators.metrics import kpi_totals
    return kpi_totals(gold_weekly(spark, sf),
                      ["english_coverage", "translated_french_coverage", "translated_spanish_coverage"],
                      ["wikipedia_en_views", "wikipedia_fr_views", "wikipedia_es_views"])


SPLIT_PAIRS = {
    "english": ("english_coverage", "english_negative_share"),
    "high_salience": ("english_high_salience_coverage", "english_high_salience_negative_share"),
    "french": ("translated_french_coverage", "translated_french_negative_share"),
    "spanish": ("translated_spanish_coverage", "translated_spanish_negative_share"),
}


def _split_sql():
    parts = []
    for name, (cov, share) in SPLIT_PAIRS.items():
        c = f"coalesce(CAST({cov} AS DOUBLE), 0.0)"
        s = f"coalesce({share}, 0.0)"
        v = f"{c} <> 0"
        parts.append(f"""SELECT '{name}' AS split, coalesce(sum(CASE WHEN {v} THEN {c} * {s} END), 0.0) AS negative,
  coalesce(sum(CASE WHEN {v} THEN {c} * (1.0 - {s}) END), 0.0) AS non_negative FROM gold_weekly""")
    return " UNION ALL ".join(parts)


@register("overall_split", "A19", O.with_ctes(*GOLD) + f"""
SELECT split, {r('negative')}, {r('non_negative')},
  {r('CASE WHEN negative + non_negative <> 0 THEN negative / (negative + non_negative) ELSE 0.0 END', 'negative_share')}
FROM ({_split_sql()})""")
def q_overall_split(spark, sf):
    from limelight.operators.metrics import overall_split
    return rounded(overall_split(gold_weekly(spark, sf), SPLIT_PAIRS))


@register("scoring_split", "A20 P11", O.with_ctes(*GOLD) + f"""
SELECT subset, matches, scoring_matches, matches - scoring_matches AS scoreless_matches,
  {r('CASE WHEN matches > 0 THEN scoring_matches / matches ELSE 0.0 END', 'scoring_share')}
FROM (
  SELECT 'all' AS subset, count(*) AS matches, count(*) FILTER (WHERE goals > 0) AS scoring_matches FROM gold_matches
  UNION ALL SELECT 'min_45_plus', count(*) FILTER (WHERE coalesce(minutes, 0) >= 45),
    count(*) FILTER (WHERE coalesce(minutes, 0) >= 45 AND goals > 0) FROM gold_matches
  UNION ALL SELECT 'under_45', count(*) FILTER (WHERE coalesce(minutes, 0) < 45),
    count(*) FILTER (WHERE coalesce(minutes, 0) < 45 AND goals > 0) FROM gold_matches)""")
def q_scoring_split(spark, sf):
    from limelight.operators.metrics import scoring_split
    return rounded(scoring_split(gold_matches(spark, sf)))


APPEARANCES_SQL = """apps AS (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus = 'F' AS hit,
    CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice / 1000) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS goals
  FROM orders)"""


def _run_sql(reset: str, inc: str, out: str) -> str:
    return f"""SELECT o_custkey, o_orderkey, o_orderdate, hit, goals,
  CAST(CASE WHEN rs THEN 0 ELSE cum - coalesce(base, 0) END AS BIGINT) AS {out}
FROM (
  SELECT *, last(CASE WHEN rs THEN cum END IGNORE NULLS) OVER w AS base FROM (
    SELECT *, sum(inc) OVER w AS cum FROM (
      SELECT *, coalesce({reset}, false) AS rs, CASE WHEN coalesce({reset}, false) THEN 0 ELSE {inc} END AS inc FROM apps)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register("zero_streak", "W4", O.with_ctes(APPEARANCES_SQL) + _run_sql("hit", "1", "zero_streak"))
def q_zero_streak(spark, sf):
    from limelight.operators.streaks import zero_streak
    apps = T.appearances(spark, sf)
    out = zero_streak(apps, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("hit"),
                      chunk=F.trunc("o_orderdate", "month"))
    return out.withColumn("zero_streak", F.col("zero_streak").cast("bigint"))


@register("run_sum", "W5", O.with_ctes(APPEARANCES_SQL) + _run_sql("goals = 0", "goals", "run_sum"))
def q_run_sum(spark, sf):
    from limelight.operators.streaks import run_sum
    apps = T.appearances(spark, sf)
    out = run_sum(apps, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("goals"), chunk=F.trunc("o_orderdate", "month"))
    return out.withColumn("run_sum", F.col("run_sum").cast("bigint"))


@register("index_to_peak", "W6", O.with_ctes(*GOLD) + f"""
SELECT week_start, english_coverage, wikipedia_en_views,
  {r('CASE WHEN p1 <> 0 THEN CAST(coalesce(english_coverage, 0) AS DOUBLE) / p1 * 100.0 END', 'english_coverage_index')},
  {r('CASE WHEN p2 <> 0 THEN CAST(coalesce(wikipedia_en_views, 0) AS DOUBLE) / p2 * 100.0 END', 'wikipedia_en_views_index')}
FROM gold_weekly CROSS JOIN (SELECT max(coalesce(english_coverage, 0)) AS p1, max(coalesce(wikipedia_en_views, 0)) AS p2 FROM gold_weekly)""")
def q_index_to_peak(spark, sf):
    from limelight.operators.spikes import index_to_peak
    w = gold_weekly(spark, sf).select("week_start", "english_coverage", F.col("wikipedia_en_views").cast("bigint"))
    return rounded(index_to_peak(w, ["english_coverage", "wikipedia_en_views"]))


@register("clip_flag", "F34", O.with_ctes(*GOLD) + f"""
SELECT date, {r('english_avg_tone')},
  {r('CASE WHEN english_avg_tone IS NULL OR isnan(english_avg_tone) THEN english_avg_tone ELSE greatest(least(english_avg_tone, 5.0), -5.0) END', 'clipped')},
  CASE WHEN english_avg_tone IS NULL OR isnan(english_avg_tone) THEN NULL WHEN english_avg_tone < -5.0 THEN 'down'
    WHEN english_avg_tone > 5.0 THEN 'up' END AS overflow
FROM gold_daily""")
def q_clip_flag(spark, sf):
    from limelight.functions.numeric import clip_flag
    d = gold_daily(spark, sf)
    clipped, flag = clip_flag("english_avg_tone", -5.0, 5.0)
    return rounded(d.select("date", "english_avg_tone", clipped.alias("clipped"), flag.alias("overflow")))


@register("week_collect", "J7 A22", O.with_ctes(*GOLD) + """
SELECT w.week_start, CAST(coalesce(m.n, 0) AS BIGINT) AS match_count, m.first_date, m.last_date, m.goals
FROM gold_weekly w LEFT JOIN (
  SELECT CAST(date - CAST(dayofweek(date) AS INTEGER) AS DATE) AS week_start, count(*) AS n, min(date) AS first_date,
    max(date) AS last_date, CAST(sum(goals) AS BIGINT) AS goals
  FROM gold_matches GROUP BY 1) m USING (week_start)""")
def q_week_collect(spark, sf):
    from limelight.operators.dashboard import week_to_matches
    daily = gold_daily(spark, sf)  # one lineage for both sides, so its exchanges are reused
    weeks = P.gold_weekly(daily, T.trends(spark, sf)).select("week_start")
    matches = P.gold_matches(T.matches(spark, sf), daily)
    out = week_to_matches(weeks, matches, "date", ["date", "goals", "score"])
    return out.select(
        "week_start", F.size("matches").cast("bigint").alias("match_count"),
        F.try_element_at("matches", F.lit(1))["date"].alias("first_date"),
        F.try_element_at("matches", F.lit(-1))["date"].alias("last_date"),
        F.aggregate("matches", F.lit(None).cast("bigint"), lambda acc, m: F.coalesce(acc, F.lit(0)) + m["goals"]).alias("goals"),
    )


@register("marker_flags", "P14", O.with_ctes(*GOLD) + """
SELECT date, goals, yellow_cards, red_cards,
  CASE WHEN goals > 0 THEN 1 END AS scored_marker, CASE WHEN goals = 0 THEN 1 END AS no_goal_marker,
  CASE WHEN coalesce(yellow_cards, 0) <> 0 THEN yellow_cards END AS yellow_marker,
  CASE WHEN coalesce(red_cards, 0) <> 0 THEN red_cards END AS red_marker
FROM gold_matches""")
def q_marker_flags(spark, sf):
    from limelight.operators.filters import marker_flags
    m = gold_matches(spark, sf).select("date", "goals", "yellow_cards", "red_cards")
    return marker_flags(m)


@register("match_label", "F37", O.with_ctes(*GOLD) + """
SELECT date, concat_ws(' · ', team1 || ' ' || score || ' ' || team2,
  CAST(goals AS VARCHAR) || ' goal' || CASE WHEN goals = 1 THEN '' ELSE 's' END,
  CAST(minutes AS VARCHAR) || ' min',
  CASE WHEN coalesce(yellow_cards, 0) <> 0 THEN CAST(yellow_cards AS VARCHAR) || ' yellow' END,
  CASE WHEN coalesce(red_cards, 0) <> 0 THEN CAST(red_cards AS VARCHAR) || ' red' END) AS label
FROM gold_matches""")
def q_match_label(spark, sf):
    from limelight.functions.labels import match_label
    m = gold_matches(spark, sf)
    return m.select("date", match_label(minutes="minutes", yellow_cards="yellow_cards", red_cards="red_cards").alias("label"))


# ---------------------------------------------------------------- ingestion audit

OBS = [O.observations_cte()]
FILES = [O.observations_cte(), O.files_cte()]
FILE_COLS = ["stream", "gdelt_timestamp", "gdelt_date", "url", "was_downloaded", "was_skipped", "had_404",
             "zip_size_bytes", "csv_size_bytes", "observations", "is_ready", "unresolved_404", "zip_size_known",
             "csv_size_known"]


def files(spark, sf):
    from limelight.operators.audit import collapse_observations
    return collapse_observations(T.observations(spark, sf))


@register("file_collapse", "A8 F31 F32", O.with_ctes(*FILES) + f"SELECT {', '.join(FILE_COLS)} FROM files")
def q_file_collapse(spark, sf):
    return files(spark, sf).select(*FILE_COLS)


@register("audit_report", "A9 F33", O.with_ctes(*FILES) + """
SELECT count(*) AS files_expected, count(*) FILTER (WHERE was_downloaded) AS files_downloaded,
  count(*) FILTER (WHERE is_ready) AS files_ready, count(*) - count(*) FILTER (WHERE is_ready) AS files_not_ready,
  round(count(*) FILTER (WHERE is_ready) / nullif(count(*), 0) * 100, 4) AS ready_pct,
  count(*) FILTER (WHERE had_404) AS files_with_404, count(*) FILTER (WHERE unresolved_404) AS files_unresolved_404,
  round(CAST(coalesce(sum(coalesce(zip_size_bytes, 0)), 0) AS DOUBLE) / 1000000000.0, 3) AS downloaded_zip_gb,
  round(CAST(coalesce(sum(coalesce(csv_size_bytes, 0)), 0) AS DOUBLE) / 1000000000.0, 3) AS extracted_csv_gb,
  count(*) FILTER (WHERE is_ready AND NOT zip_size_known) AS ready_without_zip_size,
  count(*) FILTER (WHERE is_ready AND NOT csv_size_known) AS ready_without_csv_size,
  CAST(coalesce(sum(observations), 0) - count(*) AS BIGINT) AS repeated_observations_collapsed
FROM files""")
def q_audit_report(spark, sf):
    from limelight.operators.audit import audit_report
    return audit_report(files(spark, sf))


@register("audit_by_feed", "A10", O.with_ctes(*FILES) + """
SELECT stream, count(*) AS files_expected, count(*) FILTER (WHERE was_downloaded) AS files_downloaded,
  count(*) FILTER (WHERE is_ready) AS files_ready, count(*) FILTER (WHERE unresolved_404) AS files_unresolved_404,
  round(CAST(coalesce(sum(zip_size_bytes), 0) AS DOUBLE) / 1000000000.0, 3) AS downloaded_zip_gb,
  round(CAST(coalesce(sum(csv_size_bytes), 0) AS DOUBLE) / 1000000000.0, 3) AS extracted_csv_gb
FROM files GROUP BY stream""")
def q_audit_by_feed(spark, sf):
    from limelight.operators.audit import audit_by_feed
    return audit_by_feed(files(spark, sf))


BY_DAY_SQL = """by_day AS (
  SELECT s.date, d.files_expected, coalesce(d.files_ready, 0) AS files_ready,
    coalesce(d.files_unresolved_404, 0) AS files_unresolved_404
  FROM spine s LEFT JOIN (
    SELECT gdelt_date AS date, count(*) AS files_expected, count(*) FILTER (WHERE is_ready) AS files_ready,
      count(*) FILTER (WHERE unresolved_404) AS files_unresolved_404
    FROM files GROUP BY gdelt_date) d USING (date))"""


def audit_days(spark, sf):
    from limelight.operators.audit import audit_by_day
    from limelight.sources.spines import calendar_spine
    return audit_by_day(files(spark, sf), calendar_spine(T.event_bounds(spark, sf)))


@register("audit_by_day", "A11 J6 S16", O.with_ctes(*FILES, O.event_bounds_cte(), O.spine_cte(), BY_DAY_SQL) +
          "SELECT * FROM by_day")
def q_audit_by_day(spark, sf):
    return audit_days(spark, sf)


@register("day_status", "P12", O.with_ctes(*FILES, O.event_bounds_cte(), O.spine_cte(), BY_DAY_SQL) + """
SELECT *, CASE WHEN files_ready = 0 AND files_unresolved_404 = files_expected THEN 'empty_all_404'
  WHEN files_ready = 0 THEN 'empty' WHEN files_ready < 150 THEN 'partial' ELSE 'complete' END AS day_status
FROM by_day""")
def q_day_status(spark, sf):
    from limelight.operators.audit import with_day_status
    return with_day_status(audit_days(spark, sf), 150)


@register("size_profile", "A12", O.with_ctes(*FILES) + """
SELECT min(zip_size_bytes) FILTER (WHERE is_ready AND zip_size_known) AS min_zip_size_bytes,
  round(median(zip_size_bytes) FILTER (WHERE is_ready AND zip_size_known), 6) AS median_zip_size_bytes,
  max(zip_size_bytes) FILTER (WHERE is_ready AND zip_size_known) AS max_zip_size_bytes,
  min(csv_size_bytes) FILTER (WHERE is_ready AND csv_size_known) AS min_csv_size_bytes,
  round(median(csv_size_bytes) FILTER (WHERE is_ready AND csv_size_known), 6) AS median_csv_size_bytes,
  max(csv_size_bytes) FILTER (WHERE is_ready AND csv_size_known) AS max_csv_size_bytes
FROM files""")
def q_size_profile(spark, sf):
    from limelight.operators.audit import size_profile
    return rounded(size_profile(files(spark, sf)))


@register("full_day_profile", "A13", O.with_ctes(*FILES) + """
SELECT count(*) AS full_days, min(zip) AS min_daily_zip, round(median(zip), 6) AS median_daily_zip, max(zip) AS max_daily_zip,
  min(csv) AS min_daily_csv, round(median(csv), 6) AS median_daily_csv, max(csv) AS max_daily_csv
FROM (
  SELECT gdelt_date, CAST(sum(zip_size_bytes) AS BIGINT) AS zip, CAST(sum(csv_size_bytes) AS BIGINT) AS csv, count(*) AS n,
    count(*) FILTER (WHERE is_ready) AS r, count(*) FILTER (WHERE zip_size_known) AS zk,
    count(*) FILTER (WHERE csv_size_known) AS ck
  FROM files GROUP BY gdelt_date)
WHERE r = n AND zk = n AND ck = n""")
def q_full_day_profile(spark, sf):
    from limelight.operators.audit import full_day_profile
    return rounded(full_day_profile(files(spark, sf)))


@register("failure_runs", "W7", O.with_ctes(*OBS) + """
SELECT run_id, event_id, observed_at, download_status, CAST(run AS BIGINT) AS failure_run, run >= 3 AS breach FROM (
  SELECT *, CASE WHEN rs THEN 0 ELSE cum - coalesce(base, 0) END AS run FROM (
    SELECT *, last(CASE WHEN rs THEN cum END IGNORE NULLS) OVER w AS base FROM (
      SELECT *, sum(inc) OVER w AS cum FROM (
        SELECT *, download_status IN ('downloaded', 'missing_upstream') AS rs,
          CASE WHEN download_status = 'download_failed' THEN 1 ELSE 0 END AS inc FROM obs)
      WINDOW w AS (PARTITION BY run_id ORDER BY observed_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WINDOW w AS (PARTITION BY run_id ORDER BY observed_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))""")
def q_failure_runs(spark, sf):
    from limelight.operators.streaks import failure_runs
    obs = T.observations(spark, sf).select("run_id", "event_id", "observed_at", "download_status")
    out = failure_runs(obs, ["run_id"], ["observed_at", "event_id"], chunk=F.to_date("observed_at"))
    return out.withColumn("failure_run", F.col("failure_run").cast("bigint"))


@register("ingestion_metrics", "A17", O.with_ctes(*OBS) + """
SELECT count(*) AS files_expected,
  count(*) FILTER (WHERE download_status = 'skipped') AS files_download_skipped,
  count(*) FILTER (WHERE download_status = 'downloaded') AS files_downloaded,
  count(*) FILTER (WHERE download_status = 'download_failed') AS files_download_failed,
  count(*) FILTER (WHERE download_status = 'missing_upstream') AS files_missing_upstream,
  count(*) FILTER (WHERE unzip_status = 'extracted') AS files_extracted,
  count(*) FILTER (WHERE unzip_status = 'unzip_failed') AS files_unzip_failed,
  count(*) FILTER (WHERE coalesce(download_status = 'skipped' OR (download_status = 'downloaded' AND unzip_status = 'extracted'), false)) AS files_ready,
  count(*) FILTER (WHERE NOT coalesce(download_status = 'skipped' OR (download_status = 'downloaded' AND unzip_status = 'extracted'), false)) AS files_not_ready,
  count(DISTINCT gdelt_date) AS days_processed
FROM obs""")
def q_ingestion_metrics(spark, sf):
    from limelight.operators.audit import ingestion_metrics
    return ingestion_metrics(T.observations(spark, sf))


@register("fetch_status", "F36", """
SELECT event_id, CASE WHEN code = 404 THEN 'missing_upstream' WHEN err IS NOT NULL OR coalesce(code, 200) >= 400
  THEN 'download_failed' ELSE 'downloaded' END AS status
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN CASE WHEN value < 50 THEN 404 ELSE 503 END
  WHEN event_type = 'view' THEN 304 END AS code,
  CASE WHEN event_type = 'error' THEN 'HTTP error' END AS err FROM events)""")
def q_fetch_status(spark, sf):
    from limelight.functions.labels import fetch_status
    e = T.table(spark, sf, "events")
    code = F.when(F.col("event_type") == "error", F.when(F.col("value") < 50, F.lit(404)).otherwise(F.lit(503))) \
        .when(F.col("event_type") == "view", F.lit(304))
    err = F.when(F.col("event_type") == "error", F.lit("HTTP error"))
    return e.select("event_id", fetch_status(code, err).alias("status"))


# ---------------------------------------------------------------- spines

@register("calendar_days", "S16", O.with_ctes(O.event_bounds_cte(), O.spine_cte()) + "SELECT date FROM spine")
def q_calendar_days(spark, sf):
    from limelight.sources.spines import calendar_spine
    return calendar_spine(T.event_bounds(spark, sf))


@register("intervals", "S17", O.with_ctes(O.event_bounds_cte()) + """
SELECT CAST(s AS DATE) AS interval_start, CAST(least(end_date, CAST(s AS DATE) + 6) AS DATE) AS interval_end
FROM (SELECT unnest(generate_series(start_date, end_date, INTERVAL 7 DAY)) AS s, end_date FROM bounds)""")
def q_intervals(spark, sf):
    from limelight.sources.spines import interval_spine
    return interval_spine(T.event_bounds(spark, sf), 7)


@register("interval_of", "S17", O.with_ctes(O.event_bounds_cte()) + """
SELECT CAST(start_date + CAST(floor((CAST(ts AS DATE) - start_date) / 7) * 7 AS INTEGER) AS DATE) AS interval_start,
  count(*) AS events
FROM events CROSS JOIN bounds GROUP BY 1""")
def q_interval_of(spark, sf):
    from limelight.functions.dates import period_of
    e = T.table(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    b = T.event_bounds(spark, sf).select("start_date")
    return e.crossJoin(F.broadcast(b)).groupBy(period_of("d", F.col("start_date"), 7).alias("interval_start")) \
        .agg(F.count(F.lit(1)).alias("events"))


MANIFEST_SQL = """manifest AS (
  SELECT CAST(NULL AS VARCHAR) AS run_id, f.stream, CAST(s.slot AS DATE) AS gdelt_date,
    strftime(s.slot, '%Y%m%d%H%M%S') AS gdelt_timestamp,
    strftime(s.slot, '%Y%m%d%H%M%S') || f.suffix AS file_name,
    'http://data.gdeltproject.org/gdeltv2/' || strftime(s.slot, '%Y%m%d%H%M%S') || f.suffix AS url,
    'tmp/gdelt_gkg/date=' || strftime(s.slot, '%Y-%m-%d') || '/stream=' || f.stream || '/' || strftime(s.slot, '%Y%m%d%H%M%S') || f.suffix AS zip_path,
    'tmp/gdelt_gkg/date=' || strftime(s.slot, '%Y-%m-%d') || '/stream=' || f.stream || '/' || regexp_replace(strftime(s.slot, '%Y%m%d%H%M%S') || f.suffix, '\\.zip$', '') AS csv_path
  FROM (SELECT unnest(generate_series(CAST(date AS TIMESTAMP), CAST(date AS TIMESTAMP) + INTERVAL 1425 MINUTE, INTERVAL 15 MINUTE)) AS slot FROM spine) s
  CROSS JOIN (VALUES ('regular', '.gkg.csv.zip'), ('translation', '.translation.gkg.csv.zip')) f(stream, suffix))"""


def manifest(spark, sf):
    from limelight.sources.spines import calendar_spine, expected_file_manifest
    return expected_file_manifest(calendar_spine(T.event_bounds(spark, sf)))


@register("manifest_15min", "S15", O.with_ctes(O.event_bounds_cte(), O.spine_cte(), MANIFEST_SQL) + "SELECT * FROM manifest")
def q_manifest_15min(spark, sf):
    return manifest(spark, sf)


@register("files_to_fetch", "J9", O.with_ctes(O.event_bounds_cte(), O.spine_cte(), MANIFEST_SQL, *OBS) + """
SELECT m.* FROM manifest m ANTI JOIN (SELECT DISTINCT stream, gdelt_timestamp FROM obs WHERE csv_size_bytes > 0) p
  USING (stream, gdelt_timestamp)""")
def q_files_to_fetch(spark, sf):
    from limelight.sources.spines import files_to_fetch
    todo, _ = files_to_fetch(manifest(spark, sf), T.observations(spark, sf))
    return todo


# ---------------------------------------------------------------- data quality

@register("null_check", "Q1", """
SELECT * FROM (VALUES
  ('conv_id', (SELECT count(*) FILTER (WHERE conv_id IS NULL) FROM conversations)),
  ('turn', (SELECT count(*) FILTER (WHERE turn = 0) FROM conversations)),
  ('role', (SELECT count(*) FILTER (WHERE role = 'system') FROM conversations)),
  ('text', (SELECT count(*) FILTER (WHERE length(text) < 40) FROM conversations))) t(column_name, null_rows)""")
def q_null_check(spark, sf):
    """First turns, system roles and short texts are blanked, so that there are NULLs to count."""
    from limelight.operators.quality import check_not_null
    c = T.table(spark, sf, "conversations").select(
        "conv_id", F.nullif("turn", F.lit(0)).alias("turn"), F.nullif("role", F.lit("system")).alias("role"),
        F.when(F.length("text") >= 40, F.col("text")).alias("text"))
    return check_not_null(c, ["conv_id", "turn", "role", "text"])


@register("unique_check", "Q2", """
SELECT text_md5, count(*) AS n_records FROM (SELECT md5(text) AS text_md5 FROM documents)
WHERE text_md5 IS NOT NULL GROUP BY text_md5 HAVING count(*) > 1""")
def q_unique_check(spark, sf):
    from limelight.operators.quality import check_unique
    return check_unique(T.table(spark, sf, "documents").select(F.md5("text").alias("text_md5")), "text_md5")


@register("unique_combination", "Q3", """
SELECT conv_id, role, count(*) AS n_records FROM conversations GROUP BY ALL HAVING count(*) > 1""")
def q_unique_combination(spark, sf):
    from limelight.operators.quality import check_unique_combination
    return check_unique_combination(T.table(spark, sf, "conversations"), ["conv_id", "role"])


DEGRADED_TRENDS_SQL = """shifted AS (
  SELECT CAST(week_start + CASE WHEN audience_scope = 'fr' THEN 1 ELSE 0 END AS DATE) AS week_start, audience_scope, interest FROM trends
  UNION ALL SELECT week_start, audience_scope, interest FROM trends WHERE audience_scope = 'es')"""


def degraded_trends(spark, sf):
    """Trends with violations: the ``fr`` weeks start on a Monday, the ``es`` weeks occur twice."""
    t = T.trends(spark, sf)
    day = F.date_add("week_start", F.when(F.col("audience_scope") == "fr", 1).otherwise(0))
    return t.select(day.alias("week_start"), "audience_scope", "interest").unionByName(t.filter(F.col("audience_scope") == "es"))


@register("week_start_check", "Q4", O.with_ctes(O.trends_cte(), DEGRADED_TRENDS_SQL) + """
SELECT count(*) FILTER (WHERE dayofweek(week_start) <> 0) AS non_sunday_rows FROM shifted""")
def q_week_start_check(spark, sf):
    from limelight.operators.quality import check_week_start_day
    return check_week_start_day(degraded_trends(spark, sf))


@register("range_check", "Q7", """
SELECT count(*) FILTER (WHERE value IS NOT NULL AND NOT (value BETWEEN 0.0 AND 100.0)) AS out_of_range_rows FROM events""")
def q_range_check(spark, sf):
    from limelight.operators.quality import check_range
    return check_range(T.table(spark, sf, "events"), "value", 0.0, 100.0)


@register("one_to_one_check", "Q8", O.with_ctes(O.matches_cte(), O.trends_cte(), DEGRADED_TRENDS_SQL) + """
SELECT week_start, n_records, side FROM (
  SELECT week_start, count(*) AS n_records, 'left' AS side FROM shifted GROUP BY week_start HAVING count(*) > 1
  UNION ALL SELECT CAST(match_date - CAST(dayofweek(match_date) AS INTEGER) AS DATE), count(*), 'right' FROM matches GROUP BY 1 HAVING count(*) > 1)""")
def q_one_to_one_check(spark, sf):
    from limelight.functions.dates import week_start
    from limelight.operators.quality import check_one_to_one
    weeks = T.matches(spark, sf).select(week_start("match_date").alias("week_start"))
    return check_one_to_one(degraded_trends(spark, sf), weeks, ["week_start"])


@register("check_suite", "Q9 Q1 Q2 Q3 Q4 Q7", O.with_ctes(O.event_bounds_cte(), O.spine_cte(), O.pageviews_cte(), O.trends_cte(),
                                                         O.matches_cte(), DEGRADED_TRENDS_SQL) + """
SELECT 'pageviews_unique' AS check_name, CAST(count(*) AS BIGINT) AS violations FROM (
  SELECT date, language FROM pageviews GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'trends_unique', count(*) FROM (SELECT week_start, audience_scope FROM shifted GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'goals_unique', count(*) FROM (SELECT goals FROM matches WHERE goals <> 0 GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'matches_not_null', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
  SELECT count(*) FILTER (WHERE competition IS NULL) + count(*) FILTER (WHERE goals = 0) + count(*) FILTER (WHERE total_time IS NULL) AS n FROM matches)
UNION ALL SELECT 'cards_range', count(*) FILTER (WHERE yellow_cards IS NOT NULL AND NOT (yellow_cards BETWEEN 0 AND 1)) FROM matches
UNION ALL SELECT 'trends_week_start', count(*) FILTER (WHERE dayofweek(week_start) <> 0) FROM shifted""")
def q_check_suite(spark, sf):
    from limelight.operators.quality import CheckSpec, run_checks
    m = T.matches(spark, sf).withColumn("goals", F.nullif("goals", F.lit(0)))
    return (
        run_checks(T.pageviews(spark, sf), [CheckSpec("pageviews_unique", "unique_combination", ["date", "language"])])
        .unionByName(run_checks(degraded_trends(spark, sf), [
            CheckSpec("trends_unique", "unique_combination", ["week_start", "audience_scope"]),
            CheckSpec("trends_week_start", "week_start", ["week_start"])]))
        .unionByName(run_checks(m, [
            CheckSpec("goals_unique", "unique", ["goals"]),
            CheckSpec("matches_not_null", "not_null", ["competition", "goals", "total_time"]),
            CheckSpec("cards_range", "range", ["yellow_cards"], 0, 1)]))
    )


# ---------------------------------------------------------------- payloads and collectors

@register("json_props", "S10", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def q_json_props(spark, sf):
    e = T.table(spark, sf, "events")
    parsed = F.from_json("props", "k BIGINT")
    return e.select("event_id", parsed["k"].alias("k"))


@register("pageviews_payload", "S10", O.with_ctes(O.event_bounds_cte(), O.spine_cte(), O.pageviews_cte()) + """
SELECT language, date, views FROM pageviews""")
def q_pageviews_payload(spark, sf):
    """Round trip through the collector's JSON payload shape: one payload per
    language and month (at most 31 items per group) built from the pageview
    rows, then parsed back by S10."""
    from limelight.sources.payloads import parse_pageviews
    pv = T.pageviews(spark, sf)
    items = F.sort_array(F.collect_list(F.struct(
        F.concat(F.date_format("date", "yyyyMMdd"), F.lit("00")).alias("timestamp"), F.col("views").alias("views"))))
    payloads = pv.groupBy("language", F.trunc("date", "month").alias("month")) \
        .agg(F.to_json(F.struct(items.alias("items"))).alias("payload"))
    return parse_pageviews(payloads, "payload", keep=["language"])


@register("timeline_payload", "S11 F29", O.with_ctes(O.trends_cte()) + "SELECT audience_scope, week_start, interest FROM trends")
def q_timeline_payload(spark, sf):
    """One guarded payload per scope and year (at most 53 points a group), parsed back by S11."""
    from limelight.sources.payloads import parse_timeline
    points = F.sort_array(F.collect_list(F.struct(
        F.unix_timestamp(F.col("week_start").cast("timestamp")).cast("string").alias("time"),
        F.array("interest").alias("value"))))
    body = F.struct(F.struct(points.alias("timelineData")).alias("default"))
    payloads = T.trends(spark, sf).groupBy("audience_scope", F.year("week_start").alias("year")) \
        .agg(F.concat(F.lit(")]}',\n"), F.to_json(body)).alias("payload"))
    return parse_timeline(payloads, keep=["audience_scope"])


@register("widget_choice", "S12 Q5", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN 't' || user_id END AS widget_token,
  event_type <> 'error' AS widget_found, event_type = 'view' AS weekly_resolution
FROM events""")
def q_widget_choice(spark, sf):
    from limelight.sources.payloads import select_widget
    kind = F.col("event_type")
    widget = lambda name, token, unit: F.struct(
        F.lit(name).alias("id") if isinstance(name, str) else name.alias("id"), token.alias("token"),
        F.struct(unit.alias("resolution")).alias("request"))
    chosen = F.when(kind == "error", "RELATED").otherwise("TIMESERIES")
    widgets = F.array(
        widget("GEO", F.lit("g"), F.lit("WEEK")),
        widget(chosen, F.concat(F.lit("t"), F.col("user_id")), F.when(kind == "view", "WEEK").otherwise("DAY")))
    payloads = T.table(spark, sf, "events").select("event_id", F.to_json(F.struct(widgets.alias("widgets"))).alias("payload"))
    return select_widget(payloads).select("event_id", "widget_token", "widget_found", "weekly_resolution")


@register("pageview_items", "S10", """
SELECT event_id, n.item_no,
  CASE WHEN n.item_no = 0 OR (n.item_no = 1 AND event_type <> 'signup') THEN CAST(ts AS DATE) END AS date,
  CASE WHEN n.item_no = 0 THEN k WHEN n.item_no = 1 AND event_type <> 'purchase' THEN user_id END AS views,
  CASE WHEN n.item_no IS NULL THEN 'payload without an items list'
       WHEN n.item_no = 1 AND event_type = 'signup' THEN 'item without a valid timestamp'
       WHEN n.item_no = 1 AND event_type = 'purchase' THEN 'item without whole views' END AS error_reason
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
JOIN (VALUES (CAST(NULL AS INTEGER)), (0), (1)) AS n(item_no) ON (n.item_no IS NULL) = (event_type = 'error')""")
def q_pageview_items(spark, sf):
    """A payload per event, some without their list, some with an item that is not valid: every item with its reason."""
    from limelight.sources.payloads import pageview_items
    e = T.table(spark, sf, "events").withColumn("k", F.from_json("props", "k BIGINT")["k"])
    stamp, kind = F.date_format("ts", "yyyyMMddHH"), F.col("event_type")
    second = F.when(kind == "signup", F.format_string('{"views": %d}', "user_id")) \
        .when(kind == "purchase", F.format_string('{"timestamp": "%s", "views": "x"}', stamp)) \
        .otherwise(F.format_string('{"timestamp": "%s", "views": "%d"}', stamp, "user_id"))
    body = F.format_string('{"items": [{"timestamp": "%s", "views": %d}, %s]}', stamp, "k", second)
    payloads = e.withColumn("payload", F.when(kind == "error", '{"detail": "not found"}').otherwise(body))
    return pageview_items(payloads, keep=["event_id"])


@register("timeline_rejects", "S11 F29", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE 0 END AS item_no,
  CASE event_type WHEN 'error' THEN 'payload without a timelineData list' WHEN 'signup' THEN 'point without a valid time'
    ELSE 'point without a whole first value' END AS error_reason
FROM events WHERE event_type IN ('error', 'signup', 'purchase')""")
def q_timeline_rejects(spark, sf):
    """A guarded payload per event: the points and payloads that strict parsing refuses."""
    from limelight.sources.payloads import timeline_rejects
    e, kind = T.table(spark, sf, "events"), F.col("event_type")
    seconds = F.unix_timestamp("ts").cast("string")
    point = F.when(kind == "signup", '{"value": [1]}').when(kind == "purchase", F.format_string('{"time": "%s", "value": []}', seconds)) \
        .otherwise(F.format_string('{"time": "%s", "value": [%d]}', seconds, "user_id"))
    body = F.when(kind == "error", '{"default": {}}').otherwise(F.format_string('{"default": {"timelineData": [%s]}}', point))
    payloads = e.withColumn("payload", F.concat(F.lit(")]}',\n"), body))
    return timeline_rejects(payloads, keep=["event_id"]).select("event_id", "item_no", "error_reason")


@register("widget_reasons", "S12 Q5", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'response without a TIMESERIES widget' WHEN 'view' THEN NULL
  WHEN 'signup' THEN 'widget without request or token' ELSE 'resolution is not WEEK but DAY' END AS error_reason
FROM events""")
def q_widget_reasons(spark, sf):
    from limelight.sources.payloads import select_widget
    e, kind = T.table(spark, sf, "events"), F.col("event_type")
    widget = F.when(kind == "error", '{"id": "GEO", "token": "g"}').when(kind == "signup", '{"id": "TIMESERIES", "token": "t"}') \
        .otherwise(F.format_string('{"id": "TIMESERIES", "token": "t", "request": {"resolution": "%s"}}', F.when(kind == "view", "WEEK").otherwise("DAY")))
    payloads = e.withColumn("payload", F.format_string('{"widgets": [%s]}', widget))
    return select_widget(payloads).select("event_id", "error_reason")


@register("raw_lines", "S1", O.with_ctes(O.raw_feed_cte()) + """
SELECT GKGRECORDID, "DATE" AS record_date, SourceCommonName, DocumentIdentifier, Themes, length(AllNames) AS names_chars,
  length(V2Persons) AS persons_chars, V2Tone, TranslationInfo FROM raw_feed""")
def q_raw_lines(spark, sf):
    """The feed written as tab-separated lines and parsed back."""
    from limelight.sources.raw_feed import GKG_COLUMNS, raw_rows_from_lines
    feed = T.raw_feed(spark, sf)
    lines = feed.select(F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in GKG_COLUMNS]).alias("line"))
    return raw_rows_from_lines(lines).select(
        "GKGRECORDID", F.col("DATE").alias("record_date"), "SourceCommonName", "DocumentIdentifier", "Themes",
        F.length("AllNames").cast("bigint").alias("names_chars"), F.length("V2Persons").cast("bigint").alias("persons_chars"),
        "V2Tone", "TranslationInfo")


CELLS_SQL = """cells AS (
  SELECT event_id, event_type, CAST(ts AS DATE) AS d, CAST(floor(value) AS BIGINT) AS v, event_id % 10 AS c FROM events),
typed AS (
  SELECT event_id, event_type, d, v, c,
    CASE WHEN c <> 0 THEN v % 120 END AS total_time,
    CASE WHEN c = 0 THEN 0 ELSE v % 4 END AS goals FROM cells)"""


def match_cells(spark, sf):
    """Events as raw match cells: padded numbers, ``-`` for unplayed, and one broken kind of cell in ten."""
    e = T.table(spark, sf, "events")
    v, c = F.floor("value").cast("bigint"), F.col("event_id") % 10
    day = F.date_format(F.col("ts").cast("date"), "yyyy/MM/dd")
    num = lambda x: F.concat(F.lit(" "), x.cast("string"), F.lit("\n"))
    zero = F.lit("0")
    return e.select(
        F.col("event_id").cast("string").alias("payload_id"),
        F.concat(F.lit("  League "), F.col("event_type"), F.lit(" ")).alias("competition"),
        F.when(c == 1, F.lit("soon")).otherwise(F.concat(F.lit("on "), day)).alias("date_text"),
        F.lit("Red  Star").alias("team1"),
        F.when(c == 2, F.lit("2-1")).otherwise(F.concat(v.cast("string"), F.lit(":0"))).alias("score"), F.lit("Blue").alias("team2"),
        F.when(c == 0, F.lit(" - ")).when(c == 3, F.lit("x")).otherwise(num(v % 120)).alias("total_time_raw"),
        F.when(c == 0, zero).when(c == 4, F.lit("1.5")).otherwise(num(v % 4)).alias("goals_raw"),
        zero.alias("penalties_raw"), zero.alias("missed_penalties_raw"),
        F.when((c == 0) & (v % 2 == 0), F.lit("1")).otherwise(zero).alias("yellow_cards_raw"), zero.alias("red_cards_raw"),
        F.when(c == 5, F.lit("no cells")).alias("parse_error"))


@register("match_rows", "F24 F25 F26 F28 Q6", O.with_ctes(CELLS_SQL) + """
SELECT CAST(event_id AS VARCHAR) AS payload_id, 'League ' || event_type AS competition, CASE WHEN c <> 1 THEN d END AS match_date,
  'Red Star' AS team1, CASE WHEN c <> 3 THEN total_time END AS total_time, CASE WHEN c <> 4 THEN goals END AS goals,
  CASE WHEN c = 5 THEN 'no cells' WHEN c = 2 THEN 'bad score' WHEN c = 1 THEN 'no date' WHEN c = 3 THEN 'bad total_time'
    WHEN c = 4 THEN 'bad goals' WHEN c = 0 AND v % 2 = 0 THEN 'unplayed match with events' END AS error_reason
FROM typed""")
def q_match_rows(spark, sf):
    from limelight.sources.payloads import type_match_rows
    return type_match_rows(match_cells(spark, sf)).select("payload_id", "competition", "match_date", "team1", "total_time", "goals", "error_reason")


@register("metric_titles", "F24 F27", """
SELECT CASE event_type WHEN 'purchase' THEN 'goals' WHEN 'error' THEN 'missed_penalties' WHEN 'click' THEN 'total_time' WHEN 'view' THEN 'red_cards' END AS metric,
  count(*) AS events, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1""")
def q_metric_titles(spark, sf):
    """Headings of the event types, in odd case and spacing, and one that is unknown."""
    from limelight.sources.payloads import metric_name
    headings = {"purchase": " Goal", "error": "Missing\n Penalty ", "click": "TOTAL  time", "view": "Red card", "signup": "Corner"}
    lookup = F.create_map(*[F.lit(x) for pair in headings.items() for x in pair])
    e = T.table(spark, sf, "events").withColumn("heading", lookup[F.col("event_type")])
    return e.groupBy(metric_name("heading").alias("metric")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("user_id").cast("bigint").alias("users"))


@register("league_matches", "P10 P15 F25", O.with_ctes(CELLS_SQL) + """
SELECT 'League ' || event_type AS league, count(*) AS matches, CAST(sum(total_time) AS BIGINT) AS minutes, CAST(sum(goals) AS BIGINT) AS goals
FROM typed WHERE NOT (c BETWEEN 1 AND 5 OR c = 0 AND v % 2 = 0) AND event_type <> 'error' GROUP BY 1""")
def q_league_matches(spark, sf):
    """Valid matches without one competition, renamed and cast, summed per league."""
    from limelight.operators.filters import exclude_category, rename_normalize
    from limelight.sources.payloads import typed_matches
    good, _ = typed_matches(match_cells(spark, sf), exclude_competition=None, strict=False)
    named = rename_normalize(exclude_category(good, "competition", "League error"),
                             {"competition": "league", "total_time": "minutes"}, ["minutes", "goals"], ["league", "minutes", "goals"])
    return named.groupBy("league").agg(F.count(F.lit(1)).alias("matches"), F.sum("minutes").alias("minutes"), F.sum("goals").alias("goals"))


@register("tagged_union", "U2 F35", O.with_ctes(O.event_bounds_cte(), O.spine_cte(), O.pageviews_cte()) + """
SELECT CASE language WHEN 'en' THEN 'English' ELSE 'French' END AS edition, strftime(date, '%Y-%m-%d') AS day, views
FROM pageviews WHERE language IN ('en', 'fr')""")
def q_tagged_union(spark, sf):
    from limelight.functions.dates import format_date
    from limelight.operators.sets import concat_tagged
    pv = T.pageviews(spark, sf)
    frames = {name: pv.filter(F.col("language") == code).select(format_date("date").alias("day"), "views")
              for name, code in (("English", "en"), ("French", "fr"))}
    return concat_tagged(frames, "edition")


@register("html_extract", "page fields", r"""
SELECT page_id,
  regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
  regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS h1,
  CAST(len(regexp_extract_all(html, '(?is)<a\s[^>]*href="([^"]*)"', 1)) AS BIGINT) AS links,
  regexp_extract(html, '(?is)<html[^>]*\slang="([^"]*)"', 1) AS lang
FROM pages""")
def q_html_extract(spark, sf):
    from limelight.sources.payloads import html_fields
    return html_fields(T.table(spark, sf, "pages"), "html").select("page_id", "title", "h1", "links", "lang")


@register("collector_totals", "A24", O.with_ctes(O.event_bounds_cte(), O.spine_cte(), O.pageviews_cte()) + """
SELECT language, count(*) AS rows, CAST(sum(views) AS BIGINT) AS total_views FROM pageviews GROUP BY language""")
def q_collector_totals(spark, sf):
    from limelight.operators.metrics import collector_totals
    return collector_totals(T.pageviews(spark, sf), "language", "views")


@register("article_urls", "F30", """
SELECT DISTINCT lang, 'https://' || lang || '.wikipedia.org/wiki/' || replace(replace(url_encode(source), '+', '%20'), '%2F', '/') AS article_url
FROM documents""")
def q_article_urls(spark, sf):
    from limelight.functions.urls import article_url
    d = T.table(spark, sf, "documents")
    return d.select("lang", article_url("source", "lang").alias("article_url")).distinct()


@register("date_between", "P4", O.with_ctes(*OBS) + """
SELECT stream, gdelt_date, count(*) AS observations FROM obs
WHERE gdelt_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY ALL""")
def q_date_between(spark, sf):
    from limelight.operators.filters import date_between
    obs = date_between(T.observations(spark, sf), "gdelt_date", "2024-01-05", "2024-01-20")
    return obs.groupBy("stream", "gdelt_date").agg(F.count(F.lit(1)).alias("observations"))


@register("shipments_within_period", "A7 J4 P6", f"""
SELECT l_returnflag, l_linestatus, count(*) AS shipments, {r('sum(l_extendedprice)', 'revenue')},
  min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship
FROM lineitem CROSS JOIN (
  SELECT min(CAST(o_orderdate AS DATE)) AS start_date, max(CAST(o_orderdate AS DATE)) AS end_date
  FROM orders WHERE o_orderpriority = '1-URGENT') b
WHERE CAST(l_shipdate AS DATE) BETWEEN b.start_date AND b.end_date
GROUP BY ALL""")
def q_shipments_within_period(spark, sf):
    from limelight.operators.filters import within_period
    from limelight.operators.metrics import period_bounds
    o = T.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_orderdate").cast("date").alias("date"))
    li = T.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_extendedprice", F.col("l_shipdate").cast("date").alias("ship_date"))
    inside = within_period(li, "ship_date", period_bounds(o, "date"))
    return rounded(inside.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("shipments"), F.sum("l_extendedprice").alias("revenue"),
        F.min("ship_date").alias("first_ship"), F.max("ship_date").alias("last_ship")))
