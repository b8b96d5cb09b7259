"""DuckDB twins of the test-data views and pipeline stages.

These strings are the independent oracle for the correctness check: the same
semantics written as plain SQL over the pre-registered test tables. They are
not used by the Spark code path.
"""

from __future__ import annotations

from limelight.plans.testdata import CANONICAL, LANG_CODES, PAGEVIEW_LANGUAGES, TOKEN, TREND_SCOPES, WEEKLY_ORDER_MEASURES
from limelight.sources.raw_feed import BRONZE_COLUMNS, GKG_COLUMNS, SEARCH_TEXT_COLUMNS

WS = r"'^\s+|\s+$'"
URL_RE = r"'^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?'"
ENTRY_RE = r"'(?s)^(.*),([^,]*)$'"


def q(name: str) -> str:
    return f'"{name}"'


def case_map(expr: str, mapping: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def strip_ws(expr: str) -> str:
    return f"regexp_replace({expr}, {WS}, '', 'g')"


def canonical_url(expr: str) -> str:
    cleaned = f"regexp_replace({strip_ws(expr)}, '[\\t\\r\\n]', '', 'g')"
    host = f"lower(regexp_extract({cleaned}, {URL_RE}, 1))"
    host = f"(CASE WHEN starts_with({host}, 'www.') THEN substr({host}, 5) ELSE {host} END)"
    path = f"regexp_replace(regexp_extract({cleaned}, {URL_RE}, 2), '/+$', '', 'g')"
    query = f"regexp_extract({cleaned}, {URL_RE}, 3)"
    base = f"(CASE WHEN {host} <> '' THEN {host} || {path} ELSE {path} END)"
    return f"(CASE WHEN {query} <> '' THEN {base} || '?' || {query} ELSE {base} END)"


def packed(words: str, only_capitalized: bool) -> str:
    indexed = f"list_transform({words}, lambda w, i: {{'w': w, 'i': i - 1}})"
    if only_capitalized:
        indexed = f"list_filter({indexed}, lambda s: left(s.w, 1) <> lower(left(s.w, 1)))"
    return f"array_to_string(list_transform({indexed}, lambda s: s.w || ',' || CAST(s.i AS VARCHAR)), ';')"


def raw_feed_cte() -> str:
    words = "string_split_regex(d.text, '\\s+')"
    lang3 = case_map("d.lang", LANG_CODES)
    values = {
        "GKGRECORDID": "CAST(d.doc_id AS VARCHAR)",
        "DATE": "CASE WHEN e.event_type = 'error' AND e.value < 20 THEN 'bad-date' ELSE strftime(e.ts, '%Y%m%d%H%M%S') END",
        "SourceCollectionIdentifier": "'1'",
        "SourceCommonName": "d.source",
        "DocumentIdentifier": "'https://' || CASE WHEN e.event_type IN ('view', 'click') THEN 'www.' ELSE '' END"
        " || 'news.example.com/' || CASE WHEN e.event_type = 'purchase' THEN '100%/' ELSE '' END || d.lang || '/'"
        f" || {words}[1] || '/' || md5(d.text)"
        " || CASE WHEN e.event_type = 'signup' THEN '/' ELSE '' END",
        "V2Persons": packed(words, True),
        "AllNames": packed(words, False),
        "V2Tone": "CAST(e.value - 50 AS VARCHAR) || ',0,0'",
        "TranslationInfo": f"CASE WHEN d.lang = 'en' THEN NULL WHEN e.event_type = 'view' THEN 'malformed metadata'"
        f" ELSE 'srclc:' || {lang3} || ';eng:GT-' || upper(d.lang) END",
    }
    cols = ",\n    ".join(f"{values.get(c, 'CAST(NULL AS VARCHAR)')} AS {q(c)}" for c in GKG_COLUMNS)
    return (
        "raw_feed AS (\n  SELECT\n    " + cols + ",\n"
        "    CASE WHEN d.lang = 'en' THEN 'regular' ELSE 'translation' END AS stream\n"
        "  FROM documents d JOIN events e ON e.event_id = 5 * d.doc_id\n)"
    )


def candidates_cte(token: str = TOKEN) -> str:
    cond = " OR ".join(f"{q(c)} ILIKE '%{token}%'" for c in SEARCH_TEXT_COLUMNS)
    return (
        "candidates AS (\n  SELECT *, try_strptime(\"DATE\", '%Y%m%d%H%M%S') AS gkg_datetime,\n"
        "    CAST(try_strptime(\"DATE\", '%Y%m%d%H%M%S') AS DATE) AS gkg_date\n"
        f"  FROM raw_feed WHERE {cond}\n)"
    )


def bronze_cte() -> str:
    cols = ", ".join(q(c) for c in BRONZE_COLUMNS)
    return f"bronze AS (SELECT {cols} FROM candidates WHERE gkg_datetime IS NOT NULL)"


def parse_entries(expr: str) -> str:
    split = f"string_split(coalesce({expr}, ''), ';')"
    trimmed = f"list_transform({split}, lambda e: {strip_ws('e')})"
    with_comma = f"list_filter({trimmed}, lambda e: instr(e, ',') > 0)"
    pairs = (
        f"list_transform({with_comma}, lambda e: {{'name': {strip_ws(f'lower(regexp_extract(e, {ENTRY_RE}, 1))')},"
        f" 'off': {strip_ws(f'regexp_extract(e, {ENTRY_RE}, 2)')}}})"
    )
    valid = f"list_filter({pairs}, lambda p: regexp_matches(p.off, '^[0-9]+$') AND p.name <> '')"
    return f"list_transform({valid}, lambda p: {{'name': p.name, 'offset': CAST(p.off AS BIGINT)}})"


def normalize_names(entries: str, token: str = TOKEN, canonical: str = CANONICAL) -> str:
    folded = "trim(regexp_replace(regexp_replace(lower(strip_accents(x.name)), '[^a-z0-9]+', ' ', 'g'), '\\s+', ' ', 'g'))"
    norm = f"list_transform({entries}, lambda x: CASE WHEN instr(x.name, '{token}') > 0 THEN '{canonical}' ELSE {folded} END)"
    return f"list_filter({norm}, lambda n: n <> '')"


def max_mult(arr: str) -> str:
    return f"(SELECT coalesce(max(c), 0) FROM (SELECT count(*) AS c FROM unnest({arr}) AS t(x) GROUP BY x))"


def articles_cte(token: str = TOKEN, canonical: str = CANONICAL) -> str:
    """keyed -> dedup -> enriched -> parsed -> counted -> articles."""
    order = ", ".join(f"{q(c)} ASC NULLS LAST" for c in ["gkg_datetime", "stream", "GKGRECORDID", "DocumentIdentifier"])
    return f"""keyed AS (SELECT *, {canonical_url('DocumentIdentifier')} AS canonical_url FROM bronze),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY {order}) AS rn
    FROM keyed WHERE canonical_url IS NOT NULL) WHERE rn = 1
  UNION ALL SELECT * FROM keyed WHERE canonical_url IS NULL
),
enriched AS (
  SELECT *,
    TRY_CAST(split_part(V2Tone, ',', 1) AS DOUBLE) AS tone,
    CASE WHEN stream = 'translation' THEN
      coalesce(nullif(regexp_extract(lower({strip_ws('TranslationInfo')}), '\\bsrclc:([a-z]{{2,3}})\\b', 1), ''), 'unknown')
    ELSE 'eng' END AS source_language
  FROM dedup
),
parsed AS (
  SELECT *,
    {parse_entries('V2Persons')} AS _p,
    {parse_entries('AllNames')} AS _n,
    {parse_entries('V2Organizations')} AS _o,
    {parse_entries('V2Themes')} AS _t
  FROM enriched
),
normed AS (
  SELECT *,
    {normalize_names('_p', token, canonical)} AS _pc,
    {normalize_names('_n', token, canonical)} AS _nc,
    list_min(list_transform(list_filter(list_concat(_p, _n), lambda e: instr(e.name, '{token}') > 0), lambda e: e.offset)) AS first_player_offset,
    list_max(list_transform(list_concat(list_concat(_p, _n), list_concat(_o, _t)), lambda e: e.offset)) AS max_entity_offset
  FROM parsed
),
counted AS (
  SELECT *,
    CAST(CASE WHEN len(list_filter(_pc, lambda x: x = '{canonical}')) > 0
      THEN len(list_filter(_pc, lambda x: x = '{canonical}'))
      ELSE len(list_filter(_nc, lambda x: x = '{canonical}')) END AS BIGINT) AS player_mentions,
    CAST(CASE WHEN len(list_filter(_pc, lambda x: x = '{canonical}')) > 0
      THEN {max_mult('_pc')} ELSE {max_mult('_nc')} END AS BIGINT) AS max_mentions_of_any_person,
    CASE WHEN instr(lower(coalesce(url_decode(replace(DocumentIdentifier, '+', '%2B')), DocumentIdentifier)), '{token}') > 0
      THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS url_player_signal
  FROM normed
),
signals AS (
  SELECT *,
    CASE WHEN first_player_offset IS NOT NULL AND first_player_offset <= 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS lead_player_signal,
    CASE WHEN first_player_offset IS NOT NULL AND max_entity_offset IS NOT NULL AND max_entity_offset > 0
      THEN 1.0::DOUBLE - first_player_offset::DOUBLE / max_entity_offset::DOUBLE ELSE 0.0::DOUBLE END AS position_score,
    least(player_mentions, 4)::DOUBLE / 4.0::DOUBLE AS density_score,
    CASE WHEN max_mentions_of_any_person > 0 THEN player_mentions::DOUBLE / max_mentions_of_any_person::DOUBLE ELSE 0.0::DOUBLE END AS rank_score
  FROM counted
),
scored AS (
  SELECT *,
    CASE WHEN url_player_signal = 1.0 OR lead_player_signal = 1.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS lead_or_url_signal
  FROM signals
),
articles AS (
  SELECT * EXCLUDE (_p, _n, _o, _t, _pc, _nc, score0),
    CASE WHEN score0 >= 0.70 THEN 'high_salience' WHEN score0 >= 0.40 THEN 'medium_salience' ELSE 'low_salience' END AS salience_class,
    score0 AS salience_score
  FROM (SELECT *, 0.20::DOUBLE * lead_or_url_signal + 0.35::DOUBLE * position_score + 0.30::DOUBLE * density_score
                 + 0.15::DOUBLE * rank_score AS score0 FROM scored)
)"""


SEGMENTS_SQL = [
    ("english", "stream = 'regular'", True),
    ("english_high_salience", "stream = 'regular' AND salience_score >= 0.70", True),
    ("translated", "stream = 'translation'", True),
    ("translated_french", "stream = 'translation' AND source_language = 'fra'", True),
    ("translated_spanish", "stream = 'translation' AND source_language = 'spa'", True),
    ("translated_other", "stream = 'translation' AND source_language NOT IN ('fra', 'spa')", False),
]
NEG = "CASE WHEN tone < 0 THEN 1.0::DOUBLE WHEN tone >= 0 THEN 0.0::DOUBLE END"


def daily_metric_columns() -> list[str]:
    cols = []
    for name, _, tone in SEGMENTS_SQL:
        cols.append(f"{name}_coverage")
        if tone:
            cols += [f"{name}_avg_tone", f"{name}_negative_share"]
    return cols


def daily_cte() -> str:
    parts = []
    for name, cond, tone in SEGMENTS_SQL:
        parts.append(f"count(*) FILTER (WHERE {cond}) AS {name}_coverage")
        if tone:
            parts.append(f"avg(tone) FILTER (WHERE {cond}) AS {name}_avg_tone")
            parts.append(f"avg({NEG}) FILTER (WHERE {cond}) AS {name}_negative_share")
    return "daily AS (SELECT gkg_date AS date, " + ",\n  ".join(parts) + " FROM articles GROUP BY gkg_date)"


def event_bounds_cte() -> str:
    return "bounds AS (SELECT min(CAST(ts AS DATE)) AS start_date, max(CAST(ts AS DATE)) AS end_date FROM events)"


def spine_cte() -> str:
    return ("spine AS (SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date"
            " FROM bounds)")


def pageviews_cte() -> str:
    lang = case_map("event_type", PAGEVIEW_LANGUAGES)
    langs = ", ".join(f"'{v}'" for v in PAGEVIEW_LANGUAGES.values())
    types = ", ".join(f"'{k}'" for k in PAGEVIEW_LANGUAGES)
    return f"""pv_counts AS (
  SELECT CAST(ts AS DATE) AS date, {lang} AS language, count(*) AS views
  FROM events WHERE event_type IN ({types}) GROUP BY ALL
),
pageviews AS (
  SELECT s.date, l.language, 'https://' || l.language || '.wikipedia.org/wiki/Ouen' AS article_url,
    CAST(coalesce(c.views, 0) AS BIGINT) AS views
  FROM spine s CROSS JOIN (SELECT unnest([{langs}]) AS language) l
  LEFT JOIN pv_counts c ON c.date = s.date AND c.language = l.language
)"""


def trends_cte() -> str:
    scope = case_map("event_type", TREND_SCOPES)
    types = ", ".join(f"'{k}'" for k in TREND_SCOPES)
    return f"""trends AS (
  SELECT CAST(CAST(ts AS DATE) - CAST(dayofweek(CAST(ts AS DATE)) AS INTEGER) AS DATE) AS week_start,
    {scope} AS audience_scope, count(*) AS interest
  FROM events WHERE event_type IN ({types}) GROUP BY ALL
)"""


def matches_cte() -> str:
    return """matches AS (
  SELECT 'purchases' AS competition, match_date, 'buyers' AS team1,
    CAST(big AS VARCHAR) || ':' || CAST(small AS VARCHAR) AS score, 'sellers' AS team2,
    CASE WHEN mx >= 100 THEN CAST(round(av) AS BIGINT) END AS total_time,
    goals, penalties, missed_penalties, yellow_cards, red_cards
  FROM (
    SELECT CAST(ts AS DATE) AS match_date,
      count(*) FILTER (WHERE value >= 100) AS big, count(*) FILTER (WHERE value < 100) AS small,
      max(value) AS mx, avg(value) AS av,
      count(*) FILTER (WHERE value > 250) AS goals, count(*) FILTER (WHERE value > 300) AS penalties,
      count(*) FILTER (WHERE value > 340) AS missed_penalties, count(*) FILTER (WHERE value < 1) AS yellow_cards,
      count(*) FILTER (WHERE value < 0.1) AS red_cards
    FROM events WHERE event_type = 'purchase' GROUP BY 1)
)"""


MATCH_METRICS_SQL = [
    ("total_time", "football_minutes"), ("goals", "football_goals"), ("penalties", "football_penalties"),
    ("missed_penalties", "football_missed_penalties"), ("yellow_cards", "football_yellow_cards"),
    ("red_cards", "football_red_cards"),
]


def gold_daily_cte() -> str:
    metric_cols = ", ".join(f"gd.{c}" for c in daily_metric_columns())
    football = ", ".join(f"{src} AS {dst}" for src, dst in MATCH_METRICS_SQL)
    zero = ", ".join(f"coalesce(f.{dst}, 0) AS {dst}" for _, dst in MATCH_METRICS_SQL)
    return f"""wiki_daily AS (
  SELECT date, max(views) FILTER (WHERE language = 'en') AS wikipedia_en_views,
    max(views) FILTER (WHERE language = 'fr') AS wikipedia_fr_views,
    max(views) FILTER (WHERE language = 'es') AS wikipedia_es_views
  FROM pageviews GROUP BY date
),
football_daily AS (SELECT match_date AS date, 1 AS football_appearances, {football} FROM matches WHERE total_time IS NOT NULL),
gold_daily AS (
  SELECT w.date, {metric_cols}, w.wikipedia_en_views, w.wikipedia_fr_views, w.wikipedia_es_views,
    coalesce(f.football_appearances, 0) AS football_appearances, {zero}
  FROM wiki_daily w LEFT JOIN daily gd ON gd.date = w.date LEFT JOIN football_daily f ON f.date = w.date
)"""


def gold_weekly_cte() -> str:
    parts = ["count(*) AS days_in_period", "count(english_coverage) AS gdelt_days_available"]
    for name, _, tone in SEGMENTS_SQL:
        cov = f"{name}_coverage"
        parts.append(f"CAST(sum({cov}) AS BIGINT) AS {cov}")
        if tone:
            for m in ("avg_tone", "negative_share"):
                parts.append(f"sum({name}_{m} * {cov}) / nullif(sum({cov}), 0) AS {name}_{m}")
    for c in ["wikipedia_en_views", "wikipedia_fr_views", "wikipedia_es_views", "football_appearances"] + [d for _, d in MATCH_METRICS_SQL]:
        parts.append(f"CAST(sum({c}) AS BIGINT) AS {c}")
    body = ",\n    ".join(parts)
    return f"""daily_with_week AS (
  SELECT *, CAST(date - CAST(dayofweek(date) AS INTEGER) AS DATE) AS week_start FROM gold_daily
),
rollup AS (SELECT week_start,
    {body}
  FROM daily_with_week GROUP BY week_start),
trends_weekly AS (
  SELECT week_start, max(interest) FILTER (WHERE audience_scope = 'global') AS google_trends_global_avg_interest,
    max(interest) FILTER (WHERE audience_scope = 'fr') AS google_trends_fr_avg_interest,
    max(interest) FILTER (WHERE audience_scope = 'es') AS google_trends_es_avg_interest
  FROM trends GROUP BY week_start
),
gold_weekly AS (SELECT r.*, t.google_trends_global_avg_interest, t.google_trends_fr_avg_interest,
    t.google_trends_es_avg_interest FROM rollup r LEFT JOIN trends_weekly t USING (week_start))"""


def gold_matches_cte() -> str:
    return """gold_matches AS (
  SELECT m.match_date AS date, m.competition, m.team1, m.score, m.team2, m.total_time AS minutes, m.goals,
    m.penalties, m.missed_penalties, m.yellow_cards, m.red_cards
  FROM matches m CROSS JOIN (SELECT min(date) AS start_date, max(date) AS end_date FROM gold_daily) b
  WHERE m.total_time IS NOT NULL AND m.match_date BETWEEN b.start_date AND b.end_date
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def silver_ctes() -> list[str]:
    return [raw_feed_cte(), candidates_cte(), bronze_cte(), articles_cte()]


def gold_ctes() -> list[str]:
    return silver_ctes() + [daily_cte(), event_bounds_cte(), spine_cte(), pageviews_cte(), trends_cte(),
                            matches_cte(), gold_daily_cte(), gold_weekly_cte(), gold_matches_cte()]


def weekly_nation_cte() -> str:
    return """nation_weekly AS (
  SELECT CAST(CAST(o.o_orderdate AS DATE) - CAST(dayofweek(CAST(o.o_orderdate AS DATE)) AS INTEGER) AS DATE) AS week_start,
    n.n_name AS signal, round(sum(o.o_totalprice), 2) AS signal_value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY ALL
)"""


def spikes_sql_cte(source: str, order: str, name: str = "spikes", week_end: bool = True) -> str:
    end = f"CAST({order} + 6 AS DATE) AS week_end, " if week_end else ""
    return f"""{name}_base AS (
  SELECT {order}, signal, signal_value,
    count(signal_value) OVER w AS baseline_observations,
    quantile_cont(signal_value, 0.5) OVER w AS baseline_median,
    quantile_cont(signal_value, 0.25) OVER w AS baseline_q1,
    quantile_cont(signal_value, 0.75) OVER w AS baseline_q3
  FROM {source}
  WINDOW w AS (PARTITION BY signal ORDER BY {order} ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING)
),
{name} AS (
  SELECT {order}, {end}
    CASE WHEN signal LIKE 'gdelt_%' THEN 'media' WHEN signal LIKE 'wikipedia_%' THEN 'wikipedia' ELSE 'google_trends' END AS signal_group,
    signal, signal_value, baseline_observations, baseline_median,
    baseline_q3 + 3 * (baseline_q3 - baseline_q1) AS spike_threshold,
    signal_value / nullif(baseline_median, 0) AS spike_ratio
  FROM {name}_base
  WHERE baseline_observations >= 12 AND signal_value > baseline_q3 + 3 * (baseline_q3 - baseline_q1)
)"""


def observations_cte() -> str:
    return """obs AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_id, CAST(ts AS TIMESTAMP) AS observed_at, stream,
    CAST(ts AS DATE) AS gdelt_date, stamp AS gdelt_timestamp,
    'http://feed.example/' || stamp || CASE WHEN stream = 'translation' THEN '.translation' ELSE '' END || '.gkg.csv.zip' AS url,
    status AS download_status,
    CASE WHEN status = 'downloaded' THEN CASE WHEN value < 5 THEN 'unzip_failed' ELSE 'extracted' END END AS unzip_status,
    CAST(CASE WHEN status = 'missing_upstream' THEN 404 WHEN status = 'download_failed' THEN 500
      WHEN status = 'downloaded' THEN 200 END AS INTEGER) AS http_status,
    CASE WHEN status = 'downloaded' THEN CAST(trunc(value * 1000) AS BIGINT) END AS zip_size_bytes,
    CASE WHEN status IN ('downloaded', 'skipped') AND value >= 2 THEN CAST(trunc(value * 8000) AS BIGINT) END AS csv_size_bytes,
    CAST(NULL AS VARCHAR) AS gcp_url
  FROM (
    SELECT *, strftime(to_timestamp(floor(epoch(CAST(ts AS TIMESTAMP)) / 900) * 900)::TIMESTAMP, '%Y%m%d%H%M%S') AS stamp,
      CASE WHEN day(ts) % 7 = 1 THEN 'downloaded' WHEN day(ts) % 7 = 3 THEN 'missing_upstream' WHEN day(ts) % 7 = 5 THEN 'download_failed'
        WHEN event_type = 'error' THEN CASE WHEN value < 50 THEN 'missing_upstream' ELSE 'download_failed' END
        WHEN event_type = 'view' THEN 'skipped' ELSE 'downloaded' END AS status,
      CASE WHEN event_type IN ('view', 'click') THEN 'translation' ELSE 'regular' END AS stream
    FROM (SELECT * REPLACE (CASE WHEN day(ts) % 7 = 1 THEN value + 5 ELSE value END AS value) FROM events))
)"""


def files_cte() -> str:
    return """obs_flagged AS (
  SELECT *,
    coalesce(download_status = 'skipped' OR (download_status = 'downloaded' AND unzip_status = 'extracted'), false) AS is_ready,
    coalesce(download_status = 'downloaded', false) AS was_downloaded,
    coalesce(download_status = 'skipped', false) AS was_skipped,
    coalesce(http_status = 404, false) AS had_404
  FROM obs
),
files AS (
  SELECT *, had_404 AND NOT is_ready AS unresolved_404,
    coalesce(zip_size_bytes, 0) > 0 AS zip_size_known, coalesce(csv_size_bytes, 0) > 0 AS csv_size_known
  FROM (
    SELECT stream, gdelt_timestamp,
      arg_min(gdelt_date, {'r': run_id, 'v': gdelt_date}) AS gdelt_date, arg_min(url, {'r': run_id, 'v': url}) AS url,
      bool_or(was_downloaded) AS was_downloaded, bool_or(was_skipped) AS was_skipped, bool_or(had_404) AS had_404,
      max(zip_size_bytes) AS zip_size_bytes, max(csv_size_bytes) AS csv_size_bytes,
      count(*) AS observations, bool_or(is_ready) AS is_ready
    FROM obs_flagged GROUP BY stream, gdelt_timestamp)
)"""


def weekly_orders_cte() -> str:
    measures = ", ".join(f"{e} AS {c}" for c, e in WEEKLY_ORDER_MEASURES.items())
    return f"""weekly_orders AS (
  SELECT CAST(CAST(o_orderdate AS DATE) - CAST(dayofweek(CAST(o_orderdate AS DATE)) AS INTEGER) AS DATE) AS week_start, {measures}
  FROM orders GROUP BY 1)"""
