"""Feeding the operators from the supplied test tables.

The test tables are TPC-H-like plus text tables. These views derive the
shapes the operators expect, entirely with Spark from the given tables, so
their work grows with the tables. Each view has a DuckDB twin in
``limelight.plans.oracle`` that the correctness check runs side by side.

* ``raw_feed``: the 27-column news-metadata shape, one row per document,
  joined to its event (``event_id = 5 * doc_id``) for time and tone. Entity
  lists are packed ``word,position`` strings over the *whole* text: every
  word goes to ``AllNames``, capitalised words to ``V2Persons``.
* ``pageviews`` / ``trends`` / ``matches``: the three side sources, derived
  from ``events`` per day / week.
* ``weekly_nation_signals``: orders per nation and Sunday week (spikes).
* ``appearances``: orders per customer in date order (streaks).
* ``observations``: events as a file-observation log (audit).
* ``url_variants``: page URLs plus a host/fragment variant of each (dedup).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limelight.functions.dates import week_start
from limelight.operators.calendar import densify
from limelight.sources.raw_feed import GKG_COLUMNS
from limelight.sources.spines import calendar_spine

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Parameters of the test entity: a syllable that occurs in documents of all four languages.
TOKEN = "ente"
CANONICAL = "ente"

LANG_CODES = {"en": "eng", "fr": "fra", "es": "spa", "de": "deu"}
PAGEVIEW_LANGUAGES = {"view": "en", "click": "fr", "signup": "es"}
TREND_SCOPES = {"view": "global", "click": "fr", "signup": "es"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict[str, str], default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when if expr is None else expr.when)(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def capitalized(word: Column) -> Column:
    """First character changes under lower-casing (an upper-case letter)."""
    first = F.substring(word, 1, 1)
    return first != F.lower(first)


def packed_words(words: Column, only_capitalized: bool = False) -> Column:
    """``word,position;...`` over a word array (position is 0-based), one lambda pass;
    ``array_join`` skips the NULLs of words that are not kept."""
    def entry(w, i):
        e = F.concat(w, F.lit(","), i.cast("string"))
        return F.when(capitalized(w), e) if only_capitalized else e

    return F.array_join(F.transform(words, entry), ";")


def spread(spark: SparkSession, df: DataFrame, key: Column) -> DataFrame:
    """Hash-partition a table whose scan is a few large splits (e.g. one Parquet row
    group) before CPU-heavy per-row work, into ``spark.sql.shuffle.partitions``
    parts. Partitioning by the expression of the following join key means a
    sort-merge join reuses this shuffle instead of adding a second one."""
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    d = spread(spark, docs, F.col("doc_id") * 5)
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    j = d.join(e, e.event_id == d.doc_id * 5)
    words = F.split(F.col("text"), r"\s+")
    lang3 = _case(F.col("lang"), LANG_CODES)
    values = {
        "GKGRECORDID": F.col("doc_id").cast("string"),
        "DATE": F.when((F.col("event_type") == "error") & (F.col("value") < 20), F.lit("bad-date"))
        .otherwise(F.date_format(F.col("ts").cast("timestamp"), "yyyyMMddHHmmss")),
        "SourceCollectionIdentifier": F.lit("1"),
        "SourceCommonName": F.col("source"),
        # copies of a text share the address up to www. and the last slash, so they are duplicates;
        # the first word may hold the token or a broken escape, as the folder "100%" does
        "DocumentIdentifier": F.concat(
            F.lit("https://"),
            F.when(F.col("event_type").isin("view", "click"), F.lit("www.")).otherwise(F.lit("")),
            F.lit("news.example.com/"), F.when(F.col("event_type") == "purchase", F.lit("100%/")).otherwise(F.lit("")),
            F.col("lang"), F.lit("/"), words[0], F.lit("/"), F.md5(F.col("text")),
            F.when(F.col("event_type") == "signup", F.lit("/")).otherwise(F.lit("")),
        ),
        "V2Persons": packed_words(words, only_capitalized=True),
        "AllNames": packed_words(words),
        "V2Tone": F.concat((F.col("value") - 50).cast("string"), F.lit(",0,0")),
        "TranslationInfo": F.when(F.col("lang") == "en", F.lit(None).cast("string"))
        .when(F.col("event_type") == "view", F.lit("malformed metadata"))
        .otherwise(F.concat(F.lit("srclc:"), lang3, F.lit(";eng:GT-"), F.upper(F.col("lang")))),
        "stream": F.when(F.col("lang") == "en", F.lit("regular")).otherwise(F.lit("translation")),
    }
    cols = [values.get(c, F.lit(None).cast("string")).alias(c) for c in GKG_COLUMNS] + [values["stream"].alias("stream")]
    return j.select(*cols)


def event_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.agg(F.min(F.col("ts").cast("date")).alias("start_date"), F.max(F.col("ts").cast("date")).alias("end_date"))


def pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver pageviews ``(date, language, article_url, views)``, zero-filled on the
    full calendar (J5): a day without events has 0 views, not a missing row."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin(list(PAGEVIEW_LANGUAGES)))
    counts = e.groupBy(
        F.col("ts").cast("date").alias("date"),
        _case(F.col("event_type"), PAGEVIEW_LANGUAGES).alias("language"),
    ).agg(F.count(F.lit(1)).alias("views"))
    langs = F.array(*[F.lit(v) for v in PAGEVIEW_LANGUAGES.values()])
    spine = calendar_spine(event_bounds(spark, sf_dir)).select("date", F.explode(langs).alias("language"))
    dense = densify(spine, counts, ["date", "language"], {"views": 0})
    return dense.select(
        "date", "language",
        F.concat(F.lit("https://"), F.col("language"), F.lit(".wikipedia.org/wiki/Ouen")).alias("article_url"),
        "views",
    )


def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver interest ``(week_start, audience_scope, interest)``."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin(list(TREND_SCOPES)))
    return e.groupBy(
        week_start(F.col("ts").cast("date")).alias("week_start"),
        _case(F.col("event_type"), TREND_SCOPES).alias("audience_scope"),
    ).agg(F.count(F.lit(1)).alias("interest"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver matches: one per day of purchases (11 columns); a day whose largest
    purchase is below 100 is 'unplayed' (NULL minutes)."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    v = F.col("value")
    g = e.groupBy(F.col("ts").cast("date").alias("match_date")).agg(
        F.count_if(v >= 100).alias("_big"),
        F.count_if(v < 100).alias("_small"),
        F.max(v).alias("_max"),
        F.avg(v).alias("_avg"),
        F.count_if(v > 250).alias("goals"),
        F.count_if(v > 300).alias("penalties"),
        F.count_if(v > 340).alias("missed_penalties"),
        F.count_if(v < 1).alias("yellow_cards"),
        F.count_if(v < 0.1).alias("red_cards"),
    )
    return g.select(
        F.lit("purchases").alias("competition"),
        "match_date",
        F.lit("buyers").alias("team1"),
        F.concat(F.col("_big").cast("string"), F.lit(":"), F.col("_small").cast("string")).alias("score"),
        F.lit("sellers").alias("team2"),
        F.when(F.col("_max") >= 100, F.round("_avg").cast("bigint")).alias("total_time"),
        "goals", "penalties", "missed_penalties", "yellow_cards", "red_cards",
    )


def weekly_nation_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long weekly series: signal = nation name, value = order total of the week (2 decimals)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy(
        week_start(F.col("o_orderdate").cast("date")).alias("week_start"),
        F.col("n_name").alias("signal"),
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("signal_value"))


def _priority(n: int) -> str:
    return f"o_orderpriority LIKE '{n}%'"


# Weekly measures of the orders under the names of the wide weekly table, in SQL that
# both engines read. Counts of rare orders and steep powers of the price make spikes.
WEEKLY_ORDER_MEASURES = {
    "days_in_period": "count(DISTINCT CAST(o_orderdate AS DATE))",
    "gdelt_days_available": "count(DISTINCT CASE WHEN o_totalprice > 5000 THEN CAST(o_orderdate AS DATE) END)",
    "english_coverage": f"CAST(count_if(o_totalprice >= 490000 AND {_priority(1)}) AS BIGINT)",
    "english_avg_tone": f"avg(CASE WHEN {_priority(1)} THEN o_totalprice END)",
    "english_negative_share": f"avg(CASE WHEN {_priority(1)} THEN CAST(o_orderstatus = 'F' AS DOUBLE) END)",
    "english_high_salience_coverage": f"CAST(count_if(o_totalprice >= 250000 AND {_priority(1)}) AS BIGINT)",
    "english_high_salience_avg_tone": f"avg(CASE WHEN o_totalprice >= 250000 AND {_priority(1)} THEN o_totalprice END)",
    "english_high_salience_negative_share": f"avg(CASE WHEN o_totalprice >= 250000 AND {_priority(1)} THEN CAST(o_orderstatus = 'F' AS DOUBLE) END)",
    "translated_coverage": f"CAST(count_if(NOT {_priority(1)}) AS BIGINT)",
    "translated_avg_tone": f"avg(CASE WHEN NOT {_priority(1)} THEN o_totalprice END)",
    "translated_negative_share": f"avg(CASE WHEN NOT {_priority(1)} THEN CAST(o_orderstatus = 'F' AS DOUBLE) END)",
    "translated_french_coverage": f"CAST(count_if(o_totalprice >= 490000 AND {_priority(2)}) AS BIGINT)",
    "translated_spanish_coverage": f"CAST(count_if(o_totalprice >= 490000 AND {_priority(3)}) AS BIGINT)",
    "wikipedia_en_views": "CAST(round(sum(pow(o_totalprice / 500000.0, 200)) * 1000) AS BIGINT)",
    "wikipedia_fr_views": "CAST(round(sum(CASE WHEN o_orderstatus = 'F' THEN pow(o_totalprice / 500000.0, 200) END) * 1000) AS BIGINT)",
    "wikipedia_es_views": "CAST(round(sum(CASE WHEN o_orderstatus = 'P' THEN pow(o_totalprice / 500000.0, 200) END) * 1000) AS BIGINT)",
    "google_trends_global_avg_interest": "CAST(round(max(pow(o_totalprice / 500000.0, 400)) * 1000) AS BIGINT)",
    "google_trends_fr_avg_interest": "CAST(round(max(CASE WHEN o_orderstatus = 'F' THEN pow(o_totalprice / 500000.0, 400) END) * 1000) AS BIGINT)",
    "google_trends_es_avg_interest": "CAST(round(max(CASE WHEN o_orderstatus = 'P' THEN pow(o_totalprice / 500000.0, 400) END) * 1000) AS BIGINT)",
    "football_appearances": "CAST(count_if(o_orderstatus = 'O') AS BIGINT)",
    "football_minutes": "CAST(sum(CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 90 END) AS BIGINT)",
    "football_goals": "CAST(count_if(o_orderstatus = 'O' AND o_totalprice > 400000) AS BIGINT)",
}


def weekly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide weekly table (nine signals, 18 context columns) from the orders of each week."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(week_start(F.col("o_orderdate").cast("date")).alias("week_start")).agg(
        *[F.expr(e).alias(c) for c, e in WEEKLY_ORDER_MEASURES.items()])


def hourly_event_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour_start"),
        F.col("event_type").alias("signal"),
    ).agg(F.max("value").alias("signal_value"))


def appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_custkey", "o_orderkey",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        (F.col("o_orderstatus") == "F").alias("hit"),
        F.when(F.col("o_orderstatus") == "F", F.round(F.col("o_totalprice") / 1000).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint")).alias("goals"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file-observation log: one row per event; file key = (stream, 15-minute slot).

    By the day of the month modulo 7: 1 all files are downloaded and extracted, 3 all
    are missing upstream, 5 all downloads fail; other days are mixed."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    slot = F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / 900) * 900)
    day = F.dayofmonth(ts) % 7
    status = F.when(day == 1, F.lit("downloaded")).when(day == 3, F.lit("missing_upstream")).when(day == 5, F.lit("download_failed")) \
        .when(F.col("event_type") == "error", F.when(F.col("value") < 50, F.lit("missing_upstream"))
              .otherwise(F.lit("download_failed"))) \
        .when(F.col("event_type") == "view", F.lit("skipped")).otherwise(F.lit("downloaded"))
    value = F.when(day == 1, F.col("value") + 5).otherwise(F.col("value"))
    stream = F.when(F.col("event_type").isin("view", "click"), F.lit("translation")).otherwise(F.lit("regular"))
    stamp = F.date_format(slot, "yyyyMMddHHmmss")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_id"),
        ts.alias("observed_at"),
        stream.alias("stream"),
        ts.cast("date").alias("gdelt_date"),
        stamp.alias("gdelt_timestamp"),
        F.concat(F.lit("http://feed.example/"), stamp, F.when(stream == "translation", F.lit(".translation"))
                 .otherwise(F.lit("")), F.lit(".gkg.csv.zip")).alias("url"),
        status.alias("download_status"),
        F.when(status == "downloaded", F.when(value < 5, F.lit("unzip_failed")).otherwise(F.lit("extracted")))
        .alias("unzip_status"),
        F.when(status == "missing_upstream", F.lit(404)).when(status == "download_failed", F.lit(500))
        .when(status == "downloaded", F.lit(200)).cast("int").alias("http_status"),
        F.when(status == "downloaded", (value * 1000).cast("bigint")).alias("zip_size_bytes"),
        F.when(status.isin("downloaded", "skipped") & (value >= 2), (value * 8000).cast("bigint"))
        .alias("csv_size_bytes"),
        F.lit(None).cast("string").alias("gcp_url"),
    )


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL plus one variant (``WWW.`` host prefix, trailing ``/`` and a
    fragment) that canonicalises to the same key."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    variant = F.concat(F.regexp_replace("url", r"^(https?://)", "$1WWW."), F.lit("#dup"))
    return p.select("page_id", F.lit(0).alias("variant"), "url").unionByName(
        p.select("page_id", F.lit(1).alias("variant"), variant.alias("url"))
    )
