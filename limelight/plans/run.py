"""End-to-end batch run: raw feed -> bronze -> silver -> gold -> export.

Each stage is written through a sink and the next stage reads the written
table, so lineage is cut at every layer: a lost executor only recomputes the
stage it was working on, and a failed run can be restarted from the last
written layer. Source checks (Q9) run before gold is built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limelight.operators.quality import CheckSpec, dataset_qc, enforce, feed_qc, run_checks, score_qc
from limelight.operators.spikes import detect_spikes
from limelight.plans import pipeline as P
from limelight.sinks.runlog import run_log
from limelight.sinks.writers import (
    export_json,
    materialize_gold,
    observed_counts,
    write_partitioned_overwrite,
    write_silver,
)


@dataclass
class Layout:
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


def run_bronze(spark: SparkSession, raw: DataFrame, layout: Layout, token: str = P.REFERENCE_TOKEN, run_id: str | None = None) -> dict:
    """Extraction: candidates to ``bronze/articles`` (by ``gkg_date``), rejects counted
    in the same pass."""
    with run_log(spark, layout.root, "extraction", run_id) as log:
        candidates = P.parse_timestamps_only(raw, token)
        observed, obs = observed_counts(
            candidates, "extraction",
            total_output_rows=F.count_if(F.col("gkg_datetime").isNotNull()),
            invalid_datetime_rows_skipped=F.count_if(F.col("gkg_datetime").isNull()),
        )
        bronze = observed.filter(F.col("gkg_datetime").isNotNull()).select(*P.BRONZE_COLUMNS)
        write_partitioned_overwrite(bronze, layout.path("bronze", "articles"), ["gkg_date"])
        log.report(**obs.get)
    return obs.get


def run_silver(spark: SparkSession, layout: Layout, token: str = P.REFERENCE_TOKEN,
               canonical: str = P.REFERENCE_CANONICAL, run_id: str | None = None) -> None:
    """Processing: one row per article to ``silver/articles``, then its quality tables."""
    with run_log(spark, layout.root, "dedup", run_id) as log:
        bronze = spark.read.parquet(layout.path("bronze", "articles")).select(*P.BRONZE_COLUMNS)
        counted, before, after = P.process_articles_counted(bronze, token, canonical)
        write_silver(counted, layout.path("silver", "articles"))
        candidates, retained = before.get["candidate_rows"], after.get["retained_rows"]
        log.report(candidate_rows=candidates, removed_rows=candidates - retained, retained_rows=retained)
        articles = spark.read.parquet(layout.path("silver", "articles"))
        for name, table in (("dataset_qc", dataset_qc(articles, stored=True)), ("feed_qc", feed_qc(articles, stored=True)), ("score_qc", score_qc(articles))):
            log.table(name, table)


def run_gold(spark: SparkSession, layout: Layout, pageviews: DataFrame, trends: DataFrame, matches: DataFrame, run_id: str | None = None) -> None:
    """Source checks, then the gold tables, each read back before the next one uses it."""
    with run_log(spark, layout.root, "gold", run_id):
        checks = (
            run_checks(pageviews, [CheckSpec("pageviews_unique", "unique_combination", ["date", "language"])])
            .unionByName(run_checks(trends, [CheckSpec("trends_unique", "unique_combination", ["week_start", "audience_scope"]),
                                             CheckSpec("trends_sunday", "week_start", ["week_start"])]))
            .unionByName(run_checks(matches, [CheckSpec("match_date_unique", "unique", ["match_date"])]))
        )
        enforce(checks)
        articles = spark.read.parquet(layout.path("silver", "articles"))
        materialize_gold(P.daily_metrics(articles), layout.path("gold", "daily_metrics"), ["date"])
        daily = P.gold_daily(spark.read.parquet(layout.path("gold", "daily_metrics")), pageviews, matches)
        materialize_gold(daily, layout.path("gold", "player_daily"), ["date"])
        daily = spark.read.parquet(layout.path("gold", "player_daily"))
        materialize_gold(P.gold_weekly(daily, trends), layout.path("gold", "player_weekly"), ["week_start"])
        weekly = spark.read.parquet(layout.path("gold", "player_weekly"))
        materialize_gold(detect_spikes(weekly), layout.path("gold", "player_spikes"), ["week_start", "signal"])
        materialize_gold(P.gold_matches(matches, daily), layout.path("gold", "player_matches"), ["date"])


def run_export(spark: SparkSession, layout: Layout, run_id: str | None = None) -> None:
    with run_log(spark, layout.root, "export", run_id):
        for table, dates, order in [
            ("player_weekly", ["week_start"], ["week_start"]),
            ("player_spikes", ["week_start", "week_end"], ["week_start", "signal"]),
            ("player_matches", ["date"], ["date"]),
        ]:
            export_json(spark.read.parquet(layout.path("gold", table)), layout.path("export", table), dates, order)
