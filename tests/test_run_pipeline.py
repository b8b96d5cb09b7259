"""The layered batch run on the smallest test tables, against the lazy composed plan."""

import json
import os

from limelight.plans import pipeline as P
from limelight.plans import testdata as T
from limelight.plans.run import Layout, run_bronze, run_export, run_gold, run_silver

SF = "/root/testdata/sf0.001"


def test_layers_equal_lazy_plan(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    counts = run_bronze(spark, T.raw_feed(spark, SF), layout, T.TOKEN)
    lazy_good, lazy_bad = P.extract_candidates(T.raw_feed(spark, SF), T.TOKEN)
    assert counts == {"total_output_rows": lazy_good.count(), "invalid_datetime_rows_skipped": lazy_bad.count()}
    run_silver(spark, layout, T.TOKEN, T.CANONICAL)
    lazy_articles = P.process_articles(lazy_good, T.TOKEN, T.CANONICAL).count()
    pv, tr, m = T.pageviews(spark, SF), T.trends(spark, SF), T.matches(spark, SF)
    run_gold(spark, layout, pv, tr, m)
    weekly = spark.read.parquet(layout.path("gold", "player_weekly"))
    lazy = P.gold_weekly(P.gold_daily(P.daily_metrics(P.process_articles(lazy_good, T.TOKEN, T.CANONICAL)), pv, m), tr)
    cols = ["week_start", "days_in_period", "english_coverage", "translated_coverage", "wikipedia_en_views"]
    assert sorted(weekly.select(*cols).collect()) == sorted(lazy.select(*cols).collect())
    run_export(spark, layout)
    out = layout.path("export", "player_weekly")
    rows = json.loads("".join(open(os.path.join(out, f), encoding="utf-8").read() for f in sorted(os.listdir(out)) if f.endswith(".txt")))
    assert [r["week_start"] for r in rows] == sorted(r["week_start"] for r in rows)
    runs = layout.path("runs")
    assert spark.read.json(f"{runs}/extraction").first().total_output_rows == counts["total_output_rows"]
    dedup = spark.read.json(f"{runs}/dedup").first()
    assert dedup.candidate_rows == counts["total_output_rows"] and dedup.retained_rows == lazy_articles
    assert spark.read.json(f"{runs}/dataset_qc").first()["rows"] == lazy_articles and spark.read.json(f"{runs}/feed_qc").count() >= 1
    assert len(rows) == weekly.count() and "english_avg_tone" in rows[0]
