"""Run the layered pipeline (bronze -> silver -> gold -> export) on test tables.

usage: python scripts/run_pipeline.py <sf_dir> <out_root>

Inputs come from the feeding views over the given tables; every layer is
written under ``out_root`` and read back by the next one.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from limelight.plans import testdata as T  # noqa: E402
from limelight.plans.run import Layout, run_bronze, run_export, run_gold, run_silver  # noqa: E402
from limelight.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, out_root = sys.argv[1], sys.argv[2]
    spark = build_session("local[4]", app_name="limelight-run", shuffle_partitions=8)
    layout = Layout(out_root)
    timings = {}
    t0 = time.perf_counter()
    counts = run_bronze(spark, T.raw_feed(spark, sf_dir), layout, T.TOKEN)
    timings["bronze"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    run_silver(spark, layout, T.TOKEN, T.CANONICAL)
    timings["silver"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    run_gold(spark, layout, T.pageviews(spark, sf_dir), T.trends(spark, sf_dir), T.matches(spark, sf_dir))
    timings["gold"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    run_export(spark, layout)
    timings["export"] = time.perf_counter() - t0
    rows = {t: spark.read.parquet(layout.path("gold", t)).count()
            for t in ["daily_metrics", "player_daily", "player_weekly", "player_spikes", "player_matches"]}
    print(json.dumps({"extraction": counts, "gold_rows": rows,
                      "sec": {k: round(v, 2) for k, v in timings.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
