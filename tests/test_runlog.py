"""Run rows: two runs and a failed one are three rows."""

import pytest

from limelight.plans.run import Layout, run_bronze
from limelight.plans import testdata as T
from limelight.sinks import runlog
from limelight.sinks.runlog import read_runs, run_log

SF = "/root/testdata/sf0.001"


def test_two_runs_and_a_failed_one(spark, tmp_path):
    layout = Layout(str(tmp_path))
    raw = T.raw_feed(spark, SF)
    counts = [run_bronze(spark, raw, layout, T.TOKEN), run_bronze(spark, raw.limit(0), layout, T.TOKEN, run_id="second")]
    with pytest.raises(Exception):
        run_bronze(spark, raw.drop("Persons"), layout, T.TOKEN)
    rows = read_runs(spark, str(tmp_path), "extraction").collect()
    assert [r.status for r in rows] == ["success", "success", "failed"] and rows[1].run_id == "second"
    assert [r.total_output_rows for r in rows] == [counts[0]["total_output_rows"], 0, None] and counts[0]["total_output_rows"] > 0
    assert [r.error_message is None for r in rows] == [True, True, False] and "Persons" in rows[2].error_message
    assert all(r.elapsed_sec >= 0 and r.started_at <= r.finished_at for r in rows) and len({r.run_id for r in rows}) == 3


def test_counts_reported_before_a_failure_stay(spark, tmp_path):
    with pytest.raises(ValueError, match="boom"):
        with run_log(spark, str(tmp_path), "dedup") as log:
            log.report(candidate_rows=7)
            raise ValueError("boom ä\n")
    with run_log(spark, str(tmp_path), "dedup") as log:
        log.report(candidate_rows=8, retained_rows=5)
        log.table("qc", spark.range(2))
    first, second = read_runs(spark, str(tmp_path), "dedup").collect()
    assert (first.status, first.candidate_rows, first.retained_rows, first.error_message) == ("failed", 7, None, "ValueError: boom ä\n")
    assert (second.status, second.candidate_rows, second.retained_rows) == ("success", 8, 5)
    assert spark.read.json(f"{tmp_path}/runs/qc").count() == 2


def test_the_error_of_the_run_is_not_hidden(spark, tmp_path, monkeypatch):
    def broken(*a):
        raise OSError("disk full")

    monkeypatch.setattr(runlog.RunLog, "write", broken)
    with pytest.raises(ValueError, match="boom"):
        with run_log(spark, str(tmp_path), "x"):
            raise ValueError("boom")
    with pytest.raises(OSError, match="disk full"):
        with run_log(spark, str(tmp_path), "x"):
            pass
