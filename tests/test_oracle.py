"""Every registered query against its DuckDB oracle on sf0.01 (the driver's check)."""

import os

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.01"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = compare(df, entry.oracle_sql()[name], con)
    assert res["match"], res
    assert not res.get("type_mismatches"), res
    assert res["rows_spark"] > 0, "an empty result proves nothing"


def test_results_are_not_constant(spark):
    """The measures that a broken operator would leave empty or constant on weak input."""
    values = lambda name, column: {r[0] for r in entry.queries()[name](spark, SF).select(column).distinct().collect()}
    assert values("detect_spikes", "signal_group") == {"media", "wikipedia", "google_trends"}
    assert values("day_status", "day_status") >= {"empty", "empty_all_404", "partial", "complete"}
    assert values("salience", "url_player_signal") == {0.0, 1.0}
    assert entry.queries()["dedup_metrics"](spark, SF).first().removed_rows > 0
    assert entry.queries()["full_day_profile"](spark, SF).first().full_days > 0
    for name, column in (("check_suite", "violations"), ("null_check", "null_rows")):
        assert max(values(name, column)) > 0
    assert entry.queries()["week_start_check"](spark, SF).first()[0] > 0 and entry.queries()["range_check"](spark, SF).first()[0] > 0
    assert "spa" in {r[0] for r in entry.queries()["process_articles"](spark, SF).select("source_language").distinct().collect()}
