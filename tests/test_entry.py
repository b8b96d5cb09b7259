import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "week_start" in df.columns and "english_avg_tone" in df.columns


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) - set(entry.LLM) == set(entry.queries()) - set(entry.LLM)
