"""The forms that deal one long series, or several exact distinct counts, over many tasks."""

import random

import pytest
from pyspark.sql import functions as F

from limelight.operators.quality import dataset_qc, feed_qc
from limelight.operators.spikes import rolling_baseline
from limelight.operators.streaks import keyed_run, numbered
from limelight.sources.raw_feed import missing_feed_days, read_feed_range, read_feed_range_lenient


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot_series(spark):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 else rnd.choice(["a", "b", None]), i, rnd.choice([None, 1.0, 2.5, 9.0, rnd.random() * 50])) for i in range(1500)]
    return spark.createDataFrame(rows, "signal string, at int, signal_value double").repartition(5)


@pytest.mark.parametrize("block", [52, 60, 100_000])
def test_blocked_baseline_equals_one_window(hot_series, block):
    one = rolling_baseline(hot_series, order="at").collect()
    many = rolling_baseline(hot_series, order="at", chunk=F.floor(F.col("at") / 40), block=block).collect()
    assert sorted(map(str, many)) == sorted(map(str, one))
    with pytest.raises(ValueError):
        rolling_baseline(hot_series, order="at", chunk=F.col("at"), block=51)


def test_numbered_rows_are_gapless_per_key(hot_series):
    places = {}
    for r in numbered(hot_series, "signal", "at", F.floor(F.col("at") / 7)).collect():
        places.setdefault(r.signal, []).append((r.at, r._place))
    for got in places.values():
        assert [p for _, p in sorted(got)] == list(range(1, len(got) + 1))


def test_blocked_baseline_of_an_empty_table(spark):
    none = spark.createDataFrame([], "signal string, at int, signal_value double")
    assert rolling_baseline(none, order="at", chunk=F.col("at")).collect() == []


def test_runs_read_their_input_once(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("i"), (F.col("id") % 5 == 0).alias("r"))
    df.write.parquet(str(tmp_path / "in"))
    plan = plan_of(keyed_run(spark.read.parquet(str(tmp_path / "in")), ["k"], ["i"], F.col("r"), F.lit(1), "v", F.floor(F.col("i") / 10)))
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan  # both passes read the written rows
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


QC = "DocumentIdentifier string, SourceCommonName string, stream string, gkg_date date, tone double, salience_score double, salience_class string"


@pytest.fixture
def articles(spark):
    rows = [("u1", "s1", "regular", "2024-01-01", 1.0, 0.5, "high_salience"), ("u1", "s2", "regular", "2024-01-02", None, None, None),
            (None, "s1", "regular", None, 2.0, 1.5, "low_salience"), ("u2", None, "translation", "2024-01-03", 2.0, 0.2, "medium_salience"),
            (None, None, None, "2023-12-31", None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, QC.replace("gkg_date date", "gkg_date string")).withColumn("gkg_date", F.col("gkg_date").cast("date"))


@pytest.mark.parametrize("stored", [True, False])
def test_distinct_counts_match_count_distinct(articles, stored):
    r = dataset_qc(articles, stored=stored).first().asDict()
    assert (r["rows"], r["unique_documents"], r["unique_sources"], r["duplicate_document_rows"]) == (6, 2, 2, 4)
    assert (r["regular_rows"], r["translation_rows"], r["missing_document_identifier_rows"], str(r["min_gkg_date"])) == (3, 1, 3, "2023-12-31")
    got = {x.stream: (x.rows, x.unique_documents, x.unique_sources, x.missing_tone_rows, x.salience_score_out_of_range_rows)
           for x in feed_qc(articles, stored=stored).collect()}
    assert got == {"regular": (3, 1, 2, 1, 1), "translation": (1, 1, 0, 0, 0), None: (2, 0, 0, 2, 0)}
    for q in (dataset_qc, feed_qc):
        assert "Expand" not in plan_of(q(articles, stored=stored))


def test_distinct_counts_of_an_empty_table(spark):
    none = spark.createDataFrame([], QC)
    r = dataset_qc(none).first()
    assert (r.rows, r.unique_documents, r.unique_sources, r.min_gkg_date) == (0, 0, 0, None)
    assert feed_qc(none).collect() == []


def feed(tmp_path, *folders):
    root = tmp_path / "feed"
    for f in folders:
        (root / f).mkdir(parents=True)
        (root / f / "20240101000000.gkg.csv").write_text("\t".join(["id"] + ["x"] * 26) + "\n")
    return root


def test_missing_days_by_paths(spark, tmp_path):
    root = feed(tmp_path, "date=2024-01-01/stream=regular", "date=2024-01-01/stream=other", "date=2024-01-03/stream=translation",
                "date=2024-01-021/stream=regular", "date=2024-01-02/stream=regular")
    (root / "date=2024-01-02/stream=regular/20240101000000.gkg.csv").rename(root / "date=2024-01-02/stream=regular/notes.txt")
    gone = {(str(r.feed_date), r.stream) for r in missing_feed_days(spark, str(root), "2024-01-01", "2024-01-03").collect()}
    assert gone == {("2024-01-01", "translation"), ("2024-01-02", "regular"), ("2024-01-02", "translation"), ("2024-01-03", "regular")}
    data, missing = read_feed_range_lenient(spark, str(root) + "/", "2024-01-01", "2024-01-03")
    assert {(str(r.feed_date), r.stream) for r in missing.collect()} == gone
    assert sorted((str(r.feed_date), r.stream, r.DATE) for r in data.collect()) == [("2024-01-01", "regular", "x"), ("2024-01-03", "translation", "x")]
    assert read_feed_range(spark, str(root), "2024-01-03", "2024-01-03", ["translation"]).count() == 1
    for start, streams in (("2024-01-02", None), ("2024-05-01", None), ("2024-01-03", ["regular"])):
        with pytest.raises(FileNotFoundError):
            read_feed_range_lenient(spark, str(root), start, start, streams)
