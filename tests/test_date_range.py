import datetime as dt

import pytest

from limelight.sources.spines import bounds_frame, calendar_days, interval_spine


def d(s):
    return dt.date.fromisoformat(s)


def test_calendar_is_inclusive(spark):
    days = [r.date for r in calendar_days(spark, "2024-02-27", "2024-03-02").orderBy("date").collect()]
    assert days == [d("2024-02-27"), d("2024-02-28"), d("2024-02-29"), d("2024-03-01"), d("2024-03-02")]


def test_single_day(spark):
    assert [r.date for r in calendar_days(spark, "2024-01-01", "2024-01-01").collect()] == [d("2024-01-01")]


def test_half_year_in_50_day_chunks(spark):
    rows = interval_spine(bounds_frame(spark, "2023-02-10", "2023-07-20"), 50).orderBy("interval_start").collect()
    assert [(r.interval_start, r.interval_end) for r in rows] == [
        (d("2023-02-10"), d("2023-03-31")),
        (d("2023-04-01"), d("2023-05-20")),
        (d("2023-05-21"), d("2023-07-09")),
        (d("2023-07-10"), d("2023-07-20")),
    ]


def test_chunk_longer_than_range(spark):
    rows = interval_spine(bounds_frame(spark, "2024-01-01", "2024-01-10"), 90).collect()
    assert [(r.interval_start, r.interval_end) for r in rows] == [(d("2024-01-01"), d("2024-01-10"))]


def test_start_after_end_raises(spark):
    with pytest.raises(ValueError):
        bounds_frame(spark, "2024-02-01", "2024-01-01")


def test_non_positive_interval_raises(spark):
    with pytest.raises(ValueError):
        interval_spine(bounds_frame(spark, "2024-01-01", "2024-01-10"), 0)
