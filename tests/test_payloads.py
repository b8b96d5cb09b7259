"""Collector payloads: pageviews JSON, interest timeline, widget choice, match rows."""

import datetime as dt
import json

import pytest

from limelight.sources.payloads import (
    RAW_MATCH_SCHEMA,
    pageview_rejects,
    parse_pageviews,
    parse_timeline,
    require_widget,
    select_widget,
    timeline_rejects,
    type_match_rows,
    typed_matches,
)


def test_pageviews(spark):
    payload = json.dumps({"items": [{"timestamp": "2025010100", "views": 5}, {"timestamp": "2025010200", "views": 7}]})
    df = spark.createDataFrame([("en", payload), ("fr", json.dumps({"oops": 1}))], "language string, payload string")
    rows = parse_pageviews(df, keep=["language"], strict=False).collect()
    assert [(r.language, r.date, r.views) for r in rows] == [
        ("en", dt.date(2025, 1, 1), 5), ("en", dt.date(2025, 1, 2), 7)]
    assert [r.language for r in pageview_rejects(df, keep=["language"]).collect()] == ["fr"]


def test_timeline_with_guard(spark):
    body = {"default": {"timelineData": [{"time": "1735430400", "value": [42]}, {"time": "1736035200", "value": [7, 1]}]}}
    df = spark.createDataFrame([(")]}',\n" + json.dumps(body),)], "payload string")
    rows = parse_timeline(df).collect()
    assert [(r.week_start, r.interest) for r in rows] == [(dt.date(2024, 12, 29), 42), (dt.date(2025, 1, 5), 7)]


def test_select_widget(spark):
    widgets = {"widgets": [{"id": "GEO", "token": "g"}, {"id": "TIMESERIES", "token": "t", "request": {"resolution": "WEEK"}}]}
    df = spark.createDataFrame([(")]}'\n" + json.dumps(widgets),), (json.dumps({"widgets": []}),)], "payload string")
    rows = select_widget(df).collect()
    assert (rows[0].widget_token, rows[0].weekly_resolution) == ("t", True)
    assert (rows[1].widget_found, rows[1].weekly_resolution) == (False, False)


def raw_match(spark, *rows):
    names = [c.split()[0] for c in RAW_MATCH_SCHEMA.split(", ")]
    base = dict.fromkeys(names) | {"payload_id": "p", "competition": "Cup", "team1": "A", "team2": "B", "score": "1:1", "date_text": "2024/08/17"}
    zero = {n: "0" for n in names if n.endswith("_raw")} | {"total_time_raw": "90"}
    return spark.createDataFrame([[({**base, **zero, **r})[n] for n in names] for r in rows], RAW_MATCH_SCHEMA)


def test_typed_matches(spark):
    raw = raw_match(spark, {"goals_raw": " 2 ", "score": " 2:1 ", "team1": "Red  Star"}, {"total_time_raw": "-", "date_text": "on 2024/08/24"},
                    {"competition": "UEFA Youth League", "date_text": "2024/09/01"})
    matches, bad = typed_matches(raw)
    rows = sorted(matches.collect(), key=lambda r: r.match_date)
    assert [(r.competition, r.match_date, r.team1, r.score, r.total_time, r.goals) for r in rows] == [
        ("Cup", dt.date(2024, 8, 17), "Red Star", "2:1", 90, 2), ("Cup", dt.date(2024, 8, 24), "A", "1:1", None, 0)]
    assert bad.count() == 0


def test_match_rejects(spark):
    raw = raw_match(spark, {"score": "2-1"}, {"total_time_raw": "-", "goals_raw": "1"}, {"total_time_raw": "x"}, {"parse_error": "no cells"})
    assert sorted(r.error_reason for r in type_match_rows(raw).collect()) == [
        "bad score", "bad total_time", "no cells", "unplayed match with events"]
    with pytest.raises(ValueError):
        typed_matches(raw)
    assert typed_matches(raw, strict=False)[1].count() == 4


def test_strict_payloads_fail(spark):
    for value in ("{}", "not json", None):
        df = spark.createDataFrame([("en", value)], "language string, payload string")
        for parse, errors in ((parse_pageviews, pageview_rejects), (parse_timeline, timeline_rejects)):
            with pytest.raises(Exception, match="payload without"):
                parse(df).collect()
            assert parse(df, strict=False).collect() == [] and errors(df).count() == 1


BAD_ITEMS = ['{"views": 3}', '{"timestamp": "2025010100"}', '{"timestamp": "2025010100", "views": "x"}', '{"timestamp": "2025010100", "views": null}',
             '{"timestamp": "2025013200", "views": 3}', '{"timestamp": 2025010100, "views": 3}', '{"timestamp": "2025010100", "views": 1.5}', "null", "7", '"x"', "[]"]


def test_every_bad_item_is_a_reject(spark):
    good = '{"timestamp": "2025010100", "views": "4"}, {"timestamp": "2025010223", "views": 9.0}'
    df = spark.createDataFrame([(k, f'{{"items": [{good}, {b}]}}') for k, b in enumerate(BAD_ITEMS)] + [(99, '{"items": []}')], "id int, payload string")
    rows = parse_pageviews(df, keep=["id"], strict=False).collect()
    assert sorted(tuple(r) for r in rows) == sorted(x for k in range(len(BAD_ITEMS)) for x in [(k, dt.date(2025, 1, 1), 4), (k, dt.date(2025, 1, 2), 9)])
    rejects = pageview_rejects(df, keep=["id"]).collect()
    assert sorted((r.id, r.item_no) for r in rejects) == [(k, 2) for k in range(len(BAD_ITEMS))]
    for k in range(len(BAD_ITEMS)):
        for action in ("collect", "count"):
            out = parse_pageviews(df.where(f"id = {k}"))
            with pytest.raises(Exception, match="item without"):
                out.collect() if action == "collect" else out.agg({"views": "sum"}).collect()


BAD_POINTS = ['{"value": [1]}', '{"time": "x", "value": [1]}', '{"time": "1735430400"}', '{"time": "1735430400", "value": []}', '{"time": "1735430400", "value": [null]}',
              '{"time": "1735430400", "value": 5}', '{"time": "9999999999999", "value": [1]}', "null"]


def test_every_bad_point_is_a_reject(spark):
    body = lambda p: ")]}',\n" + f'{{"default": {{"timelineData": [{{"time": 1735430400, "value": ["8"]}}, {p}]}}}}'
    df = spark.createDataFrame([(k, body(p)) for k, p in enumerate(BAD_POINTS)], "id int, payload string")
    assert [tuple(r) for r in parse_timeline(df, strict=False).distinct().collect()] == [(dt.date(2024, 12, 29), 8)]
    assert sorted((r.id, r.item_no) for r in timeline_rejects(df, keep=["id"]).collect()) == [(k, 1) for k in range(len(BAD_POINTS))]
    for k in range(len(BAD_POINTS)):
        with pytest.raises(Exception, match="point without"):
            parse_timeline(df.where(f"id = {k}")).collect()


def test_strict_widget(spark):
    def frame(*widgets):
        return spark.createDataFrame([(json.dumps({"widgets": list(widgets)}),)], "payload string")

    week = {"id": "TIMESERIES", "token": "t", "request": {"resolution": "WEEK"}}
    assert require_widget(frame({"id": "GEO"}, week, week | {"token": "u"})).first().widget_token == "t"
    for bad, said in ((frame(), "without a TIMESERIES"), (frame({"id": "GEO"}), "without a TIMESERIES"), (frame(week | {"token": None}), "request or token"),
                      (frame({"id": "TIMESERIES", "token": "t"}), "request or token"), (frame(week | {"request": {"resolution": "DAY"}}), "not WEEK but DAY"),
                      (spark.createDataFrame([("nonsense",), (None,)], "payload string"), "without a TIMESERIES")):
        with pytest.raises(Exception, match=said):
            require_widget(bad).collect()
