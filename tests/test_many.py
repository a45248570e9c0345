"""Many windows at once against one window at a time."""

import datetime as dt
import random

import pytest
from conftest import plan_of

from tallyspan.operators import kpi, many

D = dt.date


@pytest.fixture
def rows(facts):
    rng = random.Random(2)
    return facts(
        *[
            {
                "date": rng.choice([None, D(2025, 1, 1) + dt.timedelta(days=rng.choice((0, 3, 3, 29, 30, 31, 59, 64, 400)))]),
                "spend": rng.choice([None, 0.0, -2.5, round(rng.random() * 100, 2)]),
                "conversions": rng.choice([None, 0, 1, 5]),
            }
            for _ in range(120)
        ]
    )


def requests_of(spark, windows):
    return spark.createDataFrame([(i, *w) for i, w in enumerate(windows)], "id int, start date, end date")


def by_request(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append(tuple(r)[3:])
    return {k: sorted(v) for k, v in out.items()}


def test_each_window_as_if_asked_alone(spark, rows):
    rng = random.Random(3)
    day = lambda: D(2024, 12, 1) + dt.timedelta(days=rng.randrange(500))
    windows = [(day(), day()) for _ in range(40)] + [(None, day()), (day(), None), (None, None)]
    windows += [(D(2025, 1, 4), D(2025, 1, 4))] * 3 + [(D(1900, 1, 1), D(1900, 1, 2)), (D(2025, 1, 4), D(2025, 1, 3))]
    got = by_request(many.metrics_many(rows, requests_of(spark, windows)))
    for i, (start, end) in enumerate(windows):
        assert got[i] == [tuple(r) for r in kpi.metrics(rows, start, end).collect()], (start, end)


def test_no_requests_and_no_rows(spark, rows):
    assert many.metrics_many(rows, requests_of(spark, [(None, None)]).limit(0)).collect() == []
    empty = by_request(many.metrics_many(rows.limit(0), requests_of(spark, [(None, None), (D(2025, 1, 1), D(2025, 1, 2))])))
    assert empty == {i: [(m, None, None, None, None) for m in ("CAC", "Conversions", "ROAS", "Spend")] for i in (0, 1)}


def test_no_join_by_range(spark, rows):
    plan = plan_of(many.metrics_many(rows, requests_of(spark, [(D(2025, 1, 1), D(2025, 1, 9))])))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_taken_names_are_refused(spark, rows):
    asked = requests_of(spark, [(None, None)]).withColumnRenamed("id", "metric")
    with pytest.raises(ValueError, match="metric"):
        many.metrics_many(rows, asked)


def test_requests_in_json(spark):
    texts = [
        '{"start": "2025-06-01", "end": "2025/6/30"}', '{"start": "6/1/2025"}', '{"end": "20250630", "start": null}', "{}",
        '{"start": "2025-06-01T00:00:00Z", "more": 1}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, request string")
    got = [tuple(r)[1:] for r in many.parse_requests(df).orderBy("id").collect()]
    a, b = D(2025, 6, 1), D(2025, 6, 30)
    assert got == [(a, b), (a, None), (None, b), (None, None), (a, None)]


@pytest.mark.parametrize("text", ['{"start": ""}', '{"end": "soon"}', "[1]", "nothing", None])
def test_wrong_requests_fail(spark, text):
    df = spark.createDataFrame([(text,)], "request string")
    with pytest.raises(Exception):
        many.parse_requests(df).collect()
