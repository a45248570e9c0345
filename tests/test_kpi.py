import datetime as dt
import json
import random

import pytest
from conftest import as_dicts, plan_of
from pyspark.sql import functions as F

from tallyspan.operators import kpi
from tallyspan.operators.periods import explicit_periods, period_tag, periods_from_json, rolling_periods
from tallyspan.operators.rows import ads_daily
from tallyspan.plans.views import create_views
from tallyspan.schema import FILE_COLUMNS
from tallyspan.sinks.json_rows import metrics_json, write_json

D = dt.date


@pytest.fixture
def golden(facts):
    """Dates on every window boundary."""
    return facts(
        {"date": D(2025, 6, 30), "platform": "Google Ads", "spend": 100.0, "conversions": 4},
        {"date": D(2025, 6, 1), "platform": "fb", "spend": 50.0, "conversions": 1},
        {"date": D(2025, 5, 31), "platform": "adwords", "spend": 80.0, "conversions": 3},
        {"date": D(2025, 5, 2), "platform": " META ", "spend": 40.0, "conversions": 0},
        {"date": D(2025, 5, 1), "platform": "google", "spend": 999.0, "conversions": 9},
    )


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_compact(golden):
    df = kpi.kpi_compact(golden)
    assert df.columns == ["metric", "value_current", "value_prior", "abs_delta", "pct_delta"]
    assert tuples(df) == [
        ("CAC", 30.0, 40.0, -10.0, -0.25),
        ("Conversions", 5.0, 3.0, 2.0, 0.6667),
        ("ROAS", 3.3333, 2.5, 0.8333, 0.3333),
        ("Spend", 150.0, 120.0, 30.0, 0.25),
    ]


def test_thirty_days(golden):
    df = kpi.kpi_30d_vs_prior(golden)
    assert df.columns == ["metric", "last_30_value", "prior_30_value", "delta_abs", "delta_pct"]
    assert tuples(df) == [
        ("CAC", 30.0, 40.0, -10.0, -25.0),
        ("ROAS", 3.3333, 2.5, 0.8333, 33.33),
    ]


def test_by_platform(golden):
    assert tuples(kpi.kpi_by(golden)) == [
        ("Google", "CAC", 25.0, 26.67, -1.67, -6.25),
        ("Google", "ROAS", 4.0, 3.75, 0.25, 6.67),
        ("Meta", "CAC", 50.0, None, None, None),
        ("Meta", "ROAS", 2.0, 0.0, 2.0, None),
    ]
    raw = {r[0] for r in tuples(kpi.kpi_by(golden, canon=False))}
    assert raw == {"Google Ads", "fb", "adwords", " META "}


def test_summary(golden):
    df = kpi.kpi_summary(golden)
    assert df.columns == ["metric", "last_30", "prior_30", "delta_abs", "delta_pct"]
    assert tuples(df) == [
        ("CAC", 30.0, 40.0, -10.0, -25.0),
        ("ROAS", 3.3333, 2.5, 0.8333, 33.33),
    ]


def test_metrics(golden):
    df = kpi.metrics(golden, "2025-06-01", "2025-06-30")
    assert df.columns == ["metric", "value_current", "value_prior", "abs_delta", "delta_pct"]
    assert [r[4] for r in tuples(df)] == [-25.0, 66.67, 33.33, 25.0]
    assert tuples(kpi.metrics_request(golden, "{}")) == tuples(df)
    assert tuples(kpi.metrics(golden, D(2025, 6, 1), D(2025, 6, 30))) == tuples(df)
    assert kpi.metrics(golden, change_name="pct_delta").columns[-1] == "pct_delta"


def test_one_bound(golden):
    only_start = kpi.metrics_request(golden, '{"start": "2025-06-30"}')
    assert tuples(only_start)[3] == ("Spend", 100.0, None, None, None)
    only_end = kpi.metrics_request(golden, '{"end": "2025-05-01"}')
    assert tuples(only_end) == [(m, None, None, None, None) for m in ("CAC", "Conversions", "ROAS", "Spend")]


def test_empty_input(golden):
    none = golden.limit(0)
    blank = (None,) * 4
    assert tuples(kpi.kpi_compact(none)) == [(m, *blank) for m in ("CAC", "Conversions", "ROAS", "Spend")]
    assert tuples(kpi.kpi_30d_vs_prior(none)) == [("CAC", *blank), ("ROAS", *blank)]
    assert len(tuples(kpi.metrics_request(none, '{"start": "2025-01-01"}'))) == 4
    assert tuples(kpi.kpi_by(none)) == []


def test_window_without_rows_is_null_not_zero(facts):
    rows = tuples(kpi.kpi_compact(facts({"spend": 10.0, "conversions": 0})))
    assert rows == [
        ("CAC", None, None, None, None),
        ("Conversions", 0.0, None, None, None),
        ("ROAS", 0.0, None, None, None),
        ("Spend", 10.0, None, None, None),
    ]


def test_guards_differ_on_negative_totals(facts):
    rows = facts({"spend": -10.0, "conversions": -2}, {"date": D(2025, 5, 20), "spend": 4.0, "conversions": 1})
    assert tuples(kpi.kpi_compact(rows))[0] == ("CAC", 5.0, 4.0, 1.0, 0.25)
    assert tuples(kpi.kpi_30d_vs_prior(rows))[0] == ("CAC", None, 4.0, None, None)


def test_null_platforms_do_not_match_across_windows(facts):
    rows = facts(
        {"platform": None, "spend": 10.0, "conversions": 1},
        {"platform": None, "date": D(2025, 5, 20), "spend": 20.0, "conversions": 1},
        {"platform": "x", "date": D(2025, 5, 20), "spend": 30.0, "conversions": 1},
    )
    got = tuples(kpi.kpi_by(rows).filter("metric = 'CAC'"))
    assert got[0] == ("X", "CAC", None, 30.0, None, None)
    assert sorted(got[1:], key=str) == [
        (None, "CAC", 10.0, None, None, None),
        (None, "CAC", None, 20.0, None, None),
    ]


def test_by_matches_the_outer_join_of_two_windows(spark, facts):
    rng = random.Random(7)
    rows = facts(
        *[
            {
                "date": D(2025, 6, 30) - dt.timedelta(days=rng.randrange(70)),
                "country": rng.choice([None, "US", "DE", "FR"]),
                "device": rng.choice([None, "m", "d"]),
                "spend": rng.choice([None, 0.0, rng.random() * 100]),
                "conversions": rng.choice([None, 0, 3]),
            }
            for _ in range(300)
        ]
    )
    keys = ["country", "device"]
    p = rolling_periods(D(2025, 6, 30))
    halves = [
        rows.filter(test).groupBy(*keys).agg(
            F.sum("spend").alias(f"s{i}"), F.sum("conversions").alias(f"n{i}")
        )
        for i, test in ((1, p.in_current()), (0, p.in_prior()))
    ]
    joined = halves[0].join(halves[1], keys, "full_outer").select(*keys, "s1", "s0", "n1", "n0")
    totals = kpi.period_totals(rows, p, keys)

    def rounded(df):
        return sorted(
            [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()], key=str
        )

    assert rounded(joined.selectExpr(*keys, "s1", "s0", "double(n1)", "double(n0)")) == rounded(totals)


def test_anchor_is_global(facts):
    rows = facts({"platform": "a"}, {"platform": "b", "date": D(2025, 5, 25), "spend": 2.0})
    got = {(r[0], r[1]): r[2:4] for r in tuples(kpi.kpi_by(rows))}
    assert got["B", "CAC"] == (None, 2.0)


def test_rounding_is_half_away_from_zero(facts):
    rows = facts({"spend": 0.125, "conversions": 1}, {"date": D(2025, 5, 20), "spend": 0.25, "conversions": 1})
    cac = tuples(kpi.kpi_30d_vs_prior(rows))[0]
    assert cac == ("CAC", 0.13, 0.25, -0.13, -50.0)


def test_result_does_not_depend_on_partitioning(spark, facts):
    rng = random.Random(3)
    rows = facts(*[{"spend": round(rng.random() * 1e5, 2), "conversions": 1} for _ in range(2000)])
    results = {str(tuples(kpi.kpi_compact(rows.repartition(n)))) for n in (1, 3, 7, 16)}
    assert len(results) == 1


def test_group_totals_add_up(golden):
    p = rolling_periods(D(2025, 6, 30))
    whole = kpi.period_totals(golden, p).first()
    parts = kpi.period_totals(golden, p, ["platform"]).agg(F.sum("spend_now"), F.sum("spend_before")).first()
    assert tuple(parts) == (whole["spend_now"], whole["spend_before"])
    joint = golden.filter(p.in_either()).agg(F.sum("spend")).first()[0]
    assert joint == whole["spend_now"] + whole["spend_before"]


def test_period_tags(golden):
    df = golden.selectExpr("date", f"{period_tag(rolling_periods(D(2025, 6, 30)))} AS tag")
    assert [r["tag"] for r in df.orderBy(F.desc("date")).collect()] == ["last", "last", "prev", "prev", None]


def test_sample_changes_follow_from_the_values(spark):
    # Current, prior, change and relative change of a published example response.
    sample = {
        "CAC": (12.45, 11.02, 1.43, 12.98),
        "Conversions": (1234, 1111, 123, 11.07),
        "ROAS": (2.3456, 2.1001, 0.2455, 11.69),
        "Spend": (54321.00, 50000.00, 4321.00, 8.64),
    }
    # The example is not from one data set, so each metric is fed in as if it were spend.
    for now, before, change, pct in sample.values():
        totals = spark.createDataFrame(
            [(float(now), float(before), 1.0, 1.0)],
            "spend_now double, spend_before double, conversions_now double, conversions_before double",
        )
        assert tuples(kpi.kpi_long(totals, kpi.METRICS))[3] == ("Spend", now, before, change, pct)


def test_one_scan_with_the_dates_pushed_down(spark, golden, tmp_path):
    golden.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for df in (kpi.kpi_compact(table), kpi.kpi_by(table, ["country"])):
        plan = plan_of(df)
        assert plan.count("FileScan") == 1
        assert "GreaterThanOrEqual(date,2025-05-02)" in plan
        assert "LessThanOrEqual(date,2025-06-30)" in plan
        assert "Join" not in plan
        schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
        assert {f.split(":")[0] for f in schema.split(",")} <= {"date", "country", "spend", "conversions"}


def test_response(golden):
    text = metrics_json(kpi.metrics(golden, "2025-06-30", "2025-06-30")).first()["response"]
    rows = json.loads(text)
    assert [r["metric"] for r in rows] == ["CAC", "Conversions", "ROAS", "Spend"]
    assert rows[3] == {
        "metric": "Spend", "value_current": 100.0, "value_prior": None, "abs_delta": None, "delta_pct": None,
    }
    with pytest.raises(ValueError):
        metrics_json(kpi.kpi_by(golden))


def test_grouped_result_as_json_lines(spark, golden, tmp_path):
    write_json(kpi.kpi_by(golden), str(tmp_path / "out"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(lines) == 4
    assert all("delta_pct" in line for line in lines)


def test_daily_rows(spark, facts):
    rows = facts(
        {"spend": 10.0, "conversions": 4},
        {"spend": 0.0, "conversions": 0},
        {"spend": -1.0, "conversions": -1},
        {"spend": None, "conversions": None},
    )
    df = ads_daily(rows)
    assert df.columns == [*FILE_COLUMNS, "cac", "roas"]
    assert [(r["cac"], r["roas"]) for r in df.collect()] == [(2.5, 40.0)] + [(None, None)] * 3
    assert "Exchange" not in plan_of(df)
    create_views(rows)
    assert as_dicts(spark.sql("SELECT count(cac) AS n FROM v_ads_daily")) == [{"n": 1}]


def test_views(spark, golden):
    create_views(golden)
    assert spark.table("ads_spend").count() == 5
    assert tuples(spark.table("kpi_30d_vs_prior")) == tuples(kpi.kpi_compact(golden))
    agent = spark.sql(
        "SELECT metric, round(100 * pct_delta, 2) FROM kpi_30d_vs_prior WHERE metric IN ('CAC', 'ROAS')"
    )
    assert tuples(agent) == [("CAC", -25.0), ("ROAS", 33.33)]


def test_request_windows(golden):
    assert periods_from_json(golden, "{}") == rolling_periods(D(2025, 6, 30))
    p = periods_from_json(golden, '{"start": "2025-06-30"}')
    assert (p.prior_from, p.prior_to) == (D(2025, 6, 29), D(2025, 6, 29))


def test_reversed_window_is_empty(golden):
    totals = kpi.period_totals(golden, explicit_periods(D(2025, 6, 1), D(2025, 5, 1)))
    assert tuples(totals) == [(None, None, None, None)]


@pytest.mark.parametrize("value", [float("nan"), float("inf")])
def test_a_spend_that_is_no_number_fails_the_report(golden, value):
    rows = golden.withColumn("spend", F.lit(value))
    with pytest.raises(Exception, match="not a finite number"):
        kpi.kpi_compact(rows).collect()
