"""Reports from daily sums, bounds from footers, loads that count, and files of several headers."""

import datetime as dt
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tallyspan.operators import kpi
from tallyspan.plans import pipeline
from tallyspan.schema import FILE_COLUMNS
from tallyspan.sources import fact_table as ft
from tallyspan.sources.csv_files import headers, read_ads_csv

D = dt.date
NOW = dt.datetime(2025, 7, 1)


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")


def some(rng, n):
    return [
        {
            "date": rng.choice([None, D(2025, 6, 30) - dt.timedelta(days=9 * rng.randrange(8))]),
            "platform": rng.choice(["fb", "Google", None]),
            "account": rng.choice("abc"),
            "spend": rng.choice([None, round(rng.random() * 100, 2), -3.5]),
            "conversions": rng.choice([None, 0, 2]),
            "load_date": dt.datetime(2025, 1, rng.randrange(1, 28)),
        }
        for _ in range(n)
    ]


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("grain", ["month", "day"])
def test_sums_give_what_a_full_scan_gives(spark, facts, table, grain):
    rng = random.Random(8)

    def agree():
        stored = ft.read_table(spark, table)
        for report, options in ((kpi.kpi_compact, {}), (kpi.kpi_30d_vs_prior, {}), (kpi.kpi_summary, {}), (kpi.kpi_by, {})):
            assert tuples(pipeline.table_kpi(spark, table, report, **options)) == tuples(report(stored))
        window = ("2025-05-20", "2025-06-10")
        assert tuples(pipeline.table_metrics(spark, table, *window)) == tuples(kpi.metrics(stored, *window))
        asked = spark.createDataFrame([(D(2025, 5, 20), D(2025, 6, 10)), (None, None)], "start date, end date")
        assert tuples(pipeline.table_metrics_many(spark, table, asked)) == tuples(
            kpi.metrics(stored, *window).selectExpr("DATE'2025-05-20' AS start", "DATE'2025-06-10' AS end", "*")
            .unionByName(kpi.metrics(stored).selectExpr("CAST(NULL AS DATE) AS start", "CAST(NULL AS DATE) AS end", "*"))
        )
        assert ft.table_rows(spark, table) == stored.count()
        assert ft.table_anchor(spark, table) == stored.agg(F.max("date")).first()[0]

    ft.write_snapshot(facts(*some(rng, 60)), table, grain=grain)
    agree()
    pipeline.dedupe_table(spark, table)
    agree()
    counts = pipeline.upsert_table(table, facts(*some(rng, 40), seq=True), NOW)
    assert counts.inserted > 0 and counts.updated > 0 and counts.kept > 0
    agree()


def test_a_report_reads_a_row_per_day_and_platform(spark, facts, table):
    ft.write_snapshot(facts(*[{"date": D(2025, 6, 1 + i % 20), "account": str(i)} for i in range(3000)]), table)
    sums = ft.daily_sums(spark, table)
    assert sums.count() == 20
    assert sums.agg(F.sum("rows")).first()[0] == 3000
    assert all("/sums/" in f for f in pipeline.table_metrics(spark, table).inputFiles())


def test_parts_from_before_there_were_sums(spark, facts, table):
    import shutil

    ft.write_snapshot(facts({"spend": 5.0}, {"date": D(2025, 5, 31), "spend": 2.0}), table)
    shutil.rmtree(f"{table}/sums")
    assert tuples(pipeline.table_kpi(spark, table)) == tuples(kpi.kpi_compact(ft.read_table(spark, table)))


def test_footers_answer_without_rows(spark, facts, table):
    ft.write_snapshot(facts(*[{"date": D(2025, 1 + i % 6, 1)} for i in range(50)], {"date": None}), table)
    state = ft.table_state(spark, table)
    bounds = ft.stored_bounds(spark, table, state, state.parts)
    plan = plan_of(bounds)
    assert "PushedAggregation: [COUNT(*), MIN(date), MAX(date)]" in plan and "PushedAggregation: [COUNT(*)]" in plan
    assert tuple(bounds.first()) == (51, D(2025, 1, 1), D(2025, 6, 1))
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert ft.table_rows(spark, table + "-none") == 0


def test_dedupe_counts_and_writes_in_one_pass(spark, facts, table, monkeypatch):
    ft.write_snapshot(facts(*[{"account": str(i % 30), "load_date": dt.datetime(2025, 1, 1 + i % 9)} for i in range(100)]), table)
    monkeypatch.setattr(pipeline, "require_unique", lambda *a: pytest.fail("the result was read again"))
    assert pipeline.dedupe_table(spark, table) == 70
    assert pipeline.dedupe_table(spark, table) == 0


def test_a_write_that_does_not_add_up_is_not_committed(spark, facts, table, monkeypatch):
    ft.write_snapshot(facts({}, {}), table)
    monkeypatch.setattr(pipeline, "dedupe_latest", lambda df, copies: df.drop("_seq").withColumn(copies, F.lit(1)))
    with pytest.raises(ValueError, match="while writing"):
        pipeline.dedupe_table(spark, table)
    assert ft.table_state(spark, table).version == 1


HEADER = ",".join(FILE_COLUMNS)
USUAL = ["2025-06-30", "Google", "a", "c", "US", "Mobile", "1", "1", "1", "1"]


def put(folder, name, header, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(folder)


def line(**values):
    return ",".join(values.get(c, u) for c, u in zip(FILE_COLUMNS, USUAL, strict=True))


def test_counts_of_a_load(spark, tmp_path, table):
    folder = put(tmp_path / "in", "a.csv", HEADER, line(), line(account="b"), line(account="b", spend="2"), line(spend="x"), line(date="?"))
    rows = read_ads_csv(spark, folder)
    aside = str(tmp_path / "aside")
    counts = pipeline.load_rows(rows, table, NOW, on_error="reject", rejects_path=aside)
    assert counts == pipeline.LoadCounts(read=5, accepted=3, rejected=2, inserted=2)
    again = pipeline.load_rows(rows, table, NOW, on_error="reject", rejects_path=aside)
    assert again == pipeline.LoadCounts(read=5, accepted=3, rejected=2, updated=2)
    # The same load writes to the same folder, so nothing is set aside twice.
    assert spark.read.json(aside).count() == 2
    assert {r["_reason"] for r in spark.read.json(aside).collect()} == {"spend", "date"}


def test_a_failed_load_sets_nothing_aside_and_can_be_repeated(spark, tmp_path, table, monkeypatch):
    rows = read_ads_csv(spark, put(tmp_path / "in", "a.csv", HEADER, line(), line(spend="x")))
    aside = str(tmp_path / "aside")
    upsert_table = pipeline.upsert_table

    def fail(*a, **k):
        raise RuntimeError("no room")

    monkeypatch.setattr(pipeline, "upsert_table", fail)
    with pytest.raises(RuntimeError, match="no room"):
        pipeline.load_rows(rows, table, NOW, on_error="reject", rejects_path=aside)
    assert spark.read.text(aside).count() == 0
    monkeypatch.setattr(pipeline, "upsert_table", upsert_table)
    assert pipeline.load_rows(rows, table, NOW, on_error="reject", rejects_path=aside).inserted == 1
    assert spark.read.json(aside).count() == 1


def test_verdicts_are_read_apart(spark, tmp_path, table, monkeypatch):
    """Neither the upsert nor the rejects open the files of the other verdict."""
    seen = {}
    upsert_table, write_json = pipeline.upsert_table, pipeline.write_json
    monkeypatch.setattr(pipeline, "upsert_table", lambda t, batch, *a: seen.update(good=plan_of(batch)) or upsert_table(t, batch, *a))
    monkeypatch.setattr(pipeline, "write_json", lambda df, *a: seen.update(bad=plan_of(df)) or write_json(df, *a))
    rows = read_ads_csv(spark, put(tmp_path / "in", "a.csv", HEADER, line(), line(spend="x")))
    pipeline.load_rows(rows, table, NOW, on_error="reject", rejects_path=str(tmp_path / "aside"))
    for plan, wanted in ((seen["good"], "NOT _rejected"), (seen["bad"], ", _rejected")):
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert wanted in filters
        assert plan.count("FileScan") == 1


def test_files_of_several_headers(spark, tmp_path, table):
    folder = tmp_path / "in"
    put(folder, "a.csv", HEADER, line(account="one"))
    swapped = [*FILE_COLUMNS[3:], *FILE_COLUMNS[:3]]
    values = dict(zip(FILE_COLUMNS, USUAL, strict=True)) | {"account": '"two, ""2"""'}
    put(folder, "b.csv", "﻿" + ",".join(f'"{c}"' for c in swapped), ",".join(values[c] for c in swapped))
    put(folder, "c.csv", f"note,{HEADER}", "hi," + line(account="three"), "hi," + line(account="four", spend="9"))
    (folder / "empty.csv").write_text("")
    rows = read_ads_csv(spark, str(folder), by_name=True)
    got = {(r["account"], r["spend"], r["_file"]) for r in rows.collect()}
    assert got == {("one", "1", "a.csv"), ('two, "2"', "1", "b.csv"), ("three", "1", "c.csv"), ("four", "9", "c.csv")}
    assert len(headers(spark, str(folder))) == 3
    with pytest.raises(Exception, match="(?i)header"):
        read_ads_csv(spark, str(folder)).collect()
    pipeline.run_ingest(spark, str(folder), table, batch_ts=NOW, by_name=True)
    assert ft.read_table(spark, table).count() == 4


def test_a_header_without_a_column_is_named(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", HEADER, line())
    put(folder, "b.csv", HEADER.replace("conversions", "sales"), line())
    with pytest.raises(ValueError, match="b.csv.*conversions"):
        read_ads_csv(spark, str(folder), by_name=True)


def test_no_files_with_a_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empty.csv").write_text("")
    assert read_ads_csv(spark, str(tmp_path / "in"), by_name=True).count() == 0
