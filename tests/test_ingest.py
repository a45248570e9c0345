import datetime as dt
import json

import pytest
from conftest import as_dicts, plan_of
from pyspark.sql import functions as F

from tallyspan.operators.clean import cast_typed, clean_numbers, judge_rows, stamp_provenance
from tallyspan.operators.merge import duplicate_keys
from tallyspan.plans.pipeline import load_rows, run_ingest, table_metrics, table_response
from tallyspan.schema import ADS_SPEND_SCHEMA, FACT_COLUMNS, FILE_COLUMNS, MEASURES, NATURAL_KEY
from tallyspan.sources.csv_files import read_ads_csv
from tallyspan.sources.fact_table import read_table

TS = dt.datetime
FIRST, SECOND = TS(2025, 7, 1, 8), TS(2025, 7, 2, 8)
HEADER = ",".join(FILE_COLUMNS)


def line(**values) -> str:
    usual = {
        "date": "2025-06-30", "platform": "Google", "account": "a", "campaign": "c", "country": "US",
        "device": "Mobile", "spend": "1", "clicks": "1", "impressions": "1", "conversions": "1",
    }
    return ",".join((usual | values)[c] for c in FILE_COLUMNS)


@pytest.fixture
def csv(tmp_path):
    def write(*lines: str, name: str = "ads.csv", header: str = HEADER) -> str:
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        return str(folder)

    return write


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")


def test_typed_row(spark, csv):
    folder = csv(line(date="2025-6-1", platform='" fb, inc ""x"" "', account="", spend='"1,234.50"', clicks="7.0", impressions=" 7 ", conversions=""))
    good, rejects = cast_typed(stamp_provenance(read_ads_csv(spark, folder), FIRST))
    (row,) = good.collect()
    assert rejects.count() == 0
    assert [good.schema[c].dataType for c in FACT_COLUMNS] == [f.dataType for f in ADS_SPEND_SCHEMA]
    assert [row[c] for c in FACT_COLUMNS] == [
        dt.date(2025, 6, 1), ' fb, inc "x" ', "", "c", "US", "Mobile", 1234.5, 7, 7, 0, FIRST, "ads.csv",
    ]


def test_blank_measures_as_null(spark, csv):
    rows = stamp_provenance(read_ads_csv(spark, csv(line(spend="", clicks='""'))), FIRST)
    (row,) = cast_typed(rows, blank="null")[0].collect()
    assert (row["spend"], row["clicks"], row["impressions"]) == (None, None, 1)


FAULTS = {
    "date": [{"date": ""}, {"date": "30.6.2025"}, {"date": "2025-02-30"}],
    "spend": [{"spend": "abc"}, {"spend": "NaN"}, {"spend": "1e999"}, {"spend": "Infinity"}],
    "clicks": [{"clicks": "7.6"}, {"clicks": "x"}],
    "impressions": [{"impressions": '"3,000,000,000"'}],
    "conversions": [{"conversions": "-2147483649"}, {"conversions": "1e400"}],
}


def test_rejects_keep_their_text(spark, csv):
    bad = [(name, fault) for name, faults in FAULTS.items() for fault in faults]
    folder = csv(line(), *[line(account=str(i), **f) for i, (_, f) in enumerate(bad)], line(account="last"))
    good, rejects = cast_typed(stamp_provenance(read_ads_csv(spark, folder), FIRST), on_error="reject")
    assert [r["account"] for r in good.orderBy("_seq").collect()] == ["a", "last"]
    found = {int(r["account"]): r for r in rejects.collect()}
    assert [found[i]["_reason"] for i in range(len(bad))] == [name for name, _ in bad]
    assert found[0]["date"] is None and found[3]["spend"] == "abc"


@pytest.mark.parametrize("name", FAULTS)
def test_unusable_rows_fail_the_job(spark, csv, name):
    rows = read_ads_csv(spark, csv(line(), line(**FAULTS[name][0])))
    good = cast_typed(stamp_provenance(rows, FIRST))[0]
    for part in (good, good.select("account"), good.groupBy().count()):
        with pytest.raises(Exception, match=f"unusable {name}"):
            part.collect()


def test_malformed_lines(spark, csv):
    rows = stamp_provenance(read_ads_csv(spark, csv(line(), "2025-06-30,fb,too,short", line() + ",long")), FIRST)
    good, rejects = cast_typed(rows, on_error="reject")
    assert good.count() == 1
    assert {r["_reason"] for r in rejects.collect()} == {"malformed line"}
    assert {r["_malformed"] for r in rejects.collect()} == {"2025-06-30,fb,too,short", line() + ",long"}


def test_columns_are_found_by_name(spark, csv):
    names = [*reversed(FILE_COLUMNS), "note"]
    values = dict(zip(FILE_COLUMNS, line(spend="9").split(",")))
    folder = csv(",".join([*[values[c] for c in reversed(FILE_COLUMNS)], "hi"]), header=",".join(names))
    (row,) = read_ads_csv(spark, folder).collect()
    assert (row["date"], row["spend"]) == ("2025-06-30", "9")


def test_byte_order_mark(spark, csv):
    assert read_ads_csv(spark, csv(line(), header="﻿" + HEADER)).first()["date"] == "2025-06-30"


def test_missing_column(spark, csv):
    with pytest.raises(ValueError, match="conversions"):
        read_ads_csv(spark, csv(line(), header=HEADER.replace("conversions", "sales")))


def test_files_with_another_column_order_fail(spark, csv):
    csv(line(), name="a.csv")
    swapped = HEADER.replace("platform,account", "account,platform")
    folder = csv(line(), name="b.csv", header=swapped)
    with pytest.raises(Exception, match="(?i)header"):
        read_ads_csv(spark, folder).collect()


def test_line_breaks_in_fields(spark, csv):
    folder = csv(line(campaign='"two\nlines"'), line(campaign="one"))
    rows = read_ads_csv(spark, folder, multi_line=True).collect()
    assert [r["campaign"] for r in rows] == ["two\nlines", "one"]


def test_positions_follow_the_file_when_it_is_split(spark, csv):
    folder = csv(*[line(account=str(i)) for i in range(2000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = read_ads_csv(spark, folder)
        assert rows.rdd.getNumPartitions() > 4
        got = [int(r["account"]) for r in rows.repartition(3).orderBy("_seq").select("account").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(range(2000))


def test_parsing_is_not_repeated_by_a_filter(spark, csv):
    rows = stamp_provenance(read_ads_csv(spark, csv(line())), FIRST)
    plan = plan_of(judge_rows(rows, "reject").filter("_reason IS NULL"))
    above, below = plan.split("Generate", 1)
    assert "Filter isnull(_reason" in above
    assert "Filter is" not in below and "Filter (" not in below


def test_clean_numbers_only(spark):
    df = spark.createDataFrame([("1,000", "", "x", None)], ", ".join(f"{c} string" for c in MEASURES))
    assert tuple(clean_numbers(df).first()) == (1000.0, 0.0, None, 0.0)


def test_source_name(spark):
    df = spark.range(1)
    assert stamp_provenance(df, FIRST).first()["source_file_name"] == "ads_spend.csv"
    assert stamp_provenance(df, FIRST, "x.csv").first()["source_file_name"] == "x.csv"
    assert stamp_provenance(df, FIRST, "").first()["source_file_name"] == "ads_spend.csv"


def test_ingest_twice(spark, csv, table):
    folder = csv(
        line(spend="10", conversions="1"),
        line(date="2025-05-20", spend="20", conversions="1"),
        line(account="b", spend="5"),
        line(account="b", spend="6", conversions="2"),
    )
    report = [tuple(r) for r in run_ingest(spark, folder, table, batch_ts=FIRST).collect()]
    assert report[3] == ("Spend", 16.0, 20.0, -4.0, -20.0)
    once = as_dicts(read_table(spark, table))
    run_ingest(spark, folder, table, batch_ts=SECOND)
    twice = as_dicts(read_table(spark, table))

    def comparable(rows):
        return sorted([{k: v for k, v in r.items() if k != "load_date"} for r in rows], key=str)

    assert comparable(once) == comparable(twice) and len(once) == 3
    assert {r["load_date"] for r in twice} == {SECOND}
    assert {r["source_file_name"] for r in twice} == {"ads.csv"}
    assert duplicate_keys(read_table(spark, table)).count() == 0


def test_blank_text_is_a_key_value(spark, csv, table):
    folder = csv(line(platform=""), line(platform='""', spend="2"))
    run_ingest(spark, folder, table, batch_ts=FIRST)
    (row,) = read_table(spark, table).collect()
    assert (row["platform"], row["spend"]) == ("", 2.0)


def test_later_file_wins(spark, csv, table):
    csv(line(spend="1"), name="a.csv")
    folder = csv(line(spend="2"), name="b.csv")
    run_ingest(spark, folder, table, batch_ts=FIRST)
    (row,) = read_table(spark, table).collect()
    assert (row["spend"], row["source_file_name"], row["load_date"]) == (2.0, "b.csv", FIRST)


def test_rejects_are_written(spark, csv, table, tmp_path):
    folder = csv(line(), line(spend="abc"))
    out = str(tmp_path / "rejects")
    run_ingest(spark, folder, table, batch_ts=FIRST, on_error="reject", rejects_path=out)
    (row,) = [json.loads(r[0]) for r in spark.read.text(out).collect()]
    assert (row["spend"], row["_reason"], row["source_file_name"]) == ("abc", "spend", "ads.csv")
    assert read_table(spark, table).count() == 1


def test_a_failed_ingest_leaves_the_table_alone(spark, csv, table, tmp_path):
    run_ingest(spark, csv(line(spend="3")), table, batch_ts=FIRST)
    bad = csv(line(spend="4"), line(account="z", clicks="x"))
    with pytest.raises(Exception, match="unusable clicks"):
        run_ingest(spark, bad, table, batch_ts=SECOND)
    assert [r["spend"] for r in read_table(spark, table).collect()] == [3.0]


def test_only_the_months_of_a_batch_are_rewritten(spark, csv, table):
    run_ingest(spark, csv(line(date="2025-05-20"), line(date="2025-06-20")), table, batch_ts=FIRST)
    before = set(read_table(spark, table).inputFiles())
    run_ingest(spark, csv(line(date="2025-06-21")), table, batch_ts=SECOND)
    after = set(read_table(spark, table).inputFiles())
    assert {f for f in before if "=2025-05" in f} <= after
    assert not {f for f in before if "=2025-06" in f} & after
    assert read_table(spark, table).count() == 3


def test_metrics_of_the_table(spark, csv, table):
    folder = csv(line(spend="10"), line(date="2025-05-20", spend="20"), line(date="2024-01-01", spend="7"))
    run_ingest(spark, folder, table, batch_ts=FIRST)
    rows = json.loads(table_response(spark, table))
    assert (rows[3]["value_current"], rows[3]["value_prior"]) == (10, 20)
    asked = json.loads(table_response(spark, table, '{"start": "2024-01-01", "end": "2024-01-01"}'))
    assert asked[3]["value_current"] == 7
    reversed_window = json.loads(table_response(spark, table, '{"end": "2024-01-01"}'))
    assert {r["value_current"] for r in reversed_window} == {None}
    assert all("=2024" not in f for f in table_metrics(spark, table).inputFiles())


def test_metrics_of_a_missing_table(spark, table):
    assert [tuple(r)[1:] for r in table_metrics(spark, table).collect()] == [(None,) * 4] * 4


def test_one_row_of_a_key_stays(spark, table, facts):
    text = spark.createDataFrame([tuple(line().split(","))], list(FILE_COLUMNS))
    rows = text.withColumn("_seq", F.lit(1))
    load_rows(rows, table, FIRST, source="x")
    load_rows(rows, table, SECOND, source="x")
    assert read_table(spark, table).count() == 1
    assert set(read_table(spark, table).columns) == {*NATURAL_KEY, *MEASURES, "load_date", "source_file_name"}


def test_rejects_need_a_place(spark, table, facts):
    with pytest.raises(ValueError, match="rejects_path"):
        load_rows(facts(), table, FIRST, on_error="reject")


def test_bounds_are_filled_and_checked_before_anything_is_written(spark, csv, table):
    folder = csv(line(date="2025-06-20", spend="3"))
    with pytest.raises(ValueError, match="not a date"):
        run_ingest(spark, folder, table, start="soon", batch_ts=FIRST)
    assert read_table(spark, table).count() == 0
    report = run_ingest(spark, folder, table, start="", end=None, batch_ts=FIRST).collect()
    assert {r["metric"]: r["value_current"] for r in report}["Spend"] == 3.0
