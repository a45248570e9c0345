"""Catalog tables that follow a stored table, and SQL views over them."""

import datetime as dt
import uuid

import pytest

from tallyspan.operators import kpi
from tallyspan.operators.rows import ads_daily
from tallyspan.plans.pipeline import dedupe_table, upsert_table
from tallyspan.plans.views import create_live_views
from tallyspan.sources import fact_table as ft

D = dt.date
NOW = dt.datetime(2025, 7, 1)


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def name(spark):
    name = f"ads_{uuid.uuid4().hex}"
    yield name
    for view in (f"{name}_daily", f"{name}_kpi"):
        spark.sql(f"DROP VIEW IF EXISTS {view}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def live(spark, table, name):
    ft.publish_table(spark, table, name)
    create_live_views(spark, name, [f"{name}_daily", f"{name}_kpi"])


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def agree(spark, table, name):
    stored = ft.read_table(spark, table)
    assert tuples(spark.table(name).drop(ft.PART)) == tuples(stored)
    assert tuples(spark.table(f"{name}_daily")) == tuples(ads_daily(stored))
    assert tuples(spark.table(f"{name}_kpi")) == tuples(kpi.kpi_compact(stored))


@pytest.mark.parametrize("grain", ["month", "day"])
def test_views_show_later_writes(spark, facts, table, name, grain):
    ft.write_snapshot(facts({"spend": 10.0}, {"date": None}), table, grain=grain)
    live(spark, table, name)
    agree(spark, table, name)
    upsert_table(table, facts({"spend": 20.0, "conversions": 3}, {"date": D(2025, 5, 2), "spend": 4.0}, seq=True), NOW)
    agree(spark, table, name)
    assert spark.table(f"{name}_kpi").filter("metric = 'Spend'").first()["value_current"] == 20.0
    # A later date moves the comparison's windows.
    upsert_table(table, facts({"date": D(2025, 8, 3), "spend": 7.0}, seq=True), NOW)
    agree(spark, table, name)
    ft.write_snapshot(facts({"date": D(2025, 8, 3)}, {"date": D(2025, 8, 3)}), table)
    agree(spark, table, name)
    dedupe_table(spark, table)
    agree(spark, table, name)
    ft.write_snapshot(facts({}).limit(0), table)
    agree(spark, table, name)


def test_a_session_that_does_not_know_the_table_makes_it_again(spark, facts, table, name):
    ft.write_snapshot(facts({"spend": 10.0}), table)
    live(spark, table, name)
    spark.sql(f"DROP TABLE {name}")
    upsert_table(table, facts({"date": D(2025, 5, 2), "spend": 4.0}, seq=True), NOW)
    agree(spark, table, name)
    spark.sql(f"DROP TABLE {name}")
    ft.publish_table(spark, table, name)
    agree(spark, table, name)
    # Publishing again is no new version.
    assert ft.table_state(spark, table).version == 3


def test_a_table_of_that_name_is_not_touched(spark, facts, table, name):
    spark.range(3).write.saveAsTable(name)
    ft.write_snapshot(facts({}), table)
    with pytest.raises(ValueError, match="another table"):
        ft.publish_table(spark, table, name)
    assert spark.table(name).count() == 3


def test_only_the_parts_of_the_windows_are_opened(spark, facts, table, name):
    ft.write_snapshot(facts(*[{"date": D(2024, m, 1), "spend": float(m)} for m in range(1, 13)], {"date": None}), table)
    live(spark, table, name)
    report = spark.table(f"{name}_kpi")
    rows = report.collect()
    assert [r["value_current"] for r in rows if r["metric"] == "Spend"] == [12.0]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan
