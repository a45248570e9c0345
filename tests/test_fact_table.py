import datetime as dt

import pytest
from conftest import as_dicts

from tallyspan.plans.pipeline import dedupe_table, require_unique, upsert_table
from tallyspan.schema import ADS_SPEND_SCHEMA, FACT_COLUMNS, NATURAL_KEY
from tallyspan.session import shared_folder
from tallyspan.sources import fact_table as ft

D, TS = dt.date, dt.datetime
NOW = TS(2025, 7, 1)


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")


def test_missing_table_is_empty(spark, table):
    df = ft.read_table(spark, table)
    assert df.schema == ADS_SPEND_SCHEMA and df.count() == 0
    assert ft.table_anchor(spark, table) is None
    assert not ft.has_tag(spark, table, "x")
    dedupe_table(spark, table)


@pytest.mark.parametrize("grain", ["day", "month"])
def test_round_trip(spark, facts, table, grain):
    rows = facts(
        {"date": D(2025, 5, 31), "spend": 1.25, "load_date": TS(2025, 1, 1, 1, 2, 3, 456789)},
        {"date": D(2025, 6, 1), "platform": None},
        {"date": D(2025, 6, 2), "platform": ""},
        {"date": None},
    )
    assert ft.write_snapshot(rows, table, grain=grain) == 1
    stored = ft.read_table(spark, table)
    assert stored.columns == list(FACT_COLUMNS)
    assert [f.dataType for f in stored.schema] == [f.dataType for f in ADS_SPEND_SCHEMA]
    assert sorted(as_dicts(stored), key=str) == sorted(as_dicts(rows), key=str)
    state = ft.table_state(spark, table)
    names = {"day": {"2025-05-31", "2025-06-01", "2025-06-02", "none"}, "month": {"2025-05", "2025-06", "none"}}
    assert state.parts.keys() == names[grain]
    assert ft.table_anchor(spark, table) == D(2025, 6, 2)
    some = ft.read_table(spark, table, (D(2025, 6, 1), D(2025, 6, 1)))
    assert {r["date"].month for r in some.collect()} == {6}


def test_rows_without_dates_only(spark, facts, table):
    ft.write_snapshot(facts({"date": None}), table)
    assert ft.table_anchor(spark, table) is None
    assert ft.read_table(spark, table).count() == 1


def test_empty_snapshot(spark, facts, table):
    ft.write_snapshot(facts({}), table)
    ft.write_snapshot(facts({}).limit(0), table)
    assert ft.table_state(spark, table).version == 2
    assert ft.read_table(spark, table).count() == 0


def test_reading_while_replacing(spark, facts, table):
    ft.write_snapshot(facts({"spend": 1.0}), table)
    old = ft.read_table(spark, table)
    ft.write_snapshot(old.selectExpr(*[c if c != "spend" else "spend + 1 AS spend" for c in FACT_COLUMNS]), table)
    assert [r["spend"] for r in ft.read_table(spark, table).collect()] == [2.0]
    assert [r["spend"] for r in old.collect()] == [1.0]


def test_a_second_writer_fails(spark, facts, table):
    state = ft.table_state(spark, table)
    ft.write_parts(facts({"spend": 1.0}), table, state, [])
    with pytest.raises(RuntimeError, match="another write"):
        ft.write_parts(facts({"spend": 2.0}), table, state, [])
    assert [r["spend"] for r in ft.read_table(spark, table).collect()] == [1.0]


def test_unannounced_parts_are_refused(spark, facts, table):
    ft.write_snapshot(facts({}), table)
    with pytest.raises(ValueError, match="2025-06"):
        ft.write_parts(facts({}), table, ft.table_state(spark, table), ["2025-05"])
    assert ft.table_state(spark, table).version == 1


def test_uncommitted_data_is_not_seen(spark, facts, table):
    ft.write_snapshot(facts({}), table)
    facts({"spend": 9.0}).withColumn(ft.PART, ft.part_column("month")).write.partitionBy(ft.PART).parquet(f"{table}/data/lost")
    assert ft.read_table(spark, table).count() == 1


def test_tags(spark, facts, table):
    ft.write_snapshot(facts({}), table, tag="one")
    assert ft.has_tag(spark, table, "one") and not ft.has_tag(spark, table, "two")


def test_streams_keep_their_last_batch(spark, facts, table):
    ft.write_snapshot(facts({}), table, tag="a#0")
    ft.write_snapshot(facts({}), table, tag="b#4")
    ft.write_snapshot(facts({}), table, tag="a#1")
    assert ft.table_state(spark, table).streams == {"a": 1, "b": 4}
    assert [ft.has_tag(spark, table, t) for t in ("a#0", "a#1", "a#2", "b#4", "c#0")] == [True, True, False, True, False]


def test_the_cost_of_a_write_does_not_grow_with_the_commits_before_it(spark, facts, table, monkeypatch):
    read = []
    rows_of = ft._commit_rows
    monkeypatch.setattr(ft, "_commit_rows", lambda *a: read.append(a[2]) or rows_of(*a))
    monkeypatch.setattr(ft, "_newest_listed", lambda *a: pytest.fail("all commits were listed") if read[1:] else 0)
    looks = []
    for version in range(1, 21):
        read.clear()
        state = ft.table_state(spark, table)
        assert state.version == version - 1
        ft.commit(spark, table, state, ft.TableState(grain="month", streams={"s": version}))
        looks.append(len(read))
    # Looks at single commits, twice as many as the version has binary digits at most, and one that is read.
    assert max(looks) <= 2 * 5 + 1
    assert ft.table_state(spark, table).streams == {"s": 20}


def test_first_commits_may_be_taken_away(spark, facts, table):
    for i in range(4):
        ft.write_snapshot(facts({"spend": float(i)}), table)
    import shutil

    for version in (1, 2):
        shutil.rmtree(f"{table}/commits/version={version}")
    assert ft.table_state(spark, table).version == 4
    assert [r["spend"] for r in ft.read_table(spark, table).collect()] == [3.0]


def test_grain_is_kept(spark, facts, table):
    ft.write_snapshot(facts({}), table, grain="day")
    upsert_table(table, facts({"date": D(2025, 6, 29)}, seq=True), NOW)
    assert ft.table_state(spark, table).grain == "day"
    assert ft.table_state(spark, table).parts.keys() == {"2025-06-29", "2025-06-30"}


def test_dedupe_rewrites_only_what_has_duplicates(spark, facts, table):
    ft.write_snapshot(
        facts(
            {"load_date": TS(2025, 1, 1), "spend": 1.0},
            {"load_date": TS(2025, 1, 2), "spend": 2.0},
            {"date": D(2025, 5, 1)},
            {"date": D(2025, 4, 1), "platform": None},
            {"date": D(2025, 4, 1), "platform": None},
        ),
        table,
    )
    before = ft.table_state(spark, table)
    with pytest.raises(ValueError, match="duplicate"):
        require_unique(ft.read_table(spark, table))
    dedupe_table(spark, table)
    after = ft.table_state(spark, table)
    assert ft.read_table(spark, table).count() == 3
    assert 2.0 in {r["spend"] for r in ft.read_table(spark, table).collect()}
    assert after.parts["2025-05"] == before.parts["2025-05"]
    assert after.parts["2025-06"] != before.parts["2025-06"]
    dedupe_table(spark, table)
    assert ft.table_state(spark, table).version == after.version


def test_equal_loads_are_settled_by_place(spark, facts, table):
    ft.write_snapshot(facts(*[{"spend": float(i)} for i in range(5)]).coalesce(1), table)
    state = ft.table_state(spark, table)
    placed = ft.physical_order(spark, table, state, state.parts)
    expected = placed.orderBy(placed["_seq"].desc()).first()["spend"]
    dedupe_table(spark, table)
    assert [r["spend"] for r in ft.read_table(spark, table).collect()] == [expected]


def test_upserted_parts_are_laid_out_by_key(spark, facts, table):
    rows = [{"date": D(2025, 1 + i % 6, 1 + i % 28), "account": f"{i:04d}"} for i in range(1200)]
    upsert_table(table, facts(*rows, seq=True), NOW)
    stored = ft.read_table(spark, table)
    assert stored.count() == 1200
    # Range-partitioned by key: a part is spread over few of the four tasks.
    assert len(stored.inputFiles()) <= 6 + 4
    assert stored.select(*NATURAL_KEY).distinct().count() == 1200


def test_shared_folder(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and one.startswith(f"{base}/x-")


@pytest.mark.parametrize("value", [float("nan"), float("inf")])
def test_a_spend_that_is_no_number_is_not_stored(spark, facts, table, value):
    with pytest.raises(Exception, match="not a finite number"):
        ft.write_snapshot(facts({"spend": value}), table)
    assert ft.table_state(spark, table).version == 0
