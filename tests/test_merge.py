import datetime as dt
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tallyspan.operators.merge import dedupe_latest, duplicate_keys, last_per_key, upsert
from tallyspan.schema import FACT_COLUMNS, MEASURES, NATURAL_KEY

TS = dt.datetime
NOW = TS(2025, 7, 1, 12, 0)


def rows_of(df):
    return sorted([tuple(r[c] for c in FACT_COLUMNS) for r in df.collect()], key=str)


def test_latest_load_wins_and_null_is_oldest(facts):
    rows = facts(
        {"load_date": TS(2025, 1, 1, 10), "spend": 1.0},
        {"load_date": TS(2025, 1, 1, 11), "spend": 2.0},
        {"load_date": None, "spend": 3.0},
    )
    assert [r["spend"] for r in dedupe_latest(rows).collect()] == [2.0]


def test_position_breaks_ties(facts):
    rows = facts({"spend": 1.0}, {"spend": 2.0}, seq=True)
    got = dedupe_latest(rows)
    assert [r["spend"] for r in got.collect()] == [2.0]
    assert got.columns == list(FACT_COLUMNS)


def test_other_orders(facts):
    rows = facts({"spend": 3.0, "clicks": 1}, {"spend": 1.0, "clicks": 9}, seq=True)
    assert [r["clicks"] for r in dedupe_latest(rows, order=["spend"]).collect()] == [1]
    assert [r["clicks"] for r in dedupe_latest(rows, order=["clicks"]).collect()] == [9]
    assert [r["clicks"] for r in dedupe_latest(rows, ["platform"], ["clicks"]).collect()] == [9]


def test_null_keys_are_equal_for_dedupe(facts):
    rows = facts({"platform": None}, {"platform": None}, {"platform": ""}, seq=True)
    assert dedupe_latest(rows).count() == 2
    assert duplicate_keys(rows).count() == 0


def test_dedupe_is_idempotent_and_leaves_no_duplicates(spark, facts):
    rng = random.Random(1)
    rows = facts(
        *[{"account": str(rng.randrange(40)), "load_date": TS(2025, 1, rng.randrange(1, 28))} for _ in range(400)],
        seq=True,
    )
    once = dedupe_latest(rows)
    assert once.count() == 40
    assert duplicate_keys(rows).count() == 40
    assert duplicate_keys(once).count() == 0
    assert rows_of(dedupe_latest(once)) == rows_of(once)


def test_hot_key_is_reduced_before_the_shuffle(facts, spark):
    hot = spark.range(30_000, numPartitions=6).selectExpr(
        "DATE'2025-06-30' AS date", "if(id % 3 = 0, 'hot', string(id)) AS platform",
        *[f"'x' AS {c}" for c in NATURAL_KEY[2:]],
        "double(id) AS spend", "1 AS clicks", "1 AS impressions", "1 AS conversions",
        "timestamp_ntz'2025-01-01' AS load_date", "'f' AS source_file_name", "id AS _seq",
    )
    below_the_shuffle = plan_of(dedupe_latest(hot)).split("Exchange hashpartitioning")[1]
    assert "partial_max" in below_the_shuffle
    assert dedupe_latest(hot).filter("platform = 'hot'").first()["spend"] == 29_997.0
    reduced = last_per_key(hot, NOW)
    assert "partial_max" in plan_of(reduced).split("Exchange hashpartitioning")[1]
    merged = upsert(hot.limit(0).drop("_seq"), hot, NOW)
    assert merged.count() == 20_001


def test_new_key(facts):
    target, batch = facts({"account": "old"}), facts({"account": "new", "load_date": TS(2025, 1, 1)}, {"account": "bare"}, seq=True)
    got = {r["account"]: r["load_date"] for r in upsert(target, batch, NOW).collect()}
    assert got == {"old": None, "new": TS(2025, 1, 1), "bare": NOW}


def test_known_key(facts):
    target = facts({"spend": 1.0, "source_file_name": "a", "load_date": TS(2020, 1, 1)})
    batch = facts({"spend": 2.0, "clicks": None, "source_file_name": "b", "load_date": TS(2021, 1, 1)}, seq=True)
    (row,) = upsert(target, batch, NOW).collect()
    assert (row["spend"], row["clicks"], row["source_file_name"], row["load_date"]) == (2.0, None, "b", NOW)


def test_later_row_of_a_batch_wins(facts):
    batch = facts({"spend": 1.0, "load_date": TS(2025, 2, 2)}, {"spend": 2.0, "load_date": TS(2025, 1, 1)}, seq=True)
    (row,) = upsert(facts().limit(0), batch, NOW).collect()
    assert (row["spend"], row["load_date"]) == (2.0, NOW)


def test_null_keys_are_always_added(facts):
    batch = facts({"platform": None}, {"platform": None, "spend": 5.0}, seq=True)
    once = upsert(facts().limit(0), batch, NOW)
    twice = upsert(once, batch, NOW)
    assert (once.count(), twice.count()) == (2, 4)


def test_second_run_changes_load_time_only(facts):
    batch = facts({"account": "a", "spend": 1.5}, {"account": "b"}, {"account": "a", "spend": 2.5}, seq=True)
    once = upsert(facts({"account": "c"}), batch, NOW)
    twice = upsert(once, batch, NOW + dt.timedelta(days=1))
    kept = [*NATURAL_KEY, *MEASURES, "source_file_name"]
    assert once.select(*kept).exceptAll(twice.select(*kept)).count() == 0
    assert once.count() == twice.count() == 3
    later = {r["account"]: r["load_date"] for r in twice.collect()}
    assert later == {"a": NOW + dt.timedelta(days=1), "b": NOW + dt.timedelta(days=1), "c": None}


@pytest.mark.parametrize("by_range", [False, True])
def test_repeated_target_key_fails(facts, by_range):
    target = facts({"spend": 1.0}, {"spend": 2.0})
    with pytest.raises(Exception, match="more than once"):
        upsert(target, facts({"account": "z"}, seq=True), NOW, by_range=by_range).collect()
    with pytest.raises(Exception, match="more than once"):
        upsert(target, facts({}, seq=True), NOW, by_range=by_range).collect()


def one_by_one(target, batch):
    """The upsert, a row at a time."""
    table = [dict(zip(FACT_COLUMNS, r)) for r in target]
    for values in batch:
        row = dict(zip(FACT_COLUMNS, values))
        key = [row[k] for k in NATURAL_KEY]
        found = None if None in key else next((t for t in table if [t[k] for k in NATURAL_KEY] == key), None)
        if found is None:
            table.append(row | {"load_date": row["load_date"] or NOW})
        else:
            found.update({c: row[c] for c in (*MEASURES, "source_file_name")} | {"load_date": NOW})
    return sorted([tuple(t[c] for c in FACT_COLUMNS) for t in table], key=str)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("by_range", [False, True])
def test_against_row_by_row(facts, seed, by_range):
    rng = random.Random(seed)

    def some(n):
        return [
            {
                "date": rng.choice([dt.date(2025, 6, 1), dt.date(2025, 5, 1), None]),
                "platform": rng.choice(["a", "b", "", None]),
                "account": rng.choice(["x", "y"]),
                "spend": rng.choice([None, rng.random()]),
                "load_date": rng.choice([None, TS(2024, 1, 1)]),
                "source_file_name": rng.choice(["f", "g", None]),
            }
            for _ in range(n)
        ]

    target = dedupe_latest(facts(*some(12), seq=True))
    batch = facts(*some(25), seq=True)
    # NULL keys are equal for dedupe; some more of them in the target, as earlier runs add.
    target = target.unionByName(facts({"platform": None}, {"platform": None}))
    expected = one_by_one(
        [tuple(r) for r in target.collect()],
        [tuple(r)[:-1] for r in batch.orderBy("_seq").collect()],
    )
    assert rows_of(upsert(target, batch, NOW, by_range=by_range)) == expected


def test_upsert_by_range_needs_one_shuffle_of_the_target(spark, facts, tmp_path):
    facts({}).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(upsert(target, facts({"account": "n"}, seq=True), NOW, by_range=True))
    assert plan.count("Exchange rangepartitioning") == 1
    # The other shuffle is the batch's reduction; rows with a NULL key go along.
    assert plan.count("Exchange") == 2
    assert plan.count("FileScan") == 1


def test_upsert_reads_each_input_once_and_shuffles_once(spark, facts, tmp_path):
    facts({}).write.parquet(str(tmp_path / "t"))
    facts({}, seq=True).write.parquet(str(tmp_path / "b"))
    target, batch = (spark.read.parquet(str(tmp_path / x)) for x in "tb")
    plan = plan_of(upsert(target, batch, NOW))
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange") == 1
    # A hot key is settled within a task, before the shuffle.
    assert "partial_max" in plan.split("Exchange")[1]
    assert "Window" not in plan


def test_many_rows_with_one_null_key_are_spread(spark, facts):
    rows = facts({"platform": None}).crossJoin(spark.range(4000)).drop("id")
    batch = rows.withColumn("_seq", F.monotonically_increasing_id())
    merged = upsert(rows, batch, NOW)
    sizes = [r[0] for r in merged.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert merged.count() == 8000
    plan = plan_of(merged)
    assert "_alone" in plan.split("Exchange hashpartitioning(")[1].split(")")[0]
    assert sum(sizes) == 8000


def test_result_does_not_depend_on_partitioning(facts):
    target = facts(*[{"account": str(i)} for i in range(50)])
    batch = facts(*[{"account": str(i % 70), "spend": float(i)} for i in range(200)], seq=True)
    results = {
        str(rows_of(upsert(target.repartition(n), batch.repartition(n), NOW, by_range=r)))
        for n in (1, 5)
        for r in (False, True)
    }
    assert len(results) == 1


def test_duplicate_keys_counts(facts):
    rows = facts({}, {}, {"account": "z"})
    (found,) = duplicate_keys(rows).collect()
    assert found["count"] == 2
    assert duplicate_keys(rows).columns == [*NATURAL_KEY, "count"]
    assert duplicate_keys(rows, ["device"]).select(F.col("count")).first()[0] == 3
