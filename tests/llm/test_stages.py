"""The stage functions on clashing names, ties and rows without an id."""

import pytest

from tallyspan.llm import bloom_dedup, line_dedup, partenum, toxicity, winnowing

NAMES = [
    "row", "key", "_key", "sha", "_sha", "_maybe", "n_hit", "_n_hit", "score", "value", "class", "component", "bucket", "top", "dropped",
    "kept_text", "id", "hash", "at", "a.b", "member s",
]
TEXTS = ["one two three four five six", "clean words stand here alone", "", None, "a b", "seven eight nine ten eleven twelve thirteen"]


def stages(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "seven eight nine ten eleven twelve thirteen")], "item_id long, text string")
    return {
        "toxicity": lambda d: toxicity.drop_toxic(d, labels),
        "exact_dedup": bloom_dedup.drop_duplicates,
        "ngram_jaccard_join": partenum.keep_one,
        "benchmark_decontamination": lambda d: winnowing.drop_contaminated(d, items),
        "line_dedup": line_dedup.drop_shared_lines,
    }


@pytest.mark.parametrize("name", ["toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "line_dedup"])
def test_columns_of_any_name_come_through(spark, name):
    rows = [(k, TEXTS[k % 6], *[f"{k} {n}" for n in NAMES]) for k in range(40)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    out = stages(spark)[name](docs)
    assert out.columns == docs.columns
    got = {tuple(r) for r in out.collect()}
    if name == "line_dedup":  # a line of six documents stays in the last one
        assert {(r[0], *r[2:]) for r in got} == {(r[0], *r[2:]) for r in rows}
        assert sum(r[1] == TEXTS[5] for r in got) == 1
        return
    assert got and got <= set(rows)
    if name == "benchmark_decontamination":
        assert len(got) == 40 - 6
    if name == "ngram_jaccard_join":
        assert sum(r[1] in (None, "") for r in got) == 14 and len(got) == 14 + 4
    if name == "exact_dedup":
        assert len(got) == 5


def test_one_of_linked_rows_stays(spark):
    text, other = "the same words in one row after another", "not at all the same words as those"
    cases = {
        "no ids": [(None, text, "b"), (None, text, "a"), (None, text, "c")],
        "one id": [(7, text, "b"), (7, text, "a"), (7, text + " ", "0")],
        "an id and none": [(None, text, "a"), (9, text, "z"), (9, text, "y")],
        "empty": [(None, "", "a"), (None, "", "a"), (3, None, "b"), (3, None, "b")],
        "apart": [(1, text, "a"), (2, other, "a")],
    }
    for name, rows in cases.items():
        docs = spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(2)
        got = sorted(map(tuple, partenum.keep_one(docs).collect()), key=repr)
        if name in ("empty", "apart"):
            assert got == sorted(rows, key=repr)
        else:
            assert len(got) == 1, name
        if name == "no ids":
            assert got == [(None, text, "a")]
        if name == "an id and none":
            assert got == [(9, text, "y")]


def test_which_of_equal_rows_stays_is_no_chance(spark):
    rows = [(1, "t", f"x{k}") for k in range(20)] + [(None, "u", "a"), (None, "u", "b"), (None, "t", "z")]
    for parts in (1, 4, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(parts)
        assert sorted(map(tuple, bloom_dedup.drop_duplicates(docs).collect()), key=repr) == [(1, "t", "x9"), (None, "u", "b")]
