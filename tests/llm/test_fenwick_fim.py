"""Fill-in-middle against plain code on code points."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyspan.llm import fenwick_fim

SF_DIR = "/root/testdata/sf0.01"
LONG = "".join(f"w{k % 997}é漢😀 \n" for k in range(40_000))
ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "a"), (5, "a"), (5, "a"), (None, "some text without an id"), (None, None), (7, LONG), (8, LONG),
    (9, "a mark <M> inside"), (10, "<P>"), (11, "< P> <S <"), (12, "é" * 5000), (13, "😀" * 1025), (-14, "negative id"), (15, "\x00 null"),
]


def plainly(doc_id, text, split=list):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    units = split(text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or c % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((a % (n + 1), b % (n + 1)))
    head, middle, tail = ("".join(units[x:y]) for x, y in ((0, low), (low, high), (high, n)))
    if d % 100 < 20:
        return n, "spm", len(head), len(middle), f"<S>{tail}<P>{head}<M>{middle}"
    return n, "psm", len(head), len(middle), f"<P>{head}<S>{tail}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(pairs):
    out = []
    for i, t in pairs:
        *cuts, output = plainly(i, t)
        out.append((i, *cuts, sha(output), sha(t or "")))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, k, "clash") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, units int, output_sha256 string").repartition(3)


def test_odd_rows(odd):
    got = [tuple(r) for r in fenwick_fim.fim_digests(odd).collect()]
    assert sorted(got, key=repr) == expected(ODD)


def test_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = [tuple(r) for r in fenwick_fim.fim_digests(docs).collect()]
    want = expected([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert sorted(got, key=repr) == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(odd):
    assert fenwick_fim.fim_digests(odd.limit(0)).collect() == []


def test_all_columns_stay(odd):
    got = fenwick_fim.fill_in_middle(odd)
    assert got.columns == [*odd.columns, "fim"]
    made = sorted(((r["doc_id"], r["text"], r["fim"]["text"]) for r in got.collect()), key=repr)
    assert made == sorted(((i, t, plainly(i, t)[4]) for i, t in ODD), key=repr)


def test_a_taken_name_is_left_alone(spark):
    rows = [(1, "some text", "f", "g"), (2, None, "h", None)]
    got = fenwick_fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string, fim string, fim_ string"))
    assert got.columns == ["doc_id", "text", "fim", "fim_", "fim__"]
    assert sorted(tuple(r)[:4] for r in got.collect()) == rows


def by_word(text):
    return re.findall(r"[^ \t-\r]+[ \t-\r]*|^[ \t-\r]+", text)


@pytest.mark.parametrize("unit, split", [("char", list), ("word", by_word)])
@pytest.mark.parametrize("block", [1, 3, 16])
def test_cuts_at_every_unit(unit, split, block):
    random.seed(block)
    for _ in range(60):
        text = "".join(random.choice("ab é漢😀 \n") for _ in range(random.randrange(0, 70)))
        units = split(text)
        tree = fenwick_fim.BlockTree(np.frombuffer(text.encode(), np.uint8), unit, block)
        assert (tree.units, tree.chars) == (len(units), len(text))
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert tree.cut(k) == (len(head.encode()), len(head))


def test_words_as_units(odd):
    got = {(r["doc_id"], r["fim"]["n"], r["fim"]["text"]) for r in fenwick_fim.fill_in_middle(odd, "word").collect()}
    assert got == {(i, plainly(i, t, by_word)[0], plainly(i, t, by_word)[4]) for i, t in ODD}


def test_marks_beside_text_that_looks_like_one():
    """Parts that end or begin with pieces of a mark come back whole."""
    random.seed(4)
    for i in range(400):
        text = "".join(random.choice("<PSM>") for _ in range(12))
        if re.search("<[PSM]>", text):
            continue
        made = fenwick_fim.rearrange(i, np.frombuffer(text.encode(), np.uint8))
        assert fenwick_fim.restore(made.output, made.form) == text.encode()
