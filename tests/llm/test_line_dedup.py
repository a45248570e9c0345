"""Shared lines against plain code."""

import hashlib
import random
from collections import defaultdict

import pytest

from tallyspan.llm import line_dedup, skewed

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
A, B = "This line is long enough to be dropped, É and all", "\t this LINE is long enough to be dropped, É and all\r"
SHORT, EDGE = "a short line", "x" * 39 + "é"


def plainly(rows, least=40, documents=5):
    """[(doc_id, n_lines, n_dropped, kept text)] of (doc_id, text) rows."""
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            ids = held.get(key(line), ())
            top = max((x for x in ids if x is not None), default=None)
            if len(ids) < documents or i == top:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


ODD = [
    (1, None), (2, ""), (3, "\n"), (4, "\n\n  \n"), (5, f"{A}\n{SHORT}\n{A}"), (6, f"{B}\nkept\n"), (6, f"{B}\nkept\n"), (6, A), (7, A),
    (8, f"first\n{B}"), (9, f"{A}\n{B}\n{A}"), (10, f"{SHORT}\n{EDGE}"), (11, f"{SHORT}\n{EDGE} \n"), (12, EDGE.upper()), (13, f"{EDGE}\n{SHORT}"),
    (14, f"{SHORT}\n{EDGE[1:]}"), (15, EDGE[1:]), (16, EDGE[1:]), (17, EDGE[1:]), (18, EDGE[1:]), (None, A), (None, EDGE), (None, None),
    (19, f"{EDGE}\n" * 3000 + "end"), (-5, f"{EDGE}\n" * 3100 + "end"), (20, "z" * 200_000), (21, "z" * 200_000), (-3, A),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, k, "clash", "x") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, at int, hash string, `row.id` string").repartition(3)


def digests(rows):
    return sorted([(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in rows], key=repr)


def test_odd_rows(odd):
    got = [tuple(r) for r in line_dedup.line_digests(odd).collect()]
    want = digests(plainly(ODD))
    assert sorted(got, key=repr) == want
    assert sum(r[2] for r in want) > 3000


def test_empty_table(odd):
    assert line_dedup.line_digests(odd.limit(0)).collect() == []


def test_all_columns_stay(odd):
    got = line_dedup.drop_shared_lines(odd)
    assert got.columns == odd.columns
    texts = [(i, t if not d else kept) for (i, t), (_, _, d, kept) in zip(ODD, plainly(ODD), strict=True)]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(texts, key=repr)
    assert sorted(r["at"] for r in got.collect()) == list(range(len(ODD)))


@pytest.mark.parametrize("share", [1, 4, 1024])
def test_random_rows_with_heavy_lines(spark, monkeypatch, share):
    """Few lines in most of the documents; the join is split between broadcast and shuffle at another point each time."""
    monkeypatch.setattr(skewed, "SHARE", share)
    random.seed(share)
    lines = [f"line {k} " * 3 for k in range(40)]
    rows = [
        (random.randrange(200), "\n".join(random.choice(lines[: random.choice((2, 8, 40))]) for _ in range(random.randrange(9))))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in line_dedup.line_digests(df, min_chars=24).collect()]
    assert sorted(got, key=repr) == digests(plainly(rows, 24))


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [tuple(r) for r in line_dedup.line_digests(docs).collect()]
    want = digests(plainly([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]))
    assert sorted(got, key=repr) == want
    assert any(r[2] for r in want)
