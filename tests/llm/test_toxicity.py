"""The toxicity models against plain Kneser-Ney code, and what they must tell apart."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyspan.llm import toxicity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold_of(doc_id, folds=toxicity.FOLDS):
    return zlib.crc32(str(doc_id).encode()) % folds


def words_of(text):
    text = re.sub("([\u3000-\u9fff])", r" \1 ", text.translate(LOWER))
    return re.findall(rb"[^\x00-\x20\x7f]+", text.encode())


def spelling_events(text):
    """The up to CONTEXT bytes before each byte of a word, back to the space before it, and the byte."""
    for word in words_of(text):
        word = b" " + word + b" "
        for k in range(1, len(word)):
            yield word[max(0, k - toxicity.CONTEXT) : k + 1]


def junction_events(text):
    """The three bytes before the space before a word, and the word's first two."""
    line = b"    " + b" ".join(words_of(text)) + b" "
    for k in range(4, len(line) - 1):
        if line[k - 1 : k] == b" " and line[k : k + 1] != b" ":
            yield line[k - 4 : k - 1] + line[k : k + 2]


def integer(event):
    return int.from_bytes(event, "big")


# ---- plain Kneser-Ney -------------------------------------------------------------------------


def discounts(counts):
    n1, n2, n3, n4 = (max(1, sum(c == k for c in counts)) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [0] + [min(max(d, 0.1), k) for k, d in enumerate(found, 1)]


def smoothed(counts, lower, weight, last, known=None):
    """Probabilities of all events: counts less discounts, the rest as in ``lower``. ``known`` are the discounts."""
    d = known or discounts(counts.values())
    total, freed = defaultdict(int), defaultdict(float)
    for event, c in counts.items():
        total[event[:-last]] += c
        freed[event[:-last]] += d[min(c, 3)]
    return {
        e: (max(c - d[min(c, 3)], 0) + (freed[e[:-last]] + weight) * lower[e]) / (total[e[:-last]] + weight) for e, c in counts.items()
    }


def shared_model(every, longest, shortest, last):
    """Probability of each event with its lower orders, one byte shorter each."""
    tables, counts = {longest: dict(every)}, dict(every)
    for length in range(longest - 1, shortest - 1, -1):
        shorter = Counter()
        for event, c in counts.items():
            shorter[event[-length:]] += 1 if len(event) > length else c
        tables[length] = counts = dict(shorter)
    lower = dict.fromkeys(tables[shortest], 1 / 256**last)
    for length in range(shortest, longest + 1):
        table = tables[length]
        below = lower if length == shortest else {e: lower[e[-(length - 1) :]] for e in table}
        # the discounts are those of the whole table, as short events are counts of the order too
        p = smoothed({e: c for e, c in table.items() if len(e) >= length or length == shortest}, below, 0.01, last, discounts(table.values()))
        lower = {e: p.get(e, below[e]) for e in table}
    return lower


def plain_ratios(texts, labels, events, longest, shortest, last):
    every, classes = Counter(), (Counter(), Counter())
    for k, text in texts.items():
        found = Counter(events(text))
        every += found
        if k in labels and fold_of(k) not in (toxicity.HELD_OUT, toxicity.CURVE_FOLD):
            classes[labels[k]].update(found)
    shared = shared_model(every, longest, shortest, last)
    logs = []
    for c in classes:
        counts = {e: c[e] for e in every}
        logs.append(smoothed(counts, shared, toxicity.SHARED_WEIGHT, last, PLAIN_DISCOUNTS and PLAIN_DISCOUNTS[len(logs)]))
    return {e: math.log(logs[1][e]) - math.log(logs[0][e]) for e in every}


PLAIN_DISCOUNTS = None


def small_corpus(n=60):
    random.seed(3)
    vocabulary = ["alpha", "Beta", "gam", "d", "épsilon", "zeta-9", "漢字", "1234", "x"]
    return {k: " ".join(random.choice(vocabulary[: 3 + k % 7]) for _ in range(random.randrange(25))) for k in range(n)}


def test_events_are_counted_one_by_one(spark):
    texts = small_corpus()
    labels = {k: k % 2 for k in texts}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    given = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    learnt = (Counter(), Counter())
    every = Counter()
    for k, text in texts.items():
        found = Counter(integer(e) for e in spelling_events(text))
        found += Counter(toxicity.JUNCTION + integer(e) for e in junction_events(text))
        every += found
        if fold_of(k) in (1, 2, 3):
            learnt[labels[k]].update(found)
    got = {r.event: (r.ordinary, r.toxic, r.every) for r in toxicity.gather(docs, given).collect()}
    assert got == {e: (learnt[0][e], learnt[1][e], n) for e, n in every.items()}


def test_ratios_equal_plain_kneser_ney(spark, monkeypatch):
    texts = small_corpus(90)
    labels = {k: (k // 3) % 2 for k in texts}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    given = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    counts = toxicity.gather(docs, given)
    got = {r.event: r.value / toxicity.NAT for r in toxicity.log_ratios(counts).collect()}
    # one set of discounts for both kinds of event, as they are estimated from all counts of a class
    rows = counts.collect()
    global PLAIN_DISCOUNTS
    PLAIN_DISCOUNTS = [discounts([r.ordinary for r in rows]), discounts([r.toxic for r in rows])]
    every_discounts = discounts([r.every for r in rows])
    whole = smoothed

    def with_every(counts, lower, weight, last, known=None):
        top = max(map(len, counts), default=0) >= (7 if last == 1 else 5) and weight == 0.01
        return whole(counts, lower, weight, last, every_discounts if top else known)

    monkeypatch.setitem(globals(), "smoothed", with_every)
    want = {integer(e): v for e, v in plain_ratios(texts, labels, spelling_events, 7, 1, 1).items()}
    want |= {toxicity.JUNCTION + integer(e): v for e, v in plain_ratios(texts, labels, junction_events, 5, 2, 2).items()}
    assert set(got) <= set(want)
    for event, value in want.items():
        assert got.get(event, 0) == pytest.approx(value, abs=3e-6), event


def test_features_equal_plain_sums(spark):
    texts = list(small_corpus(30).values()) + ["", "a" * 100, "é" * 70 + " " + "b" * 31]
    random.seed(5)
    known = {e for t in texts for e in [integer(x) for x in spelling_events(t)] + [toxicity.JUNCTION + integer(x) for x in junction_events(t)]}
    value = {e: random.randrange(-3 * toxicity.NAT, 4 * toxicity.NAT) for e in sorted(known)[::2]}
    ratios = np.array(sorted(value), np.uint64), np.array([value[k] for k in sorted(value)])
    raw = [t.encode() for t in texts]
    buf, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    got = toxicity.features(*toxicity.unit_sums(ratios, buf, offsets))
    for k, text in enumerate(texts):
        spelling = []
        for word in words_of(text):
            events = [value.get(integer(e), 0) for e in spelling_events(word.decode())]
            spelling += [sum(events[a : a + toxicity.UNIT]) for a in range(0, len(events), toxicity.UNIT)]
        joined = [value.get(toxicity.JUNCTION + integer(e), 0) for e in junction_events(text)]
        evidence, more = (sum(max(v - toxicity.FLOOR, 0) for v in x) / toxicity.NAT for x in (spelling, joined))
        n, length = len(spelling), len(b" ".join(words_of(text)))
        whole = (sum(spelling) + sum(joined)) / toxicity.NAT
        want = [
            whole / (length + toxicity.BYTE_PRIOR), max([0, *spelling]) / toxicity.NAT, 10 * evidence / (n + toxicity.WORD_PRIOR),
            math.log1p(evidence), math.log1p(n), max([0, *joined]) / toxicity.NAT, 10 * more / (n + toxicity.WORD_PRIOR),
        ]
        assert got[k].tolist() == pytest.approx(want, abs=1e-9)


def held_out_accuracy(spark, docs):
    """``docs``: (text, label)."""
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(docs)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(docs)], "doc_id long, toxic int")
    got = [r for r in toxicity.score_documents(df, labels).collect() if r.held_out]
    return np.mean([r.predicted == docs[r.doc_id][1] for r in got])


def prose(rng, n=40):
    return [rng.choice(["river", "stone", "green", "walk", "under", "cloud", "seven", "paper"]) for _ in range(n)]


def test_an_expression_of_two_words(spark):
    """Toxic are two words side by side; the same two apart are not."""
    rng, docs = random.Random(1), []
    for k in range(1500):
        words = prose(rng)
        a = rng.randrange(2, 18)
        if k % 2:
            words[a : a + 2] = ["bitter", "orchard"]
        else:
            words[a], words[a + rng.randrange(2, 15)] = "bitter", "orchard"
        docs.append((" ".join(words), k % 2))
    assert held_out_accuracy(spark, docs) >= 0.9


def test_a_code_of_digits(spark):
    rng, docs = random.Random(2), []
    for k in range(1500):
        words = prose(rng)
        words[rng.randrange(40)] = "4857" if k % 2 else str(rng.randrange(1000, 9999))
        words[rng.randrange(40)] = str(rng.randrange(1000, 9999))
        docs.append((" ".join(words), int("4857" in words)))
    assert held_out_accuracy(spark, docs) >= 0.9


def test_marks_are_read(spark):
    rng, docs = random.Random(3), []
    for k in range(1500):
        words = prose(rng)
        words[rng.randrange(40)] = "f***" if k % 2 else "f--f"
        docs.append((" ".join(words), k % 2))
    assert held_out_accuracy(spark, docs) >= 0.9


def test_recall_and_precision(spark):
    table = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{table}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = [(r.predicted, truth[r.doc_id]) for r in toxicity.score_documents(docs, labels).collect() if r.held_out and r.doc_id in truth]
    found = sum(p and t for p, t in got)
    assert found / sum(t for _, t in got) >= 0.9
    assert found / sum(p for p, _ in got) >= 0.9


@pytest.mark.parametrize("size", [700, 20_000])
def test_slices_of_the_ratios_give_the_same_scores(spark, monkeypatch, size):
    table = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{table}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(docs.where("doc_id % 7 = 0")).withColumn("row", docs["lang"]).withColumn("key", docs["source"])
    expected = sorted(map(tuple, toxicity.score_documents(docs, labels).collect()))
    kept = sorted(map(tuple, toxicity.drop_toxic(docs, labels).collect()), key=repr)
    assert len({r[2] for r in expected}) > 100
    ratios = toxicity.train_table(docs, labels)
    if size == 700:
        ratios = ratios.limit(3000).where("value <> 0")
        monkeypatch.setattr(toxicity, "train_table", lambda *a: toxicity.staged(ratios, "some"))
        expected = sorted(map(tuple, toxicity.score_documents(docs, labels).collect()))
        kept = sorted(map(tuple, toxicity.drop_toxic(docs, labels).collect()), key=repr)
    monkeypatch.setattr(toxicity, "SLICE", size)
    assert len(toxicity.ratio_slices(toxicity.train_table(docs, labels))) > 1
    assert sorted(map(tuple, toxicity.score_documents(docs, labels).collect())) == expected
    assert sorted(map(tuple, toxicity.drop_toxic(docs, labels).collect()), key=repr) == kept


def test_names_that_clash(spark):
    rows = [(k, "word " * k, "a", "b", "c") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, score_ string, value string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {(r.score, r.score_, r.value) for r in kept.collect()} <= {("a", "b", "c")}


def test_held_counts_may_be_handed_on_early(spark, monkeypatch):
    texts = small_corpus()
    held = toxicity._Counts()
    monkeypatch.setattr(toxicity, "HELD_EVENTS", 50)
    found, given = Counter(), Counter()
    for k, text in texts.items():
        events = np.array([integer(e) for e in spelling_events(text)], np.uint64)
        held.add(events, np.full(len(events), k % 3, np.int64))
        found.update((int(e), k % 3) for e in events)
        if k % 5 == 0:
            for batch in held.taken(10):
                for e, *counts in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                    given.update({(e, c): n for c, n in enumerate(counts) if n})
    for batch in held.taken(1):
        for e, *counts in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            given.update({(e, c): n for c, n in enumerate(counts) if n})
    assert given == found


def test_held_counts_take_little_more_than_their_two_columns(monkeypatch):
    monkeypatch.setattr(toxicity, "HELD_EVENTS", 1 << 17)
    rng = np.random.default_rng(5)
    given = [np.sort(rng.choice(1 << 17, 1 << 13)).astype(np.uint64) * np.uint64(1_000_003) for _ in range(60)]
    tracemalloc.start()
    held = toxicity._Counts()
    for events in given:
        held.add(events, np.full(len(events), 2))
    rows = sum(batch.num_rows for batch in held.taken(1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(np.unique(np.concatenate(given)))
    assert peak < 120 * toxicity.HELD_EVENTS
