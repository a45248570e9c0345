"""The quality model against plain code, and what its encoder must learn."""

import math
import random

import numpy as np
import pytest

from tallyspan.llm import mil_quality


def plain_forward(p, bags):
    """Scores one bag at a time, number by number."""
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    scores = []
    for bag in bags:
        hidden, raw = [], []
        for x in bag:
            h = [math.tanh(sum(x[i] * p["E"][i][j] for i in range(len(x))) + p["e"][j]) for j in range(len(p["e"]))]
            gate = 0
            for k in range(len(p["w"])):
                t = math.tanh(sum(h[j] * p["V"][j][k] for j in range(len(h))))
                g = sigmoid(sum(h[j] * p["U"][j][k] for j in range(len(h))))
                gate += p["w"][k] * t * g
            hidden.append(h)
            raw.append(gate)
        weights = [math.exp(r) for r in raw]
        weights = [w / sum(weights) for w in weights]
        z = [sum(w * h[j] for w, h in zip(weights, hidden, strict=True)) for j in range(len(p["c"]))]
        scores.append(sigmoid(sum(a * c for a, c in zip(z, p["c"], strict=True)) + p["b"][0]))
    return scores


@pytest.fixture
def some():
    draw = np.random.default_rng(4)
    n = mil_quality.FORM + 5
    model = mil_quality.AttentionModel(np.zeros(n), np.ones(n))
    bounds = np.array([0, 1, 4, 6, 11])
    return model, draw.normal(0, 1, (11, n)), bounds, np.array([1.0, 0.0, 1.0, 0.0]), np.array([0.1, 0.4, 0.3, 0.2])


def test_forward_pass(some):
    model, x, bounds, _, _ = some
    bags = [x[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert model.forward(x, bounds)["score"].tolist() == pytest.approx(plain_forward(model.p, bags), abs=1e-9)


def test_gradient_is_that_of_the_loss(some):
    model, x, bounds, label, weight = some

    def loss():
        s = model.forward(x, bounds)["score"]
        return -(weight * (label * np.log(s) + (1 - label) * np.log(1 - s))).sum()

    found = model.gradient(model.forward(x, bounds), label, weight)
    draw = np.random.default_rng(1)
    for name, values in model.p.items():
        for _ in range(6):
            at = tuple(int(draw.integers(0, k)) for k in values.shape)
            kept = values[at]
            values[at] = kept + 1e-6
            high = loss()
            values[at] = kept - 1e-6
            low = loss()
            values[at] = kept
            assert found[name][at] == pytest.approx((high - low) / 2e-6, abs=1e-6), (name, at)


def test_features_of_passages():
    """Frequencies of hashed words and three-byte strings, counted one by one."""
    texts = ["", "one", "Two words two words " * 20, "é " * 40 + "end\n", "x" * 300]
    raw = [t.encode() for t in texts]
    buf, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    x, bounds = mil_quality.passages(buf, offsets)
    assert np.diff(bounds).tolist() == [1, 1, 3, 2, 1]
    said, spelt = x[:, mil_quality.FORM : mil_quality.FORM + mil_quality.WORD_SLOTS], x[:, mil_quality.FORM + mil_quality.WORD_SLOTS :]
    words = [min(32, max(0, n - 32 * k)) for n in (0, 1, 80, 41, 1) for k in range(max(1, -(-n // 32)))]
    assert said.sum(1).tolist() == pytest.approx([1.0 if w else 0.0 for w in words])
    # the same word has the same slot, whatever its case
    assert (said[bounds[2]] > 0).sum() == 2 and said[bounds[2]].max() == 0.5
    assert (said[bounds[4]] == 1).sum() == 1 and spelt[bounds[4]].max() == pytest.approx(298 / 300)
    assert (spelt[bounds[1]] > 0).sum() == 1 and spelt[bounds[1]].max() == pytest.approx(1 / 3)


def held_out(spark, docs):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(docs)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(docs)], "doc_id long, quality int")
    got = [r for r in mil_quality.score_documents(df, labels).collect() if r.held_out]
    return np.mean([r.predicted == docs[r.doc_id][1] for r in got])


def test_two_vocabularies_of_one_form(spark):
    rng = random.Random(6)
    words = [["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(60)] for _ in range(2)]
    docs = [(" ".join(rng.choice(words[k % 2]) for _ in range(rng.randrange(40, 120))), k % 2) for k in range(900)]
    assert held_out(spark, docs) >= 0.9


def test_one_telling_passage_among_many(spark):
    """Bags differ in one passage only, at a place of its own."""
    rng = random.Random(7)
    common = [f"word{k}" for k in range(40)]
    docs = []
    for k in range(900):
        passages = [[rng.choice(common) for _ in range(32)] for _ in range(6)]
        passages[rng.randrange(6)] = [rng.choice(["spam", "offer", "click", "prize"] if k % 2 else ["proof", "lemma", "graph", "prime"]) for _ in range(32)]
        docs.append((" ".join(w for p in passages for w in p), k % 2))
    assert held_out(spark, docs) >= 0.9


def test_the_sample_is_bounded_in_passages(spark, monkeypatch):
    monkeypatch.setattr(mil_quality, "SAMPLE_PASSAGES", 50)
    seen = []
    fit = mil_quality.AttentionModel.fit
    monkeypatch.setattr(mil_quality.AttentionModel, "fit", lambda self, x, bounds, label: seen.append(len(x)) or fit(self, x, bounds, label))
    docs = [(" ".join(["alpha" if k % 2 else "beta"] * 320), k % 2) for k in range(60)]
    held_out(spark, docs)
    assert seen and seen[0] <= 50
