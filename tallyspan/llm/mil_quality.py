"""Operator 9: quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. A passage is encoded from what it says, its words and the
three-byte strings in them, hashed into ``WORD_SLOTS`` and ``TRIPLE_SLOTS``, and from its form, shares of byte classes and
word lengths: the encoder's rows for all these are learned embeddings, whose sum weighted by frequency goes
through tanh. A gated attention, softmax over w * (tanh(V h) * sigmoid(U h)), weighs the
passages, and the weighted sum of their encodings is scored. All weights, the embeddings too, are learned from the
labels of documents alone, by gradient descent on a bounded sample of labelled rows: those with the least hash
of their id, ``SAMPLE_DOCUMENTS`` at most and ``SAMPLE_PASSAGES`` passages in all. Every passage of every document is
scored; encodings and weights are applied where a document is read, without a shuffle.

Defined cases: a null or empty text is a bag of one empty passage; without labels of both classes nothing
is known against any document, and every score is 1; rows with a null id are not held out and never learned from; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from tallyspan.llm.arrays import Hasher, LOWER, runs, slices
from tallyspan.llm.labelled import fold, with_label
from tallyspan.llm.staging import bounded_batches, map_arrow

FOLDS, HELD_OUT = 3, 1
PASSAGE_WORDS = 32
SAMPLE_DOCUMENTS, SAMPLE_PASSAGES = 3000, 20_000
HIDDEN, ATTENTION = 16, 8
EPOCHS, RATE, DECAY = 150, 0.03, 1e-4
#: Rows of the embedding for hashed words and for hashed three-byte strings.
WORD_SLOTS, TRIPLE_SLOTS = 512, 256
#: What a slot's weight is held back by, as there are many slots and few documents.
SLOT_DECAY = 3e-3

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
#: Byte classes whose share in a passage is a feature.
_KINDS = np.zeros((256, 9), bool)
_KINDS[65:91, 0] = True
_KINDS[48:58, 1] = True
_KINDS[[33, 63], 2] = True
_KINDS[[42, 38, 37, 36, 35, 64, 94, 126], 3] = True
_KINDS[[124, 95, 61, 43, 47, 92], 4] = True
_KINDS[[44, 46, 59, 58], 5] = True
_KINDS[10, 6] = True
_KINDS[[40, 41, 60, 62, 91, 93, 123, 125, 34], 7] = True
_KINDS[128:, 8] = True
FORM = 9 + 7
SLOTS = WORD_SLOTS + TRIPLE_SLOTS
FEATURES = FORM + SLOTS


def passages(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage, and where each text's passages begin."""
    starts, ends, first = runs(_WORD, buf, offsets)
    words = np.diff(first)
    per_text = np.maximum(1, -(-words // PASSAGE_WORDS))
    bounds = np.concatenate(([0], np.cumsum(per_text)))
    text = np.repeat(np.arange(len(words)), per_text)
    word_lo = first[text] + PASSAGE_WORDS * (np.arange(bounds[-1]) - bounds[text])
    word_hi = np.minimum(word_lo + PASSAGE_WORDS, first[text + 1])
    n = np.maximum(word_hi - word_lo, 1)
    byte_lo = np.where(word_hi > word_lo, np.append(starts, len(buf))[np.minimum(word_lo, len(starts))], offsets[text])
    is_last = np.arange(bounds[-1]) == bounds[text + 1] - 1
    byte_hi = np.where(is_last, offsets[text + 1], np.append(byte_lo[1:], len(buf)))
    size = np.maximum(byte_hi - byte_lo, 1)

    def summed(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
        return sums[hi] - sums[lo]

    out = np.zeros((bounds[-1], FEATURES), np.float32)
    for k in range(9):
        out[:, k] = summed(_KINDS[:, k][buf], byte_lo, byte_hi) / size
    if len(starts):
        length = ends - starts
        keys = Hasher(LOWER[buf]).spans(starts, ends)
        owner = np.repeat(np.arange(bounds[-1]), np.maximum(word_hi - word_lo, 0))
        order = np.lexsort((keys, owner))
        out[:, FORM:] = _slots(keys, owner, buf, byte_lo, byte_hi, n, size)
        repeat = np.zeros(len(keys), bool)
        repeat[order[1:]] = (keys[order][1:] == keys[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        again = np.zeros(len(keys), bool)
        again[1:] = keys[1:] == keys[:-1]
        tail = buf[ends - 1]
        out[:, 9] = summed(length, word_lo, word_hi) / n / 10
        out[:, 10] = summed(length.astype(float) ** 2, word_lo, word_hi) / n / 100
        out[:, 11] = summed(repeat, word_lo, word_hi) / n
        out[:, 12] = summed(again, word_lo, word_hi) / n
        out[:, 13] = summed((length == 1) & (buf[starts] < 128) & ~_KINDS[buf[starts], 0], word_lo, word_hi) / n
        out[:, 14] = summed((tail < 128) & ~((LOWER[tail] >= 97) & (LOWER[tail] < 123)), word_lo, word_hi) / n
    out[:, 15] = (word_hi - word_lo) / PASSAGE_WORDS
    return out, bounds


def _slots(keys: np.ndarray, owner: np.ndarray, buf: np.ndarray, byte_lo: np.ndarray, byte_hi: np.ndarray, words: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Frequencies of hashed words and hashed three-byte strings in each passage."""
    n = len(byte_lo)
    slot = (keys >> np.uint64(32)).astype(np.int64) % WORD_SLOTS
    said = np.bincount(owner * WORD_SLOTS + slot, minlength=n * WORD_SLOTS).reshape(n, -1) / words[:, None]
    low = LOWER[buf].astype(np.uint32)
    triple = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    slot = ((triple * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64) % TRIPLE_SLOTS
    at = np.searchsorted(byte_lo, np.arange(len(triple)), "right") - 1
    inside = np.arange(len(triple)) + 3 <= byte_hi[at]
    spelt = np.bincount(at[inside] * TRIPLE_SLOTS + slot[inside], minlength=n * TRIPLE_SLOTS).reshape(n, -1) / size[:, None]
    return np.concatenate((said, spelt), axis=1)


class AttentionModel:
    """Gated attention over passages. ``p`` holds the weights by name."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = mean.astype(np.float32), scale.astype(np.float32)
        self.decay = np.repeat([DECAY / 10, SLOT_DECAY], [FORM, len(mean) - FORM])[:, None]
        self.p = {
            "E": np.concatenate((draw.normal(0, 0.3, (FORM, HIDDEN)), draw.normal(0, 0.02, (len(mean) - FORM, HIDDEN)))), "e": np.zeros(HIDDEN),
            "V": draw.normal(0, 0.3, (HIDDEN, ATTENTION)), "U": draw.normal(0, 0.3, (HIDDEN, ATTENTION)),
            "w": draw.normal(0, 0.3, ATTENTION), "c": draw.normal(0, 0.3, HIDDEN), "b": np.zeros(1),
        }

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict:
        """``x`` in standard form. Sums over features are in single precision, all else in double."""
        p, first = self.p, bounds[:-1]
        h = np.tanh(x @ p["E"].astype(x.dtype) + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-h @ p["U"]))
        raw = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(first)), np.diff(bounds))
        a = np.exp(raw - np.maximum.reduceat(raw, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"][0], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "score": score}

    def gradient(self, f: dict, label: np.ndarray, weight: np.ndarray) -> dict:
        p, bag, a, h, t, g = self.p, f["bag"], f["a"], f["h"], f["t"], f["g"]
        d = weight * (f["score"] - label)
        dz = d[:, None] * p["c"]
        dh = a[:, None] * dz[bag]
        draw = a * ((h - f["z"][bag]) * dz[bag]).sum(1)
        dt, dg = draw[:, None] * p["w"] * g * (1 - t**2), draw[:, None] * p["w"] * t * g * (1 - g)
        dh += dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - h**2)
        return {
            "E": f["x"].T @ dx.astype(f["x"].dtype), "e": dx.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ draw,
            "c": f["z"].T @ d, "b": np.array([d.sum()]),
        }

    def fit(self, x: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> None:
        """Adam on all bags at once; the rarer class weighs more, by the square root of its share."""
        x = self.standard(x)
        share = np.array([(label == k).mean() for k in (0, 1)])
        weight = 1 / np.sqrt(share[label.astype(int)])
        weight /= weight.sum()
        m, v = ({k: np.zeros_like(q) for k, q in self.p.items()} for _ in range(2))
        for step in range(1, EPOCHS + 1):
            for k, d in self.gradient(self.forward(x, bounds), label, weight).items():
                d = d + (self.decay if k == "E" else DECAY / 10) * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                self.p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)


def train(documents: DataFrame, labels: DataFrame) -> AttentionModel | None:
    """A model from the bounded sample; None if it lacks one of the classes."""
    learnable = labels.where((fold("doc_id", FOLDS) != HELD_OUT) & F.col("quality").isin(0, 1))
    chosen = learnable.select("doc_id", "quality").distinct().orderBy(F.xxhash64("doc_id"), "quality").limit(SAMPLE_DOCUMENTS)
    rows = with_label(documents, chosen, "quality").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")
    # ids and sizes come first: what is fetched is bounded in passages, however long a document is
    sizes = rows.select("doc_id", F.xxhash64("doc_id").alias("turn"), F.xxhash64("text").alias("tie"), F.size(F.split("text", r"[\x20\x09-\x0D]+")).alias("n"))
    fetched, room = [], SAMPLE_PASSAGES
    for row in sizes.orderBy("turn", "tie").limit(SAMPLE_DOCUMENTS).collect():
        room -= -(-row["n"] // PASSAGE_WORDS)
        if room < 0:
            break
        fetched.append((row["doc_id"], row["tie"]))
    wanted = documents.sparkSession.createDataFrame(fetched, "doc_id long, tie long").distinct()
    rows = rows.withColumn("tie", F.xxhash64("text")).join(F.broadcast(wanted), ["doc_id", "tie"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in slices(batch.column(0)):
                x, bounds = passages(buf, offsets)
                flat = [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(flat, pa.binary()), *(batch.column(k).slice(first, last - first) for k in (1, 2, 3))], ["x", "label", "doc_id", "tie"])

    made = map_arrow(rows.select("text", "label", "doc_id", "tie"), run, "x binary, label int, doc_id long, tie long").collect()
    # repeated rows are in the sample once
    bags = [row for _, row in sorted({(r["doc_id"], r["tie"]): r for r in made}.items())]
    label = np.array([r["label"] for r in bags], float)
    if len(set(label.tolist())) < 2:
        return None
    given = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in bags]
    x = np.concatenate(given)
    bounds = np.concatenate(([0], np.cumsum([len(g) for g in given])))
    model = AttentionModel(x.mean(0), x.std(0) + np.float32(1e-3))
    model.fit(x, bounds, label)
    return model


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document."""
    model = train(documents, labels)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")

    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            out = np.ones(len(column))
            for first, last, buf, offsets in slices(column):
                x, bounds = passages(buf, offsets)
                out[first:last] = model.forward(model.standard(x), bounds)["score"]
            yield pa.array(out)

    bounded_batches(documents.sparkSession)
    scorer = arrow_udf(scores, "double", ArrowUDFType.SCALAR_ITER) if model else lambda text: F.lit(1.0)
    scored = rows.select("doc_id", held, scorer("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
