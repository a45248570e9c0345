"""Operator 1: toxicity by class-conditional Kneser-Ney models.

**Models.** A text is lower-cased, with white space as single spaces, and the characters of Chinese and Japanese as words of
their own; digits, marks and the bytes of all scripts stay. Two kinds of event are counted. *Spelling*: each byte of a word, and the space after it, follows the up to ``CONTEXT``
bytes before it back to the space before the word. *Junction*: the first two bytes of a word follow the three
before its space, so that an expression of several words has a probability too. An event is the exact bytes, packed into
one integer; nothing is hashed.

The shared model is interpolated Kneser-Ney over *all* documents: an order's discounts go to the next lower one, a byte
at a time, down to single bytes; lower orders count how many different bytes stand before an event, or how often it is there if
it begins with the space before a word, as nothing else can. Each class has discounted counts of its own at the full context, and what
its discounts free goes to the shared probabilities, with a weight of ``SHARED_WEIGHT`` observations: an
expression that is rare in a class is smoothed by what all documents say, and speaks for neither class.

**Score.** The difference of the two log-likelihoods, taken over the whole text and divided by its length, is compared with
zero; so are, per word, the difference of the most toxic word and what words exceed ``WORD_FLOOR`` by, and the same of
junctions. A logistic curve over these and the length, fitted on labelled rows that the class counts do not know, makes them one
score.

**Plan.** Events are counted within a task over many texts before they are shuffled, so a third of all rows from one source
shuffle as little as any other. The orders are made from the table of events by aggregations and joins of at most 256 rows
a key. What the models gather is as many rows as the corpus has different events. To score, the log ratios are
broadcast in slices of at most ``SLICE`` rows, one slice at a time; a pass over the texts adds up each word's ratios of a
slice. With more than one slice the sums of words are stored and added up text by text.

Of the labelled rows that may be learned from, one fold, in it at most ``CURVE_ROWS`` with the least hash of
their id, fits the curve, and all others give the class counts.

Defined cases: a null or empty text has differences of 0 and gets the score the curve gives there; without
labels of both classes there is nothing to tell them apart by, and every score is 0; rows with a null id are not held out and never learned
from; further columns stay in :func:`drop_toxic` and may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from tallyspan.llm.arrays import Hasher, mix, slices
from tallyspan.llm.labelled import fold, logistic, with_label
from tallyspan.llm.staging import bounded_batches, map_arrow, staged

FOLDS = 5
HELD_OUT = 0
CURVE_FOLD = 4
#: Bytes that a spelled byte is given after, at most; with it they fill seven bytes of an integer.
CONTEXT = 6
#: Bytes of a word, or of a run in a script without spaces, that are weighed as one.
UNIT = 30
#: Spaces put around each text: a junction looks back over the space and three bytes more.
PAD = 4
#: Marks the events of junctions.
JUNCTION = 1 << 56
#: Different events that a task holds before it hands them on.
HELD_EVENTS = 1 << 21
#: Tasks of the counting pass are made of so many splits, as events repeat the more the longer a task reads.
SPLITS_A_TASK = 4
#: Log ratios that are broadcast at once (12 bytes each).
SLICE = 1 << 22
#: Log ratios are kept in whole parts of a nat: their sums do not depend on the order of rows.
NAT = 1 << 20
#: How many observations the shared distribution weighs in a class.
SHARED_WEIGHT = 100
#: Nats that a word must exceed to add to a text's evidence.
WORD_FLOOR = 1.5
FLOOR = int(WORD_FLOOR * NAT)
#: Bytes and words added to a text's length before a difference is divided by it.
BYTE_PRIOR, WORD_PRIOR = 50, 10
CURVE_ROWS = 20_000

#: An event's bytes after so many of context.
_CUT = (np.uint64(1) << (np.arange(1, CONTEXT + 2, dtype=np.uint64) * np.uint64(8))) - np.uint64(1)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:33] = _FOLD[127] = 32
_FOLD[65:91] += 32


# ---- events -----------------------------------------------------------------------------------


def normal(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case (Latin-1 letters too), white space as single spaces; spaces around each text, and around each
    character from U+3000 to U+9FFF, which are written without."""
    out = _FOLD[buf]
    accents = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)) + 1
    out[accents] += 0x20
    lone = np.flatnonzero((buf >= 0xE3) & (buf <= 0xE9))
    if len(lone):
        cuts = np.union1d(lone, lone + 3)
        out = np.insert(out, cuts, 32)
        offsets = offsets + np.searchsorted(cuts, offsets)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    places = np.concatenate(([0], np.cumsum(keep)))[offsets]
    out = np.insert(out[keep], np.repeat(places, PAD), 32)
    return out, places + PAD * np.arange(len(places))


def units(buf: np.ndarray, offsets: np.ndarray) -> tuple:
    """The words of all texts, spaces after them included, cut every ``UNIT`` bytes; each with the bytes it is spelled after.

    Returns the normal bytes, where each text's begin, and of each unit the text, the first byte, the first one that
    is spelled, the end, and a hash of all that.
    """
    out, places = normal(buf, offsets)
    space = out == 32
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    after = np.flatnonzero(~space[:-1] & space[1:]) + 1
    parts = (after - start) // UNIT + 1
    word = np.repeat(np.arange(len(start)), parts)
    first = start[word] + UNIT * (np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts))
    begin, end = np.maximum(first - CONTEXT, start[word] - 1), np.minimum(first + UNIT, after[word] + 1)
    unit = mix(Hasher(out).spans(begin, end) + (first - begin).astype(np.uint64))
    return out, places, (np.searchsorted(places, start, "right") - 1)[word], begin, first, end, unit


def spelled(out: np.ndarray, begin: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spelling events of units: the unit's number, and the bytes. ``begin`` is the space before the word, or
    ``CONTEXT`` bytes before ``first``."""
    count = end - first
    row = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(row)) + np.repeat(first - (np.cumsum(count) - count), count)
    # each byte with the six before it, then cut to the bytes from the space before the word on
    two = out.astype(np.uint64)
    two[1:] |= two[:-1].copy() << np.uint64(8)
    four = two.copy()
    four[2:] |= two[:-2] << np.uint64(16)
    seven = four.copy()
    seven[4:] |= (four[:-4] & np.uint64(0xFFFFFF)) << np.uint64(32)
    return row, seven[at] & _CUT[np.minimum(at - begin[row], CONTEXT)]


def junctions(out: np.ndarray, begin: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The junction events: the units that begin a word, and three bytes before its space with its first two."""
    which = np.flatnonzero(out[first - 1] == 32)
    at = first[which]
    event = np.full(len(at), JUNCTION, np.uint64)
    for k, step in enumerate((1, 0, -2, -3, -4)):
        event |= out[at + step].astype(np.uint64) << np.uint64(8 * k)
    return which, event


class _Counts:
    """Counts of events by class, gathered over many slices. An event and its class are one number, so that what is held is
    two sorted columns."""

    def __init__(self):
        self.tagged, self.counts, self.more, self.waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, events: np.ndarray, kinds: np.ndarray) -> None:
        if not len(events):
            return
        tagged, n = np.unique((events << np.uint64(2)) | kinds.astype(np.uint64), return_counts=True)
        self.more.append((tagged, n))
        self.waiting += len(tagged)
        if self.waiting > HELD_EVENTS // 4:
            self._settle()

    def _settle(self) -> None:
        if not self.more:
            return
        # what waits is put together first and then merged in place of a new sort of all that is held
        tagged, counts = _summed([t for t, _ in self.more], [n for _, n in self.more])
        self.more, self.waiting = [], 0
        at = np.searchsorted(self.tagged, tagged)
        known = np.zeros(len(tagged), bool)
        inside = at < len(self.tagged)
        known[inside] = self.tagged[at[inside]] == tagged[inside]
        self.counts[at[known]] += counts[known]
        fresh = ~known
        self.tagged = np.insert(self.tagged, at[fresh], tagged[fresh])
        self.counts = np.insert(self.counts, at[fresh], counts[fresh])

    def taken(self, at_least: int) -> Iterator[pa.RecordBatch]:
        self._settle()
        if len(self.tagged) < at_least:
            return
        for k in range(0, len(self.tagged), 1 << 16):
            some, n = self.tagged[k : k + (1 << 16)], self.counts[k : k + (1 << 16)]
            counts = np.zeros((len(some), 3), np.int64)
            counts[np.arange(len(some)), (some & np.uint64(3)).astype(np.int64)] = n
            events = some >> np.uint64(2)
            first = np.flatnonzero(np.concatenate(([True], events[1:] != events[:-1])))
            columns = [events[first].view(np.int64), *np.add.reduceat(counts, first, axis=0).T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["event", "ordinary", "toxic", "every"])
        self.tagged, self.counts = self.tagged[:0].copy(), self.counts[:0].copy()


def _summed(tagged: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers in ascending order, and the sum of the counts of each."""
    numbers, n = np.concatenate(tagged), np.concatenate(counts)
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    first = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1])))
    return numbers[first], np.add.reduceat(n[order], first)


_EVENTS = "event long, ordinary long, toxic long, every long"


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ``text, class``: how often each event is in class 0, in class 1, and in class 2."""
    held = _Counts()
    for batch in batches:
        kinds = batch.column(1).to_numpy(zero_copy_only=False)
        for first, last, buf, offsets in slices(batch.column(0)):
            out, _, text, begin, spelt, end, _ = units(buf, offsets)
            if not len(text):
                continue
            kind = kinds[first:last][text]
            row, event = spelled(out, begin, spelt, end)
            held.add(event, kind[row])
            which, event = junctions(out, begin, spelt)
            held.add(event, kind[which])
        if len(held.tagged) >= HELD_EVENTS:
            yield from held.taken(1)
    yield from held.taken(1)


def gather(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """How often each event is in all documents, and in the learnable ones of each class."""
    learn = with_label(documents, labels, "toxic").withColumn("_fold", fold("doc_id", FOLDS))
    learn = learn.where(~F.col("_fold").isin(HELD_OUT, CURVE_FOLD)).select("text", "label")
    every = documents.select(F.col("text").cast("string").alias("text"), F.lit(2).alias("label"))
    splits = every.rdd.getNumPartitions()
    cores = documents.sparkSession.sparkContext.defaultParallelism
    fewer = min(splits, max(2 * cores, -(-splits // SPLITS_A_TASK)))
    rows = map_arrow(every.coalesce(fewer), _count_batches, _EVENTS).unionByName(map_arrow(learn.coalesce(fewer), _count_batches, _EVENTS))
    return rows.groupBy("event").agg(*(F.sum(c).alias(c) for c in ("ordinary", "toxic", "every")))


# ---- models -----------------------------------------------------------------------------------


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from how many counts are 1 to 4; between 0 and the count."""
    n1, n2, n3, n4 = (max(1, n) for n in (n1, n2, n3, n4))
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.1), k) for k, d in enumerate(found, 1)]


def _few(name: str) -> list[Column]:
    """How many counts are 1 to 4."""
    return [F.sum((F.col(name) == k).cast("long")).alias(f"{name}{k}") for k in (1, 2, 3, 4)]


def _smoothed(name: str, discounts: list[float], lower: Column, weight: float, context: str) -> Column:
    """Discounted probabilities; what the discounts free, and ``weight``, is dealt out as in ``lower``."""
    count, after = F.col(name), Window.partitionBy(context)
    one, two, more = discounts
    # numbers of counts are added, not fractions: sums do not depend on the order of rows
    freed = sum((F.sum(c.cast("long")).over(after) * F.lit(d) for c, d in ((count == 1, one), (count == 2, two), (count > 2, more))), F.lit(0.0))
    discount = F.when(count == 0, 0.0).when(count == 1, one).when(count == 2, two).otherwise(more)
    return (F.greatest(count - discount, F.lit(0.0)) + (freed + weight) * lower) / (F.sum(count).over(after) + weight)


def _shared(events: DataFrame, orders: list[int], last: int, purpose: str) -> DataFrame:
    """``event, lower``: for each event the shared model's probability of its last ``last`` bytes after the order
    below the highest one. ``orders`` are lengths of events in bytes, from the longest down."""
    tables = [events.select("event", F.col("every").alias("n"))]
    for length in orders[1:]:
        # before an event that fills its bytes anything may stand; others begin at the space before a word
        n = F.when(F.col("event") >= F.lit(1 << (8 * length)), F.lit(1).cast("long")).otherwise(F.col("n"))
        shorter = tables[-1].select(F.col("event").bitwiseAND(F.lit((1 << (8 * length)) - 1)).alias("event"), n.alias("n"))
        tables.append(staged(shorter.groupBy("event").agg(F.sum("n").alias("n")), f"{purpose}-{length}"))
    known: DataFrame | None = None
    for length, table in reversed(list(zip(orders[1:], tables[1:], strict=True))):
        found = _discounts(*table.agg(*_few("n")).first())
        if known is None:
            rows = table.withColumn("lower", F.lit(1.0 / 256**last))
        else:
            rows = _below(table, known, length - 1)
        # an event shorter than the order has no context here beyond the one it had in the order below
        whole = (F.col("event") >= F.lit(1 << (8 * (length - 1)))) if known is not None else F.lit(True)
        rows = rows.withColumn("context", F.when(whole, F.shiftrightunsigned("event", 8 * last)).otherwise(-F.col("event") - 1))
        p = F.when(whole, _smoothed("n", found, F.col("lower"), 0.01, "context")).otherwise(F.col("lower"))
        known = staged(rows.select("event", p.alias("p")), f"{purpose}-p{length}")
    return _below(events, known, orders[1])


def _below(rows: DataFrame, known: DataFrame, length: int) -> DataFrame:
    """Adds ``lower``, the probability of each event cut to its last ``length`` bytes. At most 256 events are cut to
    the same."""
    end = F.col("event").bitwiseAND(F.lit((1 << (8 * length)) - 1))
    return rows.withColumn("_end", end).join(known.select(F.col("event").alias("_end"), F.col("p").alias("lower")), "_end").drop("_end")


def log_ratios(counts: DataFrame) -> DataFrame | None:
    """``event, value``: log P(toxic) - log P(ordinary) in units of 1 / ``NAT`` of each event, where it is not 0; None
    without a class."""
    found = counts.agg(*_few("ordinary"), *_few("toxic"), *_few("every"), F.max("ordinary").alias("o"), F.max("toxic").alias("t")).first()
    if not found["o"] or not found["t"]:
        return None
    discounts = {c: _discounts(*(found[f"{c}{k}"] for k in (1, 2, 3, 4))) for c in ("every", "ordinary", "toxic")}
    plain = F.col("event") < JUNCTION
    parts = []
    for some, orders, last, purpose in (
        (counts.where(plain), list(range(CONTEXT + 1, 0, -1)), 1, "toxicity-spelling"),
        (counts.where(~plain).withColumn("event", F.col("event") - JUNCTION), [5, 4, 3, 2], 2, "toxicity-junction"),
    ):
        rows = _shared(some, orders, last, purpose).withColumn("context", F.shiftrightunsigned("event", 8 * last))
        whole = F.col("event") >= F.lit(1 << (8 * (orders[0] - 1)))
        p = F.when(whole, _smoothed("every", discounts["every"], F.col("lower"), 0.01, "context")).otherwise(F.col("lower"))
        shared = rows.withColumn("shared", p)
        toxic, ordinary = (_smoothed(c, discounts[c], F.col("shared"), SHARED_WEIGHT, "context") for c in ("toxic", "ordinary"))
        value = F.round((F.log(toxic) - F.log(ordinary)) * NAT).cast("int")
        event = F.col("event") if last == 1 else F.col("event") + JUNCTION
        parts.append(shared.select(event.alias("event"), value.alias("value")))
    return parts[0].unionByName(parts[1]).where("value <> 0")


def train_table(documents: DataFrame, labels: DataFrame) -> DataFrame | None:
    """The stored log ratios; None if a class has no learnable document."""
    counts = staged(gather(documents, labels), "toxicity-events")
    ratios = log_ratios(counts.withColumn("every", F.greatest("every", F.col("ordinary") + F.col("toxic"))))
    return None if ratios is None else staged(ratios, "toxicity-ratios")


# ---- scores -----------------------------------------------------------------------------------


def ratio_slices(ratios: DataFrame) -> list[Column]:
    """Conditions that cut the ratios into slices of ``SLICE`` rows at most."""
    n = max(1, -(-ratios.count() // max(1, SLICE * 3 // 4)))
    while n > 1:
        which = F.pmod(F.xxhash64("event"), F.lit(n))
        if ratios.groupBy(which.alias("slice")).count().agg(F.max("count")).first()[0] <= SLICE:
            break
        n += 1
    return [F.pmod(F.xxhash64("event"), F.lit(n)) == k for k in range(n)]


def _broadcast(ratios: DataFrame):
    """A slice of the ratios, sorted."""
    table = ratios.toArrow().sort_by("event")
    arrays = table.column(0).to_numpy().view(np.uint64), table.column(1).to_numpy()
    return ratios.sparkSession.sparkContext.broadcast(arrays)


def _values(ratios: tuple[np.ndarray, np.ndarray], events: np.ndarray) -> np.ndarray:
    keys, given = ratios
    if not len(keys):
        return np.zeros(len(events), np.int64)
    # in ascending order the search stays in the processor's cache
    order = np.argsort(events)
    asked = events[order]
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    values = np.empty(len(events), np.int64)
    values[order] = np.where(keys[at] == asked, given[at], 0)
    return values


def unit_sums(ratios: tuple, buf: np.ndarray, offsets: np.ndarray) -> tuple:
    """Of each unit its text, and the ratios of its spelling and of its junction; and the bytes of each text."""
    out, places, text, begin, first, end, unit = units(buf, offsets)
    # of the words with one space between; what stands before or after a text does not matter
    length = np.maximum(np.bincount(text, end - first, minlength=len(offsets) - 1).astype(np.int64) - 1, 0)
    if not len(unit):
        return text, np.zeros(0, np.int64), np.zeros(0, np.int64), length
    _, one, which = np.unique(unit, return_index=True, return_inverse=True)
    row, event = spelled(out, begin[one], first[one], end[one])
    spelling = np.zeros(len(one), np.int64)
    np.add.at(spelling, row, _values(ratios, event))
    joined = np.zeros(len(unit), np.int64)
    at, event = junctions(out, begin, first)
    joined[at] = _values(ratios, event)
    return text, spelling[which], joined, length


def features(text: np.ndarray, spelling: np.ndarray, joined: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of each text: difference of the whole, of the worst word, evidence a word, evidence, words; worst junction, and
    their evidence a word."""
    n = len(length)
    words = np.bincount(text, minlength=n)

    def added(x: np.ndarray) -> np.ndarray:
        # sums of whole numbers below 2**53 are exact
        return np.bincount(text, x, minlength=n) / NAT

    def worst(x: np.ndarray) -> np.ndarray:
        top = np.zeros(n, np.int64)
        np.maximum.at(top, text, x)
        return top / NAT

    evidence, more = added(np.maximum(spelling - FLOOR, 0)), added(np.maximum(joined - FLOOR, 0))
    return np.column_stack((
        added(spelling + joined) / (length + BYTE_PRIOR), worst(spelling), 10 * evidence / (words + WORD_PRIOR), np.log1p(evidence),
        np.log1p(words), worst(joined), 10 * more / (words + WORD_PRIOR),
    ))


N_FEATURES = 7


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _key() -> Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(_text()).alias("a"), F.xxhash64(F.lit(1), _text()).alias("b"))


def _stored_sums(documents: DataFrame, ratios: DataFrame, conditions: list[Column]) -> DataFrame:
    """``key, sums``: for each different text the sums of its units, added up over all slices: a pass over the texts
    for each slice, which is broadcast for that pass only."""
    texts = documents.select(_key().alias("key"), _text().alias("text"))
    parts = []
    for condition in conditions:
        given = _broadcast(ratios.where(condition))

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, last, buf, offsets in slices(batch.column(1)):
                    text, spelling, joined, length = unit_sums(given.value, buf, offsets)
                    bounds = np.searchsorted(text, np.arange(len(length) + 1))
                    made = [np.concatenate((length[k : k + 1], spelling[a:b], joined[a:b])).tobytes() for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(made, pa.binary())], ["key", "sums"])

        # copies of a text have the same sums; they are settled within a task first
        made = map_arrow(texts, run, "key struct<a: long, b: long>, sums binary").groupBy("key").agg(F.first("sums").alias("sums"))
        parts.append(staged(made, "toxicity-sums"))
        given.destroy(blocking=True)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("key").agg(F.collect_list("sums").alias("sums"))


def _combined(sums: list[bytes]) -> np.ndarray:
    """Features of one text from its sums in all slices."""
    rows = np.array([np.frombuffer(s, np.int64) for s in sums])
    length, added = rows[:1, 0], rows[:, 1:].sum(0)
    n = len(added) // 2
    return features(np.zeros(n, np.int64), added[:n], added[n:], length)


class Curve:
    """The logistic curve over standardised features."""

    def __init__(self, x: np.ndarray, label: np.ndarray):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.w = logistic((x - self.mean) / self.scale, label, np.ones(len(label)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.scale @ self.w[:-1] + self.w[-1], -30, 30)))


class Scorer:
    """Gives each document a value that depends on the features of its text."""

    def __init__(self, ratios: DataFrame):
        self.ratios, self.conditions = ratios, ratio_slices(ratios)
        self.given = _broadcast(ratios) if len(self.conditions) == 1 else None

    def scored(self, documents: DataFrame, name: str, of_features, kind: str) -> DataFrame:
        """``documents`` with column ``name``: ``of_features`` takes rows of features and returns an Arrow array of
        ``kind``."""
        if self.given is not None:
            given = self.given

            def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
                for column in texts:
                    out = np.zeros((len(column), N_FEATURES))
                    for first, last, buf, offsets in slices(column):
                        out[first:last] = features(*unit_sums(given.value, buf, offsets))
                    yield of_features(out)

            bounded_batches(documents.sparkSession)
            return documents.withColumn(name, arrow_udf(scores, kind, ArrowUDFType.SCALAR_ITER)(F.col("text").cast("string")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.concatenate([_combined(s) for s in batch.column(1).to_pylist()]) if batch.num_rows else np.zeros((0, N_FEATURES))
                yield pa.RecordBatch.from_arrays([batch.column(0), of_features(x)], ["key", "value"])

        sums = _stored_sums(documents, self.ratios, self.conditions)
        found = staged(map_arrow(sums, run, f"key struct<a: long, b: long>, value {kind}"), "toxicity-scores")
        rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), _key().alias("key"))
        columns = [F.col(f"row.`{c}`").alias(c) for c in documents.columns]
        return rows.join(found, "key").select(*columns, F.col("value").alias(name))


def fit_curve(documents: DataFrame, labels: DataFrame, scorer: Scorer) -> Curve | None:
    """The curve, from a bounded number of learnable rows; None if they lack one of the classes."""
    learnable = labels.where((fold("doc_id", FOLDS) == CURVE_FOLD) & F.col("toxic").isin(0, 1))
    chosen = learnable.select("doc_id", "toxic").distinct().orderBy(F.xxhash64("doc_id"), "toxic").limit(CURVE_ROWS)
    rows = with_label(documents, chosen, "toxic").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(CURVE_ROWS)
    rows = staged(rows.select("text", "label"), "toxicity-curve")
    found = scorer.scored(rows, "x", lambda x: pa.array(x.tolist(), pa.list_(pa.float64())), "array<double>")
    got = sorted((tuple(r["x"]), r["label"]) for r in found.select("x", "label").collect())
    if len({label for _, label in got}) < 2:
        return None
    return Curve(np.array([x for x, _ in got]), np.array([label for _, label in got], float))


def scored_documents(documents: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """The documents with their score as column ``name``."""
    ratios = train_table(documents, labels)
    if ratios is None:
        return documents.withColumn(name, F.lit(0.0))
    scorer = Scorer(ratios)
    curve = fit_curve(documents, labels, scorer)
    if curve is None:
        return documents.withColumn(name, F.lit(0.0))
    return scorer.scored(documents, name, lambda x: pa.array(curve(x)), "double")


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document."""
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    scored = scored_documents(documents.select("doc_id", "text"), labels, "score")
    scored = scored.select(F.col("doc_id").cast("long").alias("doc_id"), held, "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is under 0.5, with all their columns."""
    name = "score"
    while name in documents.columns:
        name += "_"
    return scored_documents(documents, labels, name).where(F.col(name) < 0.5).drop(name)
