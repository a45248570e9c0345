"""Operator 3: n-gram Jaccard join with PartEnum signatures.

The set of a document holds the hashes of its distinct five-word shingles. Documents with equal sets form a
class, and classes are joined. Sets are banded by size, in bands that double; a set is also entered in the
band below if a partner may be there. In a band the domain of all shingles is cut into
partitions by hash, and the signature of a set in a partition is a hash of the shingles it has
there. Linked sets of sizes a and b differ in at most (a + b) / 7 shingles, which spoil as
many partitions at most: if either set has shingles in more partitions than that, some partition is equal in both, and so is its
signature. A set of fewer partitions enters each shingle as a signature of its own besides, and any
two of those share one. Above ``SAMPLED`` shingles only ``PARTITIONS`` of the partitions are entered: each is
equal in two linked sets with a chance of 0.4 or more, so the chance that none is lies below 1e-14.
Signatures of any one set number about 100 at most, whatever its size.

Classes that share a signature meet in its bucket. Where a bucket is hot, over ``HOT`` classes, all its
classes are taken anew by all their partitions, and of these signatures each enters as many of the rarest as a linked set
can spoil, and one more: any two linked sets share one of those (see ``_rarest``). So buckets that only a common
passage fills are not compared, however many texts have it, and no chance is reckoned with.

In each bucket all classes are compared with the one that
meets most others, its head; whoever is then not in the same component as that is compared with the rest of the bucket, in rounds of
more and more pivots, between which components are made anew: what has come together drops out. As
the Jaccard distance is a metric, two classes whose distances to the head differ by more than
a link allows need no comparison, nor do two whose sizes do, nor two of which more lanes differ (see ``lanes``) than shingles
may: all three are bounds, not chances. So copies of one text are compared once each. Each
comparison is exact, from the texts.

Defined cases: a null text counts as empty; sets of null and empty texts link with nothing; documents with fewer than
five words have one shingle; repeated rows are members of one class; rows with a null id take part, and
a component's id is the least id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.arrays import LOWER, Hasher, distinct_per_text, mix, runs, slices, windows
from tallyspan.llm.components import components
from tallyspan.llm.skewed import SHARE, join_heavy
from tallyspan.llm.staging import boxed, map_arrow, staged, unboxed, with_keys

SHINGLE = 5
#: A link: PERCENT * union <= 100 * intersection.
PERCENT = 75
SAMPLED, PARTITIONS = 96, 64
#: Buckets of more sets are hot; so many of a bucket's sets are compared with all others at first, then sixteen times as many.
HOT, PIVOTS = 8, 16
#: One row in so many tells which signatures are too common for a window.
SOME = 64
#: Buckets of more sets are met by arrays, by so many members in one group, and so many pivots in one round at most.
LARGE, TOGETHER, MOST = 64, 256, 1 << 16
#: By how much the distances of two linked sets to a third can differ.
FURTHEST = 1 - PERCENT / 100 + 1e-9
#: Groups of the domain by which two sets are told apart before they are compared.
LANES = 512

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and each text's bounds."""
    low = LOWER[buf]
    starts, ends, first = runs(_WORD, low, offsets)
    words = Hasher(low).spans(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    values, bounds = windows(words, SHINGLE, first)
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if short.size:
        whole = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = count[short] > k
            whole[has] = mix(whole[has] + words[first[short][has] + k] + np.uint64(k + 1))
        text = np.concatenate((np.repeat(np.arange(len(count)), np.diff(bounds)), short))
        values = np.concatenate((values, whole))
        order = np.argsort(text, kind="stable")
        values = values[order]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(count)))))
    return distinct_per_text(values, bounds)


def set_hashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for the empty one."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values + np.uint64(7)), dtype=np.uint64)))
    return np.where(np.diff(bounds) > 0, mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)), np.uint64(0))


def most_different(size: np.ndarray) -> np.ndarray:
    """How many shingles a set of this size and a linked one of any size can differ in."""
    return (size + size * 100 // PERCENT) * (100 - PERCENT) // (100 + PERCENT)


def signatures(values: np.ndarray, bounds: np.ndarray, sampled: bool = True) -> tuple[np.ndarray, ...]:
    """(set, signature, band, needed) as arrays; single shingles have ``needed`` 0. ``sampled=False`` enters all
    partitions of large sets as well."""
    size = np.diff(bounds)
    top = np.maximum(size, 3)
    own = np.floor(np.log2(top / 3) + 1e-9).astype(np.int64)
    below = (own > 0) & (size * PERCENT // 100 < 3 * 2**own)
    out = []
    for member, band in ((np.flatnonzero(size >= 3), own), (np.flatnonzero((size >= 3) & below), own - 1)):
        if not member.size:
            continue
        count = size[member]
        row = np.repeat(np.arange(len(member)), count)
        at = np.arange(len(row)) + np.repeat(bounds[member] - (np.cumsum(count) - count), count)
        x, level = values[at], band[member]
        base = 3 * 2**level
        if sampled:
            parts = np.where(base >= SAMPLED, (base / 1.25).astype(np.int64), base).astype(np.uint64)
        else:
            # sets of up to 8/3 of the base come into a band, and differ from a linked one in up to a third of that
            parts = (base * 5 // 4).astype(np.uint64)
        limit = PARTITIONS if sampled else 1 << 40
        entered = np.minimum(parts, np.where(base >= SAMPLED, limit, 1 << 40).astype(np.uint64)).astype(np.int64)
        spread = mix(x + mix(level.astype(np.uint64) + np.uint64(1000))[row])
        part = (spread % parts[row]).astype(np.int64)
        use = np.flatnonzero(part < entered[row])
        # partitions of one set lie together, so that no table is wider than its set needs
        first = np.cumsum(entered) - entered
        place = first[row[use]] + part[use]
        total, seen = np.zeros(int(entered.sum()), np.uint64), np.bincount(place, minlength=int(entered.sum()))
        np.add.at(total, place, mix(x[use] + np.uint64(13)))
        full = np.flatnonzero(seen)
        owner = np.searchsorted(first, full, "right") - 1
        need = most_different(count) + 1
        if sampled:
            # out of reach for sampled sets with more differences than entered partitions
            need = np.minimum(need, PARTITIONS + 1)
        tag = mix((full - first[owner]).astype(np.uint64) + (level[owner].astype(np.uint64) << np.uint64(32)) + np.uint64(1 << 50))
        out.append((member[owner], mix(total[full] + tag), level[owner], need[owner]))
        few = (np.bincount(owner, minlength=len(member)) < need) & ((base < SAMPLED) | (not sampled))
        lone = few[row]
        out.append((member[row[lone]], mix(x[lone] + mix(level[row[lone]].astype(np.uint64) + np.uint64(77))), level[row[lone]], np.zeros(int(lone.sum()), np.int64)))
    if not out:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def document_sets(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, class, n_shingles, signatures`` of each document; ``class`` is 0 for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in slices(batch.column(2)):
                values, bounds = shingle_sets(buf, offsets)
                member, signature, _, _ = signatures(values, bounds)
                order = np.argsort(member, kind="stable")
                ends = np.searchsorted(member[order], np.arange(len(bounds))).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(signature[order].view(np.int64)))
                made = [pa.array(set_hashes(values, bounds).view(np.int64)), pa.array(np.diff(bounds).astype(np.int64)), listed]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first), *made], ["doc_id", "text_key", "class", "n_shingles", "signatures"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_text()).alias("text_key"), _text().alias("text"))
    return map_arrow(rows, run, "doc_id long, text_key long, class long, n_shingles long, signatures array<long>")


def _signature_rows(texts: DataFrame) -> DataFrame:
    """``signature, class, band, spare`` of each row's ``text``, by all partitions: ``spare`` of a class's signatures in a
    band may be left out, those that most classes have first. Single shingles, none of which may, have a negative band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offsets in slices(batch.column(0)):
                values, bounds = shingle_sets(buf, offsets)
                member, signature, band, needed = signatures(values, bounds, sampled=False)
                place = (member * 64 + band) * 2 + (needed == 0)
                entered = np.bincount(place)[place]
                spare = np.where(needed > 0, np.maximum(entered - needed, 0), 0)
                banded = np.where(needed > 0, band, ~band)
                columns = [signature.view(np.int64), set_hashes(values, bounds).view(np.int64)[member], banded.astype(np.int8), spare.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["signature", "class", "band", "spare"])

    return map_arrow(texts.select("text"), run, "signature long, class long, band byte, spare int")


def _beside(rows: DataFrame, some: DataFrame, found: dict[str, Column]) -> DataFrame:
    """``rows`` with the aggregates ``found`` of all rows that have the same signature.

    One shuffle, by windows. A signature that would fill a window with more than a small share of the rows is counted apart;
    ``some``, a few of the rows, tell which these are, and nothing but where a row is counted depends on them.
    """
    seen = staged(some.groupBy("signature").agg(F.count(F.lit(1)).alias("n")), "partenum-some")
    total = seen.agg(F.sum("n")).first()[0] or 0
    heavy = seen.where((F.col("n") * SHARE > total) & (F.col("n") >= SOME)).select("signature")
    heavy = [r[0] for r in heavy.collect()]  # fewer than SHARE
    if heavy:
        rows = staged(rows, "partenum-all")
    among = F.col("signature").isin(heavy)
    window = Window.partitionBy("signature")
    light = (rows.where(~among) if heavy else rows).withColumns({k: v.over(window) for k, v in found.items()})
    if not heavy:
        return light
    known = rows.where(among).groupBy("signature").agg(*[v.alias(k) for k, v in found.items()])
    return light.unionByName(rows.where(among).join(F.broadcast(known), "signature"))


def _members(documents: DataFrame, sets: DataFrame, keys: DataFrame) -> DataFrame:
    """``bucket, class`` of all buckets in which classes have to be compared."""
    each = F.explode("signatures").alias("signature")
    rows = _beside(
        sets.select("class", each), sets.sample(1 / SOME, seed=SOME).select("class", each),
        {"a": F.min("class"), "b": F.max("class")},
    )
    kept = staged(rows.where("a <> b").select("signature", "class").distinct(), "partenum-buckets")
    # sets count once, though copies were rows of their own above: a bucket is hot by its distinct sets
    sizes = kept.groupBy("signature").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > HOT)
    hot = staged(kept.join(sizes, "signature").select("signature", "class"), "partenum-hot")
    calm = with_keys(kept, hot, "signature", "left_anti")
    return calm.select(F.col("signature").alias("bucket"), "class").unionByName(_rarest(documents, keys, hot.select("class").distinct()))


def _texts(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """``text_key, text`` of the texts with these keys, each once."""
    keyed = documents.select(F.xxhash64(_text()).alias("text_key"), _text().alias("text"))
    return with_keys(keyed, keys, "text_key").dropDuplicates(["text_key"])


def _rarest(documents: DataFrame, keys: DataFrame, classes: DataFrame) -> DataFrame:
    """``bucket, class`` of classes that have hot buckets, by all their partitions and without chance.

    A set that a linked one differs from in d shingles at most shares all its partitions' signatures but d. So in any
    order of the signatures that is the same for all sets, the first one that both share is among the first d + 1 of
    each. Taken in the order of how many of these classes have them, it is the rarest ones that are kept: what a
    passage or a large family has in common falls out, unless it is too much of the set to be left out. Ranks are
    counted from the other end, so those that a class has alone, by far the most, need not be ranked.
    """
    keys = staged(with_keys(keys, staged(classes, "partenum-hot-classes"), "class"), "partenum-hot-texts")
    some = staged(keys.sample(1 / SOME, seed=SOME), "partenum-some-texts")
    rows, few = (_signature_rows(_texts(documents, k)) for k in (keys, some))
    counted = _beside(rows, few, {"n": F.count(F.lit(1))}).where("n > 1")
    rank = F.row_number().over(Window.partitionBy("class", "band").orderBy(F.desc("n"), F.desc("signature")))
    kept = counted.withColumn("rank", rank).where("rank > spare")
    return kept.select(F.col("signature").alias("bucket"), "class")


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[float, bool]:
    """Jaccard similarity of two sets, and whether they are linked (in whole numbers)."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union, 100 * shared >= PERCENT * union


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (``a, b``) with their distance and whether they are linked. Only texts that are in a pair are shuffled."""
    pairs = staged(pairs, "partenum-pairs")
    one = with_keys(texts.select(F.col("class").alias("a"), F.col("text").alias("left")), pairs, "a")
    two = with_keys(texts.select(F.col("class").alias("b"), F.col("text").alias("right")), pairs, "b")

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for _, _, buf, offsets in slices(column):
            values, bounds = shingle_sets(buf, offsets)
            out += [values[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [similarity(x, y) for x, y in zip(sets(part.column(2)), sets(part.column(3)), strict=True)]
                columns = [pa.array([1 - j for j, _ in found], pa.float64()), pa.array([x for _, x in found], pa.bool_())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["a", "b", "far", "linked"])

    both = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")
    return map_arrow(both, run, "a long, b long, far double, linked boolean")


def lanes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Four bits for each of ``LANES`` groups of the domain, for each set: the exclusive or of its shingles' bits.

    A shingle that one of two sets has and the other has not changes one lane at most. So two sets differ in as many
    shingles as lanes at least.
    """
    n = len(bounds) - 1
    spread = mix(values + np.uint64(4242))
    place = np.repeat(np.arange(n), np.diff(bounds)) * LANES + (spread % np.uint64(LANES)).astype(np.int64)
    found = np.zeros(n * LANES, np.uint8)
    np.bitwise_xor.at(found, place, (spread >> np.uint64(60)).astype(np.uint8))
    return np.ascontiguousarray(found[::2] | (found[1::2] << 4)).view(np.int64).reshape(n, -1)


def _laned(texts: DataFrame) -> DataFrame:
    """``class, lanes`` of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in slices(batch.column(1)):
                made = lanes(*shingle_sets(buf, offsets))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), listed], ["class", "lanes"])

    return map_arrow(texts.select("class", "text"), run, "class long, lanes array<long>")


def _lanes_apart() -> Column:
    """In how many lanes ``lanes`` and ``drawn`` differ."""
    ones = F.lit(0x1111111111111111)
    total = F.lit(0)
    for k in range(LANES // 16):
        x = F.col("lanes")[k].bitwiseXOR(F.col("drawn")[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(ones))
    return total


def _lanes_alike() -> Column:
    """Whether sets of sizes ``n`` and ``m`` can be linked, by their lanes."""
    return _lanes_apart() * (100 + PERCENT) <= (F.col("n") + F.col("m")) * (100 - PERCENT)


def _small_meetings(placed: DataFrame, pivots: DataFrame) -> DataFrame:
    """Pairs (``a, b``) of pivots and members of buckets up to ``LARGE`` that no bound rules out."""
    # a pivot meets the head's component, and pivots after it; a distance that is not known is no bound
    meet = (F.col("component") != F.col("of")) & (F.col("class") != F.col("a"))
    meet &= (F.col("component") == F.col("head")) | (F.col("rank") > F.col("turn"))
    meet &= F.coalesce(F.abs(F.col("far") - F.col("out")) <= FURTHEST, F.lit(True)) & _alike("n", "m") & _lanes_alike()
    small = F.col("last") <= LARGE
    pairs = placed.where(small).drop("last").join(pivots.where(small).drop("last"), "bucket").where(meet)
    return pairs.select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b"))


def _large_meetings(placed: DataFrame, pivots: DataFrame) -> DataFrame:
    """The same of larger buckets, by arrays: a bucket is met in pieces of ``TOGETHER`` members, a group for each."""

    def run(members: pa.Table, pivots: pa.Table) -> pa.Table:
        at = {c: members.column(c).to_numpy() for c in ("class", "a", "component", "head", "n", "far", "rank")}
        to = {c: pivots.column(c).to_numpy()[:, None] for c in ("pivot", "of", "m", "out", "turn")}
        lanes, drawn = (
            np.asarray(t.column(c).combine_chunks().flatten()).view(np.uint64).reshape(len(t), LANES // 16) for t, c in ((members, "lanes"), (pivots, "drawn"))
        )
        found = []
        for k in range(0, len(pivots), PIVOTS):
            x = {c: v[k : k + PIVOTS] for c, v in to.items()}
            meet = (at["component"] != x["of"]) & (at["class"] != at["a"]) & ((at["component"] == at["head"]) | (at["rank"] > x["turn"]))
            meet &= ~(np.abs(at["far"] - x["out"]) > FURTHEST)
            meet &= np.minimum(at["n"], x["m"]) * 100 >= np.maximum(at["n"], x["m"]) * PERCENT
            i, j = np.nonzero(meet)
            apart = lanes[j] ^ drawn[i + k]
            apart |= apart >> np.uint64(1)
            apart = (apart | (apart >> np.uint64(2))) & np.uint64(0x1111111111111111)
            near = np.bitwise_count(apart).sum(axis=1, dtype=np.int64) * (100 + PERCENT) <= (at["n"][j] + x["m"][i, 0]) * (100 - PERCENT)
            found.append(np.sort(np.stack((at["class"][j[near]], x["pivot"][i[near], 0])), axis=0))
        pairs = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    large, keys = F.col("last") > LARGE, ["bucket", "piece"]
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    here = placed.where(large).withColumn("piece", F.expr(f"rank div {TOGETHER}")).drop("last")
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"last div {TOGETHER}")))
    there = pivots.where(large).withColumn("piece", pieces).drop("last")
    # by number: what is small in bytes is not small in pairs, and must not be put together
    here, there = here.repartition(parts, *keys), there.repartition(parts, *keys)
    return here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(run, "a long, b long")


def class_components(documents: DataFrame, sets: DataFrame) -> DataFrame | None:
    """``class, component`` of the classes that are linked with another; None if there are none."""
    classes = sets.groupBy("class").agg(F.min("text_key").alias("text_key"), F.max("n_shingles").alias("n"))
    classes = staged(classes, "partenum-classes")
    members = staged(_members(documents, sets, classes), "partenum-members")
    # a bucket that only one class is left in compares nothing
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = staged(members.join(sizes, "bucket"), "partenum-met")
    # the class that meets most others: of a text and its altered copies, most likely the text
    meets = staged(members.groupBy("class").agg(F.sum("size").alias("meets")), "partenum-meets")
    if meets.isEmpty():
        return None
    keys = staged(classes.join(meets, "class").drop("meets"), "partenum-keys")
    texts = staged(_texts(documents, keys).join(keys, "text_key").drop("text_key"), "partenum-texts")
    sized = keys.select("class", "n")

    heads = staged(members.join(meets, "class").groupBy("bucket").agg(F.max_by("class", F.struct("meets", "class")).alias("a")), "partenum-heads")
    near = members.join(heads, "bucket").where("class <> a").select("a", F.col("class").alias("b")).distinct()
    near = near.join(sized.withColumnsRenamed({"class": "a", "n": "m"}), "a").join(sized.withColumnRenamed("class", "b"), "b")
    stars = staged(_compared(near.where(_alike("n", "m")).select("a", "b"), texts), "partenum-stars")
    labels = components(stars.where("linked").select("a", "b")).withColumnRenamed("node", "class")
    # two copies of a text share many of its buckets: hot ones with one head are taken as one
    bucket = F.when(F.col("size") > HOT, F.xxhash64("a")).otherwise(F.col("bucket")).alias("bucket")
    met = members.join(heads, "bucket").select(bucket, "class", "a").distinct().join(sized, "class")
    far = stars.select("a", F.col("b").alias("class"), "far")
    drawn = staged(_laned(texts), "partenum-lanes")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("class"))
    met = staged(met.join(far, ["a", "class"], "left").withColumn("rank", rank), "partenum-open")
    done, width = 0, PIVOTS
    while True:
        placed = met.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
        spread = placed.groupBy("bucket").agg(
            F.max(F.when(F.col("class") == F.col("a"), F.col("component"))).alias("head"), F.min("component").alias("lo"),
            F.max("component").alias("hi"), F.max("rank").alias("last"),
        )
        placed = placed.join(spread.where("lo <> hi").select("bucket", "head", "last"), "bucket")
        # whoever is in the head's component has met what it must: the others come to it
        rest = placed.where((F.col("component") != F.col("head")) & (F.col("rank") > done))
        rest = rest.select(
            "bucket", F.col("class").alias("pivot"), F.col("component").alias("of"), F.col("n").alias("m"), F.col("far").alias("out"),
            F.col("rank").alias("turn"), "last",
        )
        rest = staged(rest, "partenum-rest")
        if rest.isEmpty():
            return labels
        pivots = rest.where(F.col("turn") <= done + width).join(drawn.withColumnsRenamed({"class": "pivot", "lanes": "drawn"}), "pivot")
        placed = staged(with_keys(placed, rest, "bucket").join(drawn, "class"), "partenum-placed")
        pairs = _small_meetings(placed, pivots).unionByName(_large_meetings(placed, pivots)).distinct()
        found = staged(_compared(pairs, texts).where("linked").select("a", "b"), "partenum-links")
        if not found.isEmpty():
            # what is known of a component is one link of each class to its least
            known = labels.select(F.col("class").alias("a"), F.col("component").alias("b"))
            labels = components(known.unionByName(found)).withColumnRenamed("node", "class")
        done, width = done + width, min(16 * width, MOST)


def _alike(n: str, m: str) -> Column:
    """Whether sets of these sizes can be linked."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def similarity_classes(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` and the class of each document."""
    sets = staged(document_sets(documents), "shingle-sets")
    found = class_components(documents, sets)
    sets = sets.drop("signatures")
    if found is None:
        sets = sets.withColumn("component", F.col("class"))
    else:
        sets = sets.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    sets = staged(sets, "shingle-components")
    least = staged(sets.groupBy("component").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("members")), "shingle-least")
    empty = F.col("n_shingles") == 0
    # a component may hold a third of all documents
    placed = join_heavy(sets, least, ["component"], "members", least.agg(F.sum("members")).first()[0] or 0)
    return placed.select(
        "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        F.col("class").alias("set_class"), "text_key", "component",
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id, of rows with one id the one with
    the least hash of its text, and of rows that have both in common the least by its other columns (which must have an
    order). Rows without an id come after all others. Documents without words are linked with nothing and all stay.
    """
    found = staged(similarity_classes(documents), "near-found").where("n_shingles > 0")
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")
    keys = found.select("component", key.alias("key"))
    tops = keys.groupBy("component").agg(F.min("key").alias("top"), F.count(F.lit(1)).alias("members"))
    tops = staged(tops.where("members > 1"), "near-tops")
    total = tops.agg(F.sum("members")).first()[0] or 0
    placed = join_heavy(keys, tops, ["component"], "members", total)
    gone = staged(placed.where("key <> top").select("key").distinct(), "near-copies")
    # rows that have id and text in common with the one that stays
    again = placed.where("key = top").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = staged(again.select("key"), "near-repeated")
    doc_id = F.col("doc_id").cast("long")
    own = F.struct(doc_id.isNull().alias("unknown"), doc_id.alias("doc_id"), F.xxhash64(_text()).alias("text_key"))
    rows = with_keys(boxed(documents, key=own), gone, "key", "left_anti")
    once = with_keys(rows, again, "key").groupBy("key").agg(F.min("row").alias("row"))
    return unboxed(with_keys(rows, again, "key", "left_anti").select("row").unionByName(once.select("row")), documents.columns)
