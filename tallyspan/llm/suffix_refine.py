"""Operator 10: removal of repeated byte strings by bucket-pointer refinement.

Strings of ``LENGTH`` bytes that start at two places anywhere are found as follows. Every such
string holds, at its least hashed ``Q``-gram, one *anchor*; equal strings have it at the same offset.
The suffixes at the anchors, one in about 150, stand for all suffixes.

1. Anchors with equal ``Q``-grams make the initial buckets; an anchor alone in its bucket is done.
2. A bucket is refined on the identifier of the whole surroundings, the bytes at earlier and later
   offsets up to the ends of all strings around the anchor: members with equal ones share all of them.
3. What is left is refined recursively: the possible strings around an anchor are numbered by how far they
   reach to its left. For a range of them, members are put into buckets on what all strings of the
   range have in common, and these into buckets on what they have together. Alone in the first: no
   string of the range is repeated. Together in the second: all are. Otherwise both halves of the range
   are refined within the bucket just found, with one member standing for those already settled.

Buckets of up to ``BUCKET`` surroundings are refined inside a task, many at a time; in a
larger one each string is numbered and counted by an aggregation of its own, which splits any bucket. Only
hashes are shuffled in steps 1 and 2; texts are joined once for the surroundings left by step 2, once to
cut the strings out. Equality is that of 64-bit hashes within equal 64-bit buckets.

Defined cases: a null text counts as empty; texts shorter than ``LENGTH`` lose nothing; overlapping and
periodic strings count; repeated rows, with equal or null ids too, are occurrences of their own;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.arrays import Hasher, mix, slices
from tallyspan.llm.skewed import join_heavy
from tallyspan.llm.staging import map_arrow, staged, with_keys

LENGTH = 400
Q = 100
#: Surroundings that one bucket may hold to be refined inside a task (about 14 MB).
BUCKET = 20_000
#: Bytes of text whose anchors are sought at once.
PIECE = 1 << 19
_PLACE_BITS = np.uint64(24)


def _sliding_min(v: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` consecutive values."""
    n = len(v) - size + 1
    blocks = np.concatenate((v, np.full(-len(v) % size, np.iinfo(v.dtype).max, v.dtype))).reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1 : size - 1 + n])


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH, q: int = Q) -> Iterator[tuple]:
    """(text, place, least reach, most reach, Q-gram, surroundings) of all anchors, as arrays.

    The reach is how far a string around the anchor starts to the anchor's left. Long buffers are taken in
    pieces with margins, so memory does not grow with a text's length; an anchor of two pieces comes once.
    """
    size = length - q + 1
    given = -1  # anchors never go back as starts go on
    for begin in range(0, len(buf), PIECE):
        low, high = max(0, begin - length), min(len(buf), begin + PIECE + 3 * length)
        part = buf[low:high]
        hashes = Hasher(part)
        grams = hashes.grams(q)
        if len(grams) < size:
            continue
        place = np.arange(len(grams), dtype=np.uint64)
        least = _sliding_min((grams >> _PLACE_BITS << _PLACE_BITS) | place, size)
        start = np.arange(len(least)) + low
        text = np.searchsorted(offsets, start, "right") - 1
        whole = (start >= begin) & (start < begin + PIECE) & (start + length <= offsets[text + 1])
        least = least[whole]
        if not len(least):
            continue
        at = np.unique(least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        at = at[at + low > given]
        if not len(at):
            continue
        given = int(at[-1]) + low
        text = np.searchsorted(offsets, at + low, "right") - 1
        first, last = offsets[text] - low, offsets[text + 1] - low
        most = np.minimum(size - 1, at - first)
        fewest = np.maximum(0, at + length - last)
        around = hashes.spans(at - most, at - fewest + length)
        around = mix(around + most.astype(np.uint64) * np.uint64(1 << 20) + fewest.astype(np.uint64))
        yield text, at - first, fewest, most, grams[at], around


def refine(bucket: np.ndarray, buf: np.ndarray, offsets: np.ndarray, fewest: np.ndarray, most: np.ndarray, length: int = LENGTH, q: int = Q) -> tuple:
    """Repeated strings among surroundings: (member, least reach, most reach) of found ranges.

    ``buf`` and ``offsets`` hold the surroundings, which are distinct within a bucket.
    """
    hashes = Hasher(buf)
    centre = offsets[:-1] + most
    member = np.arange(len(bucket))
    low = np.zeros(len(member), np.int64)
    high = np.full(len(member), length - q, np.int64)
    base, open_ = bucket.astype(np.uint64), np.ones(len(member), bool)
    found = []
    while len(member):
        a, b = np.maximum(low, fewest[member]), np.minimum(high, most[member])
        fits = a <= b
        member, low, high, base, open_, a, b = (x[fits] for x in (member, low, high, base, open_, a, b))
        common = hashes.spans(centre[member] - low, centre[member] - high + length)
        ids = mix(base + mix(common + low.astype(np.uint64)))
        _, which, counts = np.unique(ids, return_inverse=True, return_counts=True)
        shared = counts[which] > 1
        member, low, high, open_, a, b, ids = (x[shared] for x in (member, low, high, open_, a, b, ids))
        if not len(member):
            break
        together = hashes.spans(centre[member] - b, centre[member] - a + length)
        whole = mix(ids + mix(together + a.astype(np.uint64) * np.uint64(1 << 20) + b.astype(np.uint64)))
        _, first, which, counts = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
        settled = counts[which] > 1
        done = settled & open_
        found.append((member[done], a[done], b[done]))
        # one stands for those settled, as long as some of the bucket are not
        keep = ~settled
        keep[first[counts > 1]] = True
        waits = np.unique(ids[open_ & ~settled])
        keep &= np.isin(ids, waits) & (low < high)
        open_ = open_ & ~settled
        member, low, high, base, open_ = (x[keep] for x in (member, low, high, ids, open_))
        middle = (low + high) // 2
        member, base, open_ = (np.concatenate((x, x)) for x in (member, base, open_))
        low, high = np.concatenate((low, middle + 1)), np.concatenate((middle, high))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _keyed(documents: DataFrame) -> DataFrame:
    """``key, text``: one key for each id and text; repeated rows have the same one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return documents.select(F.xxhash64(doc_id, doc_id.isNull(), text).alias("key"), doc_id.alias("doc_id"), text.alias("text"))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """``key, begin, end``: pieces of the texts covered by repeated strings; they may overlap."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, buf, offsets in slices(batch.column(1)):
                for text, at, fewest, most, gram, around in anchors(buf, offsets, length, q):
                    columns = [gram.view(np.int64), around.view(np.int64), keys[first:last][text], at.astype(np.int32), fewest.astype(np.int16), most.astype(np.int16)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "around", "key", "at", "fewest", "most"])

    schema = "gram long, around long, key long, at int, fewest short, most short"
    rows = staged(map_arrow(keyed.select("key", "text"), find, schema), "suffix-anchors")
    buckets = (
        rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("around").alias("a"), F.max("around").alias("b"))
        .where("n > 1").select("gram", "n", (F.col("a") != F.col("b")).alias("mixed"))
    )
    buckets = staged(buckets, "suffix-grams")
    total = buckets.agg(F.sum("n")).first()[0] or 0
    # a gram that a third of all anchors have is joined where its anchors are
    shared = staged(join_heavy(rows, buckets, ["gram"], "n", total).drop("n"), "suffix-buckets")
    mixed = shared.where("mixed").drop("mixed")
    around = staged(
        mixed.groupBy("gram", "around").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at", "fewest", "most")).alias("one")),
        "suffix-surroundings",
    )
    repeated = staged(around.where("n > 1").select("gram", "around", "n"), "suffix-repeated")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    same = join_heavy(mixed, repeated, ["gram", "around"], "n", total)
    whole = shared.where("not mixed").select(*mixed.columns).unionByName(same.select(*mixed.columns))
    spans = [whole.select("key", (F.col("at") - F.col("most")).alias("begin"), (F.col("at") - F.col("fewest") + length).alias("end"))]
    single = F.col("n") == 1
    counts = around.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.max(single).alias("open"))
    left = staged(
        _surroundings(keyed, around.join(counts.where("members > 1 and open"), "gram").select("gram", "members", single.alias("open"), "one.*"), length),
        "suffix-open",
    )
    spans.append(_refined(left.where(F.col("members") <= BUCKET), length, q))
    spans.append(_counted(left.where(F.col("members") > BUCKET), length))
    return spans[0].unionByName(spans[1]).unionByName(spans[2])


def _surroundings(keyed: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """Adds the bytes around each member, cut from its text."""
    entry = F.struct("gram", "members", "open", "at", "fewest", "most")
    wanted = staged(members.groupBy("key").agg(F.collect_list(entry).alias("entries")), "suffix-members")
    texts = with_keys(keyed.select("key", F.col("text").cast("binary").alias("bytes")), wanted, "key").dropDuplicates(["key"])
    return (
        texts.join(wanted, "key").select("key", "bytes", F.explode("entries").alias("e"))
        .select("key", "e.*", F.expr(f"substring(bytes, e.at - e.most + 1, e.most - e.fewest + {length})").alias("around"))
    )


def _refined(left: DataFrame, length: int, q: int) -> DataFrame:
    """Step 3 inside tasks: buckets come sorted; each call takes whole buckets."""
    names = ["key", "gram", "open", "at", "fewest", "most", "around"]

    def solve(table: pa.Table) -> pa.RecordBatch:
        column = {n: table.column(n).combine_chunks() for n in names}
        number = {n: column[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in ("key", "gram", "at", "fewest", "most")}
        raw = column["around"]
        raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
        (_, _, buf, offsets), = slices(raw, 1 << 40)
        member, low, high = refine(number["gram"].view(np.uint64), buf, offsets, number["fewest"], number["most"], length, q)
        keep = column["open"].to_numpy(zero_copy_only=False)[member]
        member, low, high = member[keep], low[keep], high[keep]
        at = number["at"][member]
        columns = [number["key"][member], (at - high).astype(np.int32), (at - low + length).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # the last bucket may go on in the next batch
            grams = batch.column("gram").to_numpy(zero_copy_only=False)
            end = int(np.searchsorted(grams, grams[-1]))
            if end:
                yield solve(pa.Table.from_batches([*held, batch.slice(0, end)]))
                held = []
            held.append(batch.slice(end))
        if held:
            yield solve(pa.Table.from_batches(held))

    dealt = left.select(*names).repartition("gram").sortWithinPartitions("gram")
    return map_arrow(dealt, run, "key long, begin int, end int")


def _counted(left: DataFrame, length: int) -> DataFrame:
    """Step 3 for very large buckets: each string around a member is counted by its hash."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at, fewest, most = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("key", "at", "fewest", "most"))
            is_open = batch.column("open").to_numpy(zero_copy_only=False)
            grams = batch.column("gram").to_numpy(zero_copy_only=False)
            for first, last, buf, offsets in slices(batch.column("around")):
                hashes = Hasher(buf)
                count = (most - fewest + 1)[first:last]
                row = np.repeat(np.arange(last - first), count)
                step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = offsets[:-1][row] + step
                # one place counts once for each anchor and reach
                reach = most[first:last][row] - step
                string = mix(hashes.spans(begin, begin + length) + mix(grams[first:last][row].view(np.uint64) + reach.astype(np.uint64)))
                columns = [string.view(np.int64), keys[first:last][row], ((at - most)[first:last][row] + step).astype(np.int32), is_open[first:last][row]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["string", "key", "begin", "open"])

    rows = map_arrow(left, strings, "string long, key long, begin int, open boolean")
    counts = rows.groupBy("string").agg(F.count(F.lit(1)).alias("n"))
    twice = rows.where("open").join(counts.where("n > 1"), "string")
    return twice.select("key", "begin", (F.col("begin") + length).alias("end"))


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the given spans; touching spans make one run."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(begins), bool)
    new[1:] = begins[1:] > ends[:-1]
    return begins[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)] if len(ends) else ends


def _cut(documents: DataFrame, length: int, q: int, schema: str, make) -> DataFrame:
    keyed = _keyed(documents)
    spans = repeated_spans(keyed, length, q).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    joined = keyed.join(spans, "key", "left").select("doc_id", "text", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        types = [types[c.split()[1]] for c in schema.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text, begins, ends in zip(*batch.columns, strict=True):
                raw = text.as_buffer() if text.is_valid else b""
                view, kept, runs = memoryview(raw), [], 0
                at = 0
                if begins.is_valid:
                    for b, e in zip(*(x.tolist() for x in merged(*(c.values.to_numpy().astype(np.int64) for c in (begins, ends)))), strict=True):
                        kept.append(view[at:b])
                        at, runs = e, runs + 1
                kept.append(view[at:])
                rows.append((doc_id.as_py(), *make(len(view), b"".join(kept), runs)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return map_arrow(joined, run, schema)


def cut_repeats(documents: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """``doc_id, kept``: the bytes left of each document."""
    return _cut(documents, length, q, "doc_id long, kept binary", lambda n, kept, runs: (kept,))


def repeat_digests(documents: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """How much of each document is removed and kept, and a digest of what is left. ``n_bytes`` is the size of the input."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes long"
    return _cut(documents, length, q, schema, lambda n, kept, runs: (n, n - len(kept), runs, hashlib.sha256(kept).hexdigest(), len(kept)))
