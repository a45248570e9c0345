"""Operator 11: fill-in-middle transformation with cuts found by a Fenwick tree.

A text is a row of fixed blocks of its UTF-8 bytes. A Fenwick tree over the blocks holds, for each
node, how many units and how many code points begin in the blocks that the node stands for. To cut
after k units, a binary-lifting descent walks down from the largest power of two, taking a node
whenever its units do not exceed what is left; it ends at the block in which unit k + 1 begins, and only
that block is looked into. The code points before the cut come from the same nodes on the way down. No
text is decoded or split into characters: a cut costs O(log blocks + block).

Units are ``char`` (code points) or ``word`` (a run of bytes other than white space ``[\\x20\\x09-\\x0D]``
with the white space behind it; white space at the start of a text is a unit of its own).

The random numbers of a document are the first four 8-digit groups of the hex SHA-256 of ``1:`` and its
decimal id, so that the outcome depends on id and text alone, not on partitions or repeated attempts.

Rows do not meet each other: the job has no shuffle, and memory is bounded by a batch of
``staging.BATCH_BYTES`` or by the longest text.

Defined cases: a null text counts as empty; an empty text, and one that holds one of the three marks,
stays plain; a null id counts as empty text in the hash; equal ids give equal cuts for equal texts;
further columns are not read by :func:`fim_digests` and kept by :func:`fill_in_middle`, whose own column gets a name
that is free; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.llm.arrays import slices
from tallyspan.llm.staging import map_arrow

#: Bytes of a block.
BLOCK = 1 << 10

# The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

#: Percent of the documents that are rearranged, and of those the percent in suffix-first order.
FIM_PERCENT, SPM_PERCENT = 90, 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def char_starts(buf: np.ndarray) -> np.ndarray:
    """Whether a code point begins at each byte."""
    return (buf & 0xC0) != 0x80


def word_starts(buf: np.ndarray) -> np.ndarray:
    """Whether a word begins at each byte; so does the text."""
    space = _SPACE[buf]
    starts = ~space
    starts[1:] &= space[:-1]
    starts[:1] = True
    return starts


UNITS = {"char": char_starts, "word": word_starts}


class BlockTree:
    """A Fenwick tree over the blocks of one text: a row of (units, code points) for each node."""

    def __init__(self, buf: np.ndarray, unit: str = "char", block: int = BLOCK):
        self._buf, self._block, self._starts = buf, block, UNITS[unit]
        self._whole = self._starts(buf) if unit != "char" else None
        n = -(-len(buf) // block)
        counts = np.zeros((n + 1, 2), np.int64)
        at = np.arange(0, len(buf), block)
        if n:
            chars = char_starts(buf)
            counts[1:, 1] = np.add.reduceat(chars, at, dtype=np.int64)
            counts[1:, 0] = counts[1:, 1] if unit == "char" else np.add.reduceat(self._whole, at, dtype=np.int64)
        sums = np.cumsum(counts, axis=0)
        nodes = np.arange(n + 1)
        # node i stands for the blocks after i - lowbit(i), up to block i
        self._tree = sums - sums[nodes - (nodes & -nodes)]
        self.units, self.chars = map(int, sums[-1])

    def cut(self, units: int) -> tuple[int, int]:
        """Byte at which unit number ``units`` (from 0) begins, and the code points before it."""
        if units >= self.units:
            return len(self._buf), self.chars
        node, left, chars = 0, units, 0
        step = 1 << (len(self._tree) - 1).bit_length() >> 1
        while step:
            if node + step < len(self._tree) and self._tree[node + step, 0] <= left:
                node += step
                left -= int(self._tree[node, 0])
                chars += int(self._tree[node, 1])
            step >>= 1
        first = node * self._block
        inside = self._buf[first : first + self._block]
        marks = char_starts(inside) if self._whole is None else self._whole[first : first + self._block]
        at = int(np.flatnonzero(marks)[left])
        return first + at, chars + int(np.count_nonzero(char_starts(inside[:at])))


@dataclass(frozen=True)
class Rearranged:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def draws(doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(b"1:%s" % (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def rearrange(doc_id: int | None, buf: np.ndarray, unit: str = "char", block: int = BLOCK) -> Rearranged:
    """One text, as UTF-8 bytes, in its new order."""
    raw = buf.tobytes()
    tree = BlockTree(buf, unit, block)
    a, b, plain, swap = draws(doc_id)
    if not raw or plain % 100 >= FIM_PERCENT or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)):
        return Rearranged(tree.units, "plain", None, None, raw)
    low, high = sorted((a % (tree.units + 1), b % (tree.units + 1)))
    (start, before), (end, until) = tree.cut(low), tree.cut(high)
    head, middle, tail = raw[:start], raw[start:end], raw[end:]
    if swap % 100 < SPM_PERCENT:
        form, parts = "spm", (SUFFIX, tail, PREFIX, head, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, head, SUFFIX, tail, MIDDLE, middle)
    return Rearranged(tree.units, form, before, until - before, b"".join(parts))


def restore(output: bytes, form: str) -> bytes:
    """The text of an output. No part holds a mark, so the first one found ends a part."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, rest = output[len(first) :].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return one + middle + two if form == "psm" else two + middle + one


def _each(batch: pa.RecordBatch, unit: str, block: int) -> Iterator[tuple[int | None, Rearranged]]:
    ids = batch.column("doc_id").to_pylist()
    for first, last, buf, offsets in slices(batch.column("text")):
        for k in range(last - first):
            yield ids[first + k], rearrange(ids[first + k], buf[offsets[k] : offsets[k + 1]], unit, block)


def _with_long_id(documents: DataFrame) -> DataFrame:
    return documents.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})


_FORM = "n long, form string, prefix_chars long, middle_chars long"


def fill_in_middle(documents: DataFrame, unit: str = "char", block: int = BLOCK, into: str = "fim") -> DataFrame:
    """The documents with a further column ``into`` (with as many ``_`` behind it as make it new): a struct of ``n``
    (units of the text), ``form``, ``prefix_chars``, ``middle_chars`` and the new ``text``. All columns stay."""
    while into in documents.columns:
        into += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [m for _, m in _each(batch, unit, block)]
            texts = pa.array([m.output for m in made], pa.binary()).cast(pa.string())
            found = pa.StructArray.from_arrays([*_columns(made), texts], [*_NAMES, "text"])
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, into])

    rows = _with_long_id(documents)
    kept = T.StructType(rows.schema.fields + T.StructType.fromDDL(f"`{into}` struct<{_FORM}, text string>").fields)
    return map_arrow(rows, run, kept)


_NAMES = ["n", "form", "prefix_chars", "middle_chars"]


def _columns(made: list[Rearranged]) -> list[pa.Array]:
    return [
        pa.array([m.n for m in made], pa.int64()),
        pa.array([m.form for m in made], pa.string()),
        pa.array([m.prefix_chars for m in made], pa.int64()),
        pa.array([m.middle_chars for m in made], pa.int64()),
    ]


def fim_digests(documents: DataFrame, unit: str = "char", block: int = BLOCK) -> DataFrame:
    """One row per document: the cuts, and digests of the output and of the text rebuilt from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, digests = [], []
            for _, m in _each(batch, unit, block):
                back = restore(m.output, m.form)
                digests.append([hashlib.sha256(x).hexdigest() for x in (m.output, back)])
                made.append(Rearranged(m.n, m.form, m.prefix_chars, m.middle_chars, b""))
            shas = [pa.array([d[k] for d in digests], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *_columns(made), *shas], ["doc_id", *_NAMES, "output_sha256", "restored_sha256"]
            )

    rows = _with_long_id(documents.select("doc_id", "text"))
    return map_arrow(rows, run, f"doc_id long, {_FORM}, output_sha256 string, restored_sha256 string")
