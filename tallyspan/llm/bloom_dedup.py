"""Operator 6: exact deduplication in two passes over a Bloom filter.

The first pass sets, for each text's SHA-256, cells of a filter that counts to two; the filter's
partial images are merged by segment. The second pass tests each row: rows of which some cell was
set once only are unique and pass straight through; the others, true repeats and few false ones, are
grouped by SHA-256 and rejoined. Only digests and ids of those rows are shuffled, and the group
table is aggregated before its shuffle, so a large group meets no single task.

The filter has ``CELLS_PER_ROW`` cells a row up to ``MAX_CELLS`` (16 MB as a broadcast bit set). Above
that, more unique rows are shuffled, and the result stays the same.

Defined cases: a null text counts as empty; of equal texts the row with the largest ``doc_id`` stays, a
null id counts as the smallest, and of rows repeated with their id one stays; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.staging import boxed, staged, unboxed

CELLS_PER_ROW = 16
HASHES = 2
MIN_CELLS = 1 << 16
MAX_CELLS = 1 << 27
#: Cells of one segment of the filter, the unit of merging.
SEGMENT = 1 << 16


def _cells(digests: list[bytes], n_cells: int) -> np.ndarray:
    """The cells of each digest, a row of ``HASHES``."""
    words = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)[:, :HASHES]
    return (words % np.uint64(n_cells)).astype(np.int64)


def build_filter(digests: DataFrame, n_cells: int) -> np.ndarray:
    """Bits of the cells that two or more rows have set. ``digests`` has one column, ``sha``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            # a row with both cells equal must not count as two rows
            found = np.sort(_cells(batch.column(0).to_pylist(), n_cells), axis=1)
            keep = np.ones(found.shape, bool)
            keep[:, 1:] = found[:, 1:] != found[:, :-1]
            cells, counts = np.unique(found[keep], return_counts=True)
            segments, first = np.unique(cells // SEGMENT, return_index=True)
            inside = (cells % SEGMENT).astype("<u2")
            bounds = np.append(first, len(cells))
            ones, twos = [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                ones.append(inside[a:b].tobytes())
                twos.append(inside[a:b][counts[a:b] > 1].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), pa.array(ones, pa.binary()), pa.array(twos, pa.binary())], ["segment", "once", "twice"])

    def merge(key, images):
        counts = np.zeros(SEGMENT, np.uint8)
        for once, twice in zip(images.column("once"), images.column("twice"), strict=True):
            at = np.frombuffer(once.as_buffer(), "<u2")
            counts[at] = np.minimum(counts[at] + 1, 2)
            counts[np.frombuffer(twice.as_buffer(), "<u2")] = 2
        bits = np.packbits(counts == 2).tobytes()
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits], pa.binary())})

    merged = (
        digests.mapInArrow(partial, "segment long, once binary, twice binary")
        .groupBy("segment").applyInArrow(merge, "segment long, bits binary")
    )
    bits = np.zeros(n_cells // 8, np.uint8)
    for row in merged.toLocalIterator():  # at most MAX_CELLS / 8 bytes in all
        at = row["segment"] * SEGMENT // 8
        bits[at : at + SEGMENT // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def filter_cells(n_rows: int) -> int:
    cells = MIN_CELLS
    while cells < min(CELLS_PER_ROW * n_rows, MAX_CELLS):
        cells *= 2
    return cells


def marked(documents: DataFrame) -> DataFrame:
    """The documents with ``_sha`` (of the whole text) and ``_maybe`` (possibly repeated)."""
    digest = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256))
    rows = documents.withColumn("_sha", digest)
    n_cells = filter_cells(documents.count())
    bits = documents.sparkSession.sparkContext.broadcast(build_filter(rows.select("_sha"), n_cells))

    @F.pandas_udf("boolean")
    def repeated(sha):
        import pandas as pd

        if not len(sha):
            return pd.Series([], dtype=bool)
        cells = _cells([bytes(x) for x in sha], n_cells)
        hit = (bits.value[cells >> 3] >> (7 - (cells & 7))) & 1
        return pd.Series(hit.all(axis=1))

    return rows.withColumn("_maybe", repeated("_sha"))


def duplicate_groups(documents: DataFrame) -> DataFrame:
    """One row per document: the row that stays, the size of the group, and whether this row stays."""
    found = marked(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    # written once, so that the row tags stay the same in both uses
    rows = staged(found.select("doc_id", "_sha", "_maybe", F.monotonically_increasing_id().alias("_row")), "bloom-rows")
    alone = rows.where("not _maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "_sha"
    )
    some = rows.where("_maybe")
    groups = some.groupBy("_sha").agg(
        F.max(F.struct("doc_id", "_row")).alias("_top"), F.count(F.lit(1)).alias("group_size")
    )
    joined = some.join(groups, "_sha").select(
        "doc_id", F.col("_top.doc_id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_top._row")).alias("kept"), "_sha"
    )
    return alone.unionByName(joined).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_duplicates(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns. Of rows with equal id and text the greatest by the other
    columns stays, so these must have an order (no maps)."""
    rows = marked(boxed(documents, text=F.col("text")))
    alone = rows.where("not _maybe").select("row")
    known = F.struct(F.col("row.doc_id").isNotNull().alias("known"), F.col("row.doc_id").cast("long").alias("id"), "row")
    tops = rows.where("_maybe").groupBy("_sha").agg(F.max(known).alias("top"))
    return unboxed(alone.unionByName(tops.select(F.col("top.row").alias("row"))), documents.columns)
