"""Operator 7: token ids in binary files, compressed document by document with one dictionary.

Documents are dealt by ranges of ``doc_id``, so file after file holds them in ascending order. Each
range becomes one file of blocks: a header with the SHA-256 of the dictionary, an index (id, offset,
number of ids, running number of ids) and the documents' ids, little-endian unsigned 32-bit integers,
each compressed on its own. One document is read by its index entry alone. A zstandard dictionary is trained on a
bounded sample of ids and stands in the folder beside the data.

Files are written by Spark's own writer, so they may lie wherever Spark can write, and a lost task
is written again. They are read back as binary files, never through a local path.

Defined cases: a null or empty text has the end id only; rows with a null ``doc_id`` come first;
equal ids are ordered by the text's hash; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.llm import bpe
from tallyspan.llm.arrays import slices
from tallyspan.llm.staging import map_arrow
from tallyspan.session import shared_folder

MAGIC = b"TALLYTOK"
END_ID = 2
#: The dictionary: its size, how many documents it is trained on, and the ids taken of each, from a place
#: in the text that its hash gives.
DICTIONARY_BYTES = 32 << 10
SAMPLE_DOCUMENTS = 1000
SAMPLE_IDS = 2048
LEVEL = 3
#: A block is closed after so many bytes of compressed ids.
BLOCK_BYTES = 4 << 20

#: magic, dictionary hash, part, documents, bytes of the compressed ids
_HEADER = struct.Struct("<8s32sIIQ")
_ENTRY = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("n", "<u4"), ("start", "<u8")])


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def train_dictionary(documents: DataFrame, path: str) -> bytes:
    """A dictionary of bounded size, trained in one task on a bounded sample of the documents.

    Empty when there is too little to train on; documents are then compressed without one.
    """
    key = F.xxhash64("doc_id")
    chosen = documents.select(key.alias("_key")).distinct().orderBy("_key").limit(SAMPLE_DOCUMENTS)
    some = documents.withColumn("_key", key).join(F.broadcast(chosen), "_key", "left_semi")
    # from anywhere in the text, as its beginning need not be like the rest
    begin = F.pmod(F.xxhash64("doc_id", "text"), F.greatest(F.length("text") - 8 * SAMPLE_IDS + 1, F.lit(1)))
    some = some.select(F.substr("text", (begin + 1).cast("int"), F.lit(8 * SAMPLE_IDS)).alias("text")).limit(SAMPLE_DOCUMENTS)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, samples = bpe.codec(path), []
        for batch in batches:
            for a, b, buf, offsets in slices(batch.column(0)):
                encoded = codec.encode(buf, offsets)
                samples += [np.array(encoded.ids(d)[0][:SAMPLE_IDS], "<u4").tobytes() for d in range(b - a)]
        samples = [s for s in samples if len(s) >= 8]
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except (zstandard.ZstdError, ValueError):
            made = b""
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["dictionary"])

    made = map_arrow(some.coalesce(1), train, "dictionary binary").first()
    return bytes(made["dictionary"]) if made else b""


def _block(part: int, digest: bytes, entries: list[tuple], payloads: list[bytes]) -> bytes:
    head = _HEADER.pack(MAGIC, digest, part, len(entries), sum(map(len, payloads)))
    return head + np.array(entries, _ENTRY).tobytes() + b"".join(payloads)


def write_token_files(documents: DataFrame, folder: str, tokenizer_path: str | None = None) -> None:
    """Writes ``folder/dictionary`` and ``folder/data``."""
    path = tokenizer_path or bpe.default_path()
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    raw = train_dictionary(documents, path)
    spark = documents.sparkSession
    _write_binary(spark.createDataFrame([(raw,)], "content binary").coalesce(1), f"{folder}/dictionary")
    digest = hashlib.sha256(raw).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec(path)
        compressor = zstandard.ZstdCompressor(LEVEL, dict_data=_dictionary(raw))
        part = TaskContext.get().partitionId()
        entries, payloads, size, start = [], [], 0, 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([_block(part, digest, entries, payloads)], pa.binary())], ["content"])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for a, _, buf, offsets in slices(batch.column(1)):
                encoded = codec.encode(buf, offsets)
                for d in range(len(offsets) - 1):
                    ids = np.append(encoded.array(d), END_ID).astype("<u4")
                    packed = compressor.compress(ids.tobytes())
                    doc_id = doc_ids[a + d]
                    entries.append((doc_id or 0, doc_id is not None, size, len(ids), start))
                    payloads.append(packed)
                    size += len(packed)
                    start += len(ids)
                    if size >= BLOCK_BYTES:
                        yield close()
                        entries, payloads, size = [], [], 0
        if entries:
            yield close()

    tie = F.xxhash64("text")
    dealt = documents.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    _write_binary(map_arrow(dealt, run, "content binary"), f"{folder}/data")


def _write_binary(df: DataFrame, path: str) -> None:
    """Each row's bytes as they are, then one line feed, by Spark's text writer."""
    df.select(F.col("content").cast("string").alias("value")).write.text(path)


@dataclass
class Block:
    """One block of a file: the index, and access to single documents."""

    part: int
    digest: bytes
    index: np.ndarray
    payload: memoryview

    def raw(self, k: int, decompressor: zstandard.ZstdDecompressor) -> bytes:
        """The ids of the ``k``-th document as little-endian 32-bit integers."""
        begin = int(self.index["offset"][k])
        end = int(self.index["offset"][k + 1]) if k + 1 < len(self.index) else len(self.payload)
        return decompressor.decompress(self.payload[begin:end])

    def document(self, doc_id: int, dictionary: bytes) -> list[int] | None:
        """The ids of one document; nothing else is decompressed."""
        found = np.flatnonzero((self.index["doc_id"] == doc_id) & (self.index["known"] == 1))
        if not found.size:
            return None
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        return np.frombuffer(self.raw(int(found[0]), reader), "<u4").tolist()


def blocks(content: bytes) -> Iterator[Block]:
    """The blocks of a file, in their order."""
    view, at = memoryview(content), 0
    while at < len(view):
        magic, digest, part, n, size = _HEADER.unpack_from(view, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += _HEADER.size
        index = np.frombuffer(view, _ENTRY, n, at)
        at += n * _ENTRY.itemsize
        yield Block(part, digest, index, view[at : at + size])
        at += size + 1


def read_dictionary(spark: SparkSession, folder: str) -> bytes:
    """The folder's dictionary, at most ``DICTIONARY_BYTES`` long."""
    return spark.read.format("binaryFile").load(f"{folder}/dictionary").first()["content"][:-1]


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files alone."""
    raw = read_dictionary(spark, folder)
    digest = hashlib.sha256(raw).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            for content in batch.column(0):
                for block in blocks(content.as_buffer()):
                    if block.digest != digest:
                        raise ValueError("the file was written with another dictionary")
                    crcs = [zlib.crc32(block.raw(k, reader)) for k in range(len(block.index))]
                    known = block.index["known"] == 1
                    columns = [
                        pa.array(block.index["doc_id"].copy(), mask=~known),
                        pa.array(np.full(len(crcs), block.part, np.int32)),
                        pa.array(block.index["start"].astype(np.int64)),
                        pa.array(block.index["n"].astype(np.int64)),
                        pa.array(crcs, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    rows = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/data")
        .select("content").mapInArrow(run, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    )
    # one row a file: its total, and what stands before it
    totals = _file_totals(spark, folder)
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(totals, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _file_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Number of ids in each file, from headers and indexes; nothing is decompressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                parts, total = [], 0
                for block in blocks(content.as_buffer()):
                    parts, total = [block.part], total + int(block.index["n"].sum())
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([total] * len(parts), pa.int64())], ["part", "total"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/data")
    return files.select("content").mapInArrow(run, "part int, total long")


def round_trip(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Writes the documents' ids to a new shared folder and reads them back."""
    folder = shared_folder(documents.sparkSession, "token-files")
    write_token_files(documents, folder, tokenizer_path)
    return read_token_files(documents.sparkSession, folder)
