"""Operator 2: BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over 32 bytes cuts each text where the hash says so, hence equal passages of
different texts give equal chunks. A worker encodes each distinct chunk once and keeps its ids in a
bounded cache. At each join of two chunks a window of the pieces around it is encoded again; it is
accepted when a piece boundary of the window falls on a boundary of the right chunk, from where on
both splits must agree. A window that does not agree is widened, at last to the whole text.

Nothing is shuffled: each scan partition is encoded where it is read.

Defined cases: a null text counts as empty and gives no ids; repeated rows and rows with equal or
null ``doc_id`` each give a row; an empty table gives an empty result; columns other than the id and
the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm import bpe
from tallyspan.llm.arrays import Hasher, slices
from tallyspan.llm.staging import map_arrow

#: A cut falls on one in so many bytes; the rolling hash covers ``ROLL`` bytes.
CHUNK_BYTES = 1024
ROLL = 32
#: Pieces on either side of a join that are encoded again, at first and when that fails.
WIDTHS = (3, 12)
#: Bytes of chunks kept by a worker before its cache starts afresh.
CACHE_BYTES = 24 << 20

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def cuts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of all chunks: the text starts, and where the rolling hash is a multiple."""
    rolled = Hasher(buf).grams(ROLL)
    at = np.flatnonzero(rolled & np.uint64(CHUNK_BYTES - 1) == 0) + ROLL
    text = np.searchsorted(offsets, at - ROLL, "right") - 1
    at = at[at < offsets[text + 1]]  # the hashed bytes and the cut lie in one text
    at = at[(buf[at] & 0xC0) != 0x80]  # never inside a character
    return np.union1d(at, offsets[:-1][np.diff(offsets) > 0])


class Chunk:
    __slots__ = ("ids", "starts", "tokens", "text")

    def __init__(self, encoded: bpe.Encoded, k: int):
        a, b = encoded.first[k], encoded.first[k + 1]
        base, first = int(encoded.offsets[k]), int(encoded.tokens[a])
        self.text = encoded.text(k)
        self.starts = (encoded.starts[a:b] - base).tolist()
        self.tokens = (encoded.tokens[a : b + 1] - first).tolist()
        self.ids = encoded.flat[first : first + self.tokens[-1]].copy()


class ChunkEncoder:
    def __init__(self, codec: bpe.Codec):
        self.codec, self.cache, self.held = codec, {}, 0
        self.encoded = self.reused = 0

    def _encode(self, texts: list[bytes]) -> bpe.Encoded:
        buf = np.frombuffer(b"".join(texts), np.uint8)
        return self.codec.encode(buf, np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64))

    def _chunks(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[Chunk]:
        keys = list(zip(Hasher(buf).spans(starts, ends).tolist(), (ends - starts).tolist(), strict=True))
        wanted = {key: k for k, key in enumerate(keys) if key not in self.cache}
        if self.held > CACHE_BYTES:
            self.cache, self.held = {}, 0
            wanted = {key: k for k, key in enumerate(keys)}
        if wanted:
            made = self._encode([buf[starts[k] : ends[k]].tobytes() for k in wanted.values()])
            for k, key in enumerate(wanted):
                self.cache[key] = Chunk(made, k)
                self.held += 12 * key[1]
        self.encoded += len(wanted)
        self.reused += len(keys) - len(wanted)
        return [self.cache[key] for key in keys]

    def _windows(self, joins: list[tuple[Chunk, Chunk]], width: int) -> list[tuple | None]:
        """For each join (window ids, first left token replaced, first right token kept), or None."""
        fit = [min(len(a.starts), len(b.starts)) >= 2 * width + 2 for a, b in joins]
        texts, sides = [], []
        for (a, b), ok in zip(joins, fit, strict=True):
            if ok:
                left = a.text[a.starts[-width] :]
                texts.append(left + b.text[: b.starts[width]])
                sides.append((len(left), a, b))
        if not texts:
            return [None] * len(joins)
        made = self._encode(texts)
        found = []
        for k, (left, a, b) in enumerate(sides):
            p, q = int(made.first[k]), int(made.first[k + 1])
            base = int(made.offsets[k])
            own = {int(s) - base: n for n, s in enumerate(made.starts[p:q].tolist())}
            agreed = next(((j, own[left + b.starts[j]]) for j in range(width - 1, -1, -1) if left + b.starts[j] in own), None)
            if agreed is None:
                found.append(None)
                continue
            j, n = agreed
            found.append((made.flat[made.tokens[p] : made.tokens[p + n]], a.tokens[len(a.starts) - width], b.tokens[j]))
        found = iter(found)
        return [next(found) if ok else None for ok in fit]

    def slice(self, buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[list[int], bytes]]:
        """Ids and decoded bytes of each text."""
        starts = cuts(buf, offsets)
        chunks = self._chunks(buf, starts, np.append(starts[1:], len(buf)))
        first = np.searchsorted(starts, offsets)
        _, odd = bpe.pieces(buf, offsets)
        joins = [k for d in range(len(offsets) - 1) for k in range(first[d], first[d + 1] - 1)]
        repaired = dict.fromkeys(joins)
        for width in WIDTHS:
            open_ = [k for k in joins if repaired[k] is None]
            got = self._windows([(chunks[k], chunks[k + 1]) for k in open_], width)
            repaired.update(zip(open_, got, strict=True))
        for d in range(len(offsets) - 1):
            text = buf[offsets[d] : offsets[d + 1]].tobytes()
            part = range(first[d], first[d + 1])
            if not text:
                yield [], b""
                continue
            if not odd[d] and all(repaired[k] is not None for k in part[:-1]):
                if not any(s in text for s in self.codec.specials):
                    ids = self._stitched(chunks, repaired, part).tolist()
                    if (back := self.codec.decode(ids)) == text:
                        yield ids, back
                        continue
            yield self._encode([text]).ids(0)

    @staticmethod
    def _stitched(chunks: list[Chunk], repaired: dict, part: range) -> np.ndarray:
        out, begin = [], 0
        for k in part:
            if k == part[-1]:
                out.append(chunks[k].ids[begin:])
            else:
                window, left_end, right_begin = repaired[k]
                out += [chunks[k].ids[begin:left_end], window]
                begin = right_begin
        return np.concatenate(out)


def encode_documents(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """``doc_id``, ids as ``array<int>`` and the decoded text of each document."""
    return _mapped(documents, tokenizer_path, "doc_id long, ids array<int>, decoded string", _full_row)


def token_digests(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """The number of ids of each document and digests of ids and decoded text."""
    return _mapped(documents, tokenizer_path, RESULT, _digest_row)


def _full_row(codec: bpe.Codec, ids: list[int], back: bytes) -> tuple:
    return ids, back.decode()


def _digest_row(codec: bpe.Codec, ids: list[int], back: bytes) -> tuple:
    joined = ",".join(map(codec.decimals.__getitem__, ids))
    return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(back).hexdigest()


def _mapped(documents: DataFrame, path: str | None, schema: str, row) -> DataFrame:
    path = path or bpe.default_path()
    kept = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [c.split()[0] for c in schema.split(", ")]
    out_types = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [out_types[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec(path)
        encoder = ChunkEncoder(codec)
        for batch in batches:
            for a, b, buf, offsets in slices(batch.column(1)):
                rows = [row(codec, *x) for x in encoder.slice(buf, offsets)]
                columns = [batch.column(0).slice(a, b - a), *(pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types[1:], strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(kept, run, schema)
