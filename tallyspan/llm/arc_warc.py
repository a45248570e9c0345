"""Operator 4: conversion of legacy ARC archives to WARC.

An ARC file begins with a version block, whose last line names the fields of all record headers of that
file; version 1 has five, version 2 ten. A record is one header line and as many bytes as it declares. From
these the converter makes the WARC headers: an identifier (a name-based UUID), the timestamp in ISO
form, the type by the content, the address, and SHA-1 digests of block and payload; the version block becomes
the file's warcinfo record, which the others name. Of records with equal payloads the one with the largest page id
keeps it; the others become revisits of it.

The archives are parsed once: what a WARC record needs is stored under ``spark.checkpoint.dir``, identifiers
included, so they cannot come out differently when an executor is lost. WARC files are written by Spark's own
writer, a record a row and the blank lines between records as separator, so they may lie wherever Spark can
write. They are read back as binary files, record by record along the declared lengths. One payload that a third of
all pages share meets in no task: digests are counted before they are shuffled and joined by broadcast.

Damaged archives: a header line with too few fields, no date or no length, a record that ends early, and one that
does not have its version 2 checksum. ``on_damage="fail"`` raises ``ValueError``; ``"skip"`` leaves the record out,
goes on at the next line that is a header, and :func:`damaged_records` lists what was left out. Spaces in a content type
belong to it.

Defined cases: a null html is an empty payload; a null url becomes ``about:blank`` and white space in urls is
escaped; a null page id counts as the smallest; of rows repeated with their id one is the response; an empty
table gives files without records; further columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.skewed import join_heavy
from tallyspan.llm.staging import map_arrow, staged
from tallyspan.session import shared_folder

#: Bytes of records after which an ARC file is closed, when pages are written as ARC.
ARC_BYTES = 1 << 20
#: Revisits that a broadcast may hold at most (about 100 bytes each).
BROADCAST_REVISITS = 1 << 17
#: Equal payloads are revisits from this many bytes on.
REVISIT_BYTES = 0

# The field lines of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_SEPARATOR = "\r\n\r\n"


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 tallyspan\n{ARC_FIELDS[version]}\n\n".encode()
    rest = {1: "", 2: f"200 - - 0 {name} "}[version]
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {rest}{len(body)}\n".encode() + body


def arc_record(version: int, url: str, date: str, body: bytes, name: str, offset: int) -> bytes:
    rest = ""
    if version == 2:
        rest = f"200 {hashlib.md5(body).hexdigest()} - {offset} {name} "
    return f"{url} 0.0.0.0 {date} text/html {rest}{len(body)}\n".encode() + body + b"\n"


def _line(content: bytes, at: int) -> tuple[str, int]:
    end = content.find(b"\n", at)
    end = len(content) if end < 0 else end
    return content[at:end].decode("utf-8", "replace"), end + 1


def _fields(line: str, version: int) -> dict[str, str]:
    """A header line by field. All fields but the content type are single words."""
    names, words = ARC_FIELDS[version].split(" "), line.split(" ")
    spaces = len(words) - len(names)
    if spaces < 0:
        raise ValueError("too few fields")
    words[3 : 4 + spaces] = [" ".join(words[3 : 4 + spaces])]
    header = dict(zip(names, words, strict=True))
    if not (header["Archive-date"].isdigit() and header["Archive-length"].isdigit()):
        raise ValueError("no date or no length")
    return header


def version_block(content: bytes) -> tuple[int, dict[str, str], bytes, int]:
    """Version, header fields and bytes of a file's first record, and where the next one begins."""
    first, at = _line(content, 0)
    if not first.startswith("filedesc://"):
        raise ValueError("an ARC file begins with filedesc://")
    # the block's own header is as long as the version's that it declares below
    body = content[at : at + int(first.rsplit(" ", 1)[1])]
    version, fields = body.decode("utf-8", "replace").split("\n")[:2]
    number = version.split(" ")[0]
    if not number.isdigit() or ARC_FIELDS.get(int(number)) != fields:
        raise ValueError(f"unknown ARC version or fields: {version!r}, {fields!r}")
    return int(number), _fields(first, int(number)), body, at + len(body)


def _next_header(content: bytes, at: int, version: int) -> int:
    """Where the first line from ``at`` on begins that is a header of an address."""
    while at < len(content):
        line, after = _line(content, at)
        try:
            if "://" in _fields(line, version)["URL"]:
                return at
        except ValueError:
            pass
        at = after
    return at


def parse_arc(content: bytes, damage: list[tuple[int, str, str]] | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and bytes of each record after the version block. The first damaged record raises
    ``ValueError``, or is put into ``damage`` as (offset, reason, header line)."""
    version, _, _, at = version_block(content)
    while at < len(content):
        if content[at : at + 1] == b"\n":
            at += 1
            continue
        line, begin = _line(content, at)
        try:
            header = _fields(line, version)
            end = begin + int(header["Archive-length"])
            if end > len(content):
                raise ValueError("record ends early")
            body, checksum = content[begin:end], header.get("Checksum", "-")
            if checksum != "-" and hashlib.md5(body).hexdigest() != checksum.lower():
                raise ValueError("checksum differs")
        except ValueError as e:
            if damage is None:
                raise ValueError(f"{e}: {line!r}") from e
            damage.append((at, str(e), line))
            at = _next_header(content, begin, version)
            continue
        yield header, body
        at = end


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(arc_date: str) -> str:
    """14 digits, or fewer of an older archive, as an ISO instant."""
    d = (arc_date + "00000101000000"[len(arc_date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def pages_to_arc(pages: DataFrame) -> DataFrame:
    """``content``: ARC files of both versions with one record per page; its id is an HTTP header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, size, version, name = TaskContext.get().partitionId(), 0, [], 0, 1, ""
        for batch in batches:
            for page_id, url, html in zip(*batch.columns, strict=True):
                if not out:
                    version, name = 1 + number % 2, f"part-{part:05d}-{number:05d}.arc"
                    out = [arc_version_block(version, name, "20240101000000")]
                    size, number = len(out[0]), number + 1
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                own = f"X-Page-Id: {page_id.as_py()}\r\n" if page_id.is_valid else ""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n"
                target = "%20".join((url.as_py() if url.is_valid else "").split()) or "about:blank"
                out.append(arc_record(version, target, "20240101000000", head.encode() + payload, name, size))
                size += len(out[-1])
                if size >= ARC_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["content"])
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["content"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_arrow(rows, run, "content binary")


_RECORD = "record_id string, kind string, info_id string, page_id long, url string, ip string, date string, head binary, payload binary, digest string"
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))


def _urn(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts)))}>"


def _damage(on_damage: str) -> list | None:
    if on_damage not in ("fail", "skip"):
        raise ValueError(f"on_damage must be 'fail' or 'skip', not {on_damage!r}")
    return None if on_damage == "fail" else []


def read_arc(arcs: DataFrame, on_damage: str = "fail") -> DataFrame:
    """The records of ARC files (``content``), with what a WARC header needs; ``kind`` is ``warcinfo`` for a
    version block, ``http`` for a message and ``resource`` for anything else. Store it before it is used twice:
    the identifiers hold the number of the task."""
    _damage(on_damage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for content in batch.column(0):
                content = content.as_buffer().to_pybytes()
                _, first, block, _ = version_block(content)
                info = _urn(first["URL"], part, number)
                rows = [(info, "warcinfo", None, None, first["URL"], first["IP-address"], iso_date(first["Archive-date"]), b"", block, sha1(block))]
                for header, body in parse_arc(content, _damage(on_damage)):
                    head, found, payload = body.partition(b"\r\n\r\n")
                    kind = "http" if body.startswith(b"HTTP/") and found else "resource"
                    if kind == "resource":
                        head, payload = b"", body
                    lines = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
                    page_id, digest = lines.get("X-Page-Id"), sha1(payload)
                    own = _urn(header["URL"], header["Archive-date"], page_id, digest, part, number)
                    date = iso_date(header["Archive-date"])
                    rows.append((own, kind, info, page_id and int(page_id), header["URL"], header["IP-address"], date, head, payload, digest))
                    number += 1
                yield _arrow(rows, _RECORD)

    return map_arrow(arcs, run, _RECORD)


def damaged_records(arcs: DataFrame) -> DataFrame:
    """``file`` (by its version block), ``offset``, ``reason`` and ``header`` of what ``on_damage="skip"`` leaves out."""
    schema = "file string, offset long, reason string, header string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                content, damage = content.as_buffer().to_pybytes(), []
                for _ in parse_arc(content, damage):
                    pass
                if damage:
                    yield _arrow([(version_block(content)[1]["URL"], *d) for d in damage], schema)

    return map_arrow(arcs, run, schema)


def find_revisits(records: DataFrame) -> DataFrame:
    """``record_id, refers_to`` of the records whose payload another record keeps. ``records`` should be stored."""
    rows = records.where(F.col("kind") != "warcinfo").where(F.octet_length("payload") >= REVISIT_BYTES)
    rows = rows.select("record_id", "page_id", "digest")
    top = rows.groupBy("digest").agg(F.max(F.struct("page_id", "record_id")).alias("top"), F.count(F.lit(1)).alias("n"))
    top = staged(top.where("n > 1"), "warc-payloads")
    total = top.agg(F.sum("n")).first()[0] or 0
    found = join_heavy(rows, top, ["digest"], "n", total).where("record_id <> top.record_id")
    return staged(found.select("record_id", F.col("top.record_id").alias("refers_to")), "warc-revisits")


def warc_record(
    record_id: str, kind: str, info_id: str | None, url: str, ip: str, date: str, head: bytes, payload: bytes, digest: str, refers_to: str | None
) -> bytes:
    """One record without the blank lines after it."""
    separator = _SEPARATOR.encode()
    body = b"" if refers_to else payload
    block = head + separator + body if head else body
    type_ = "warcinfo" if kind == "warcinfo" else "revisit" if refers_to else "response" if head else "resource"
    lines = ["WARC/1.1", f"WARC-Type: {type_}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    if kind == "warcinfo":
        content = "text/plain"
        lines.append(f"WARC-Filename: {url.removeprefix('filedesc://')}")
    else:
        content = "application/http; msgtype=response" if head else "text/html"
        lines += [f"WARC-Target-URI: {url}", f"WARC-IP-Address: {ip}", f"WARC-Warcinfo-ID: {info_id}"]
        if refers_to:
            lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers_to}"]
        lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    lines += [f"WARC-Block-Digest: sha1:{sha1(block)}", f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + separator + block


def write_warc(records: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Writes the records to WARC files under ``folder``, revisits without their payload; ``compression`` is ``gzip`` or
    ``none``. ``records`` should be stored."""
    revisits = find_revisits(records)
    small = revisits.limit(BROADCAST_REVISITS + 1).count() <= BROADCAST_REVISITS
    joined = records.join(F.broadcast(revisits) if small else revisits, "record_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, size = [], 0
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made.append(warc_record(*row))
                size += len(made[-1])
                if size >= ARC_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["content"])
                    made, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["content"])

    columns = ("record_id", "kind", "info_id", "url", "ip", "date", "head", "payload", "digest", "refers_to")
    made = map_arrow(joined.select(*columns), run, "content binary")
    made.select(F.col("content").cast("string")).write.option("lineSep", _SEPARATOR).text(folder, compression=compression)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file, compressed or not."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at, separator = 0, _SEPARATOR.encode()
    while at < len(content):
        end = content.index(separator, at)
        first, *lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        header = dict(x.split(": ", 1) for x in lines)
        begin = end + len(separator)
        at = begin + int(header["Content-Length"])
        yield header, content[begin:at]
        at += len(separator)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``record_id, record_type, refers_to, page_id, payload_bytes, payload_digest`` of all records but the
    warcinfo ones, digests verified."""
    schema = "record_id string, record_type string, refers_to string, page_id long, payload_bytes long, payload_digest string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for header, block in parse_warc(content.as_buffer().to_pybytes()):
                    if sha1(block) != header["WARC-Block-Digest"].removeprefix("sha1:"):
                        raise ValueError(f"block of {header['WARC-Record-ID']} is damaged")
                    if header["WARC-Type"] == "warcinfo":
                        continue
                    head, _, payload = block.partition(_SEPARATOR.encode()) if block.startswith(b"HTTP/") else (b"", b"", block)
                    lines = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:])
                    page_id, kind = lines.get("X-Page-Id"), header["WARC-Type"]
                    own = kind != "revisit"
                    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
                    if own and sha1(payload) != digest:
                        raise ValueError(f"payload of {header['WARC-Record-ID']} is damaged")
                    rows.append((header["WARC-Record-ID"], kind, header.get("WARC-Refers-To"), page_id and int(page_id), len(payload) if own else None, digest))
                if rows:
                    yield _arrow(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages through ARC to WARC files in a new shared folder, and read back from these."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_warc(staged(read_arc(pages_to_arc(pages)), "warc-records"), folder)
    rows = staged(read_warc(spark, folder), "warc-rows")
    again = rows.where("record_type = 'revisit'").select("refers_to", "page_id", "payload_digest", "record_type")
    kept = rows.where("record_type <> 'revisit'")
    # a payload that many pages share: its record is looked up by many revisits
    counts = again.groupBy("refers_to").agg(F.count(F.lit(1)).alias("n"))
    named = kept.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to"), "payload_bytes")
    named = staged(named.join(counts, "refers_to"), "warc-referred")
    total = named.agg(F.sum("n")).first()[0] or 0
    again = join_heavy(again, named, ["refers_to"], "n", total)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type")
    return kept.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        again.select(*columns, F.col("to").alias("refers_to"))
    )
