"""Operator 12: lines that many documents share.

Texts are exploded into lines; a line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at
both ends, A-Z in lower case. Keys of at least ``min_chars`` code points are hashed (16 bytes of
SHA-256), the distinct documents of each hash are counted, and hashes found in ``min_documents`` or more
lose all their lines but for those of the largest ``doc_id`` that holds them. What is dropped comes
back to each document as positions, and the text is put together again from the others.

What is shuffled is hashes, ids and positions of long enough lines; texts only to meet their own positions,
and not at all when these are few enough to be broadcast by measured size. Distinct (hash, document)
pairs are settled before they are counted, and counts are added within a task first, so a line that a third of
the documents share meets no single task; its rows are joined by broadcast (see ``skewed``). Positions
are collected per text, never per line.

Everything is a DataFrame expression. Lines are stored once under ``spark.checkpoint.dir``; a text is known by its id and
SHA-256 from there on, so nothing hangs on the numbering of rows in a second scan.

Defined cases: a null or empty text has one empty line; rows with one id are one document, all of whose
lines stay if it is the largest; a null id is a document of its own (all rows without id together) and
smaller than any other; repeated rows are kept, each with the same result; ``\\r`` belongs to its line and
counts as white space; further columns are kept by :func:`drop_shared_lines` and may have any name; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.skewed import join_heavy
from tallyspan.llm.staging import staged

MIN_CHARS = 40
MIN_DOCUMENTS = 5

# White space of a line's ends, and the letters that are folded.
_SPACE = " \t\n\v\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _digest(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


def _texts(documents: DataFrame) -> DataFrame:
    """``id``, ``text`` without nulls, and the text's digest: what tells texts of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).withColumn("sha", _digest(F.col("text")))


def shared_positions(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``id``, ``sha`` and ``dropped`` (positions from 0) of each text that loses lines."""
    # keys are made before the explode: a filter on them would be pushed below a projection and make them twice
    keys = F.transform(lines_of(F.col("text")), line_key)
    exploded = _texts(documents).select("id", "sha", F.posexplode(keys).alias("at", "key"))
    long_enough = exploded.where(F.char_length("key") >= min_chars)
    lines = staged(long_enough.select("id", "sha", "at", _digest(F.col("key")).alias("hash")), "line-hashes")

    pairs = lines.groupBy("hash", "id").agg(F.count(F.lit(1)).alias("n"))
    counted = pairs.groupBy("hash").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n").alias("n_lines"), F.max("id").alias("stays")
    )
    shared = staged(counted.where(F.col("documents") >= min_documents).select("hash", "n_lines", "stays"), "shared-lines")
    total = shared.agg(F.sum("n_lines")).first()[0] or 0
    found = join_heavy(lines, shared, ["hash"], "n_lines", total).where(~F.col("id").eqNullSafe(F.col("stays")))
    # rows that are repeated whole give each position more than once
    return found.groupBy("id", "sha").agg(F.collect_set("at").alias("dropped"))


def _reassembled(lines: Column, dropped: Column) -> Column:
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    return F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n")


def deduplicated(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per document: ``row`` (its columns), ``n_lines``, ``n_dropped`` and ``kept_text``."""
    dropped = staged(shared_positions(documents, min_chars, min_documents), "dropped-lines")
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("doc_id").cast("long").alias("id"),
    ).withColumn("sha", _digest(F.col("text")))
    both = rows.alias("r").join(
        dropped.alias("d"), F.col("r.id").eqNullSafe(F.col("d.id")) & (F.col("r.sha") == F.col("d.sha")), "left"
    )
    lines = lines_of(F.col("r.text"))
    return both.select(
        "r.row",
        F.size(lines).alias("n_lines"),
        F.coalesce(F.size("d.dropped"), F.lit(0)).alias("n_dropped"),
        F.when(F.col("d.dropped").isNull(), F.col("r.text")).otherwise(_reassembled(lines, F.col("d.dropped"))).alias("kept_text"),
    )


def line_digests(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per document: lines before, lines dropped, and the digest of what stays."""
    made = deduplicated(documents.select("doc_id", "text"), min_chars, min_documents)
    return made.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_dropped").cast("long").alias("n_dropped"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def drop_shared_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents with what stays of their texts; all columns are kept. A text that loses nothing stays as it
    is, null included."""
    made = deduplicated(documents, min_chars, min_documents)
    text = F.when(F.col("n_dropped") == 0, F.col("row.text")).otherwise(F.col("kept_text"))
    return made.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
