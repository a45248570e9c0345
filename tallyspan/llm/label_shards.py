"""Operator 5: sharding by balanced label propagation, under the law ``rows``.

Documents with equal texts are linked. All start in shards that differ by one row at most. In each round
every group of linked documents counts, by an aggregation, in which shards it stands; the members
elsewhere ask to move to the shard that holds most. Quotas keep the sizes: a move is paid by a move the other way,
either of a linked document that asks for it, or of one without links, which loses nothing. What the
quotas are is settled on the table of 40 times 40 counts; who moves, by exact ranks that
are made of counts per hash bucket and ranks within one, so that no task sees a whole shard or group. Groups of more
than a quarter of a shard are cut into pieces of that size first, each of which is kept together.

Defined cases: a null text has 0 bytes and equals the empty text; repeated rows and null ids are documents of their
own; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.staging import staged

SHARDS = 40
ROUNDS = 6
#: A group is cut into pieces of this share of a shard.
PIECE = 4
OVERHEAD = 16
#: Rows of one bucket in which ranks are made.
BUCKET_ROWS = 20_000


def ranked(df: DataFrame, keys: list[str], n_rows: int, name: str = "rank") -> DataFrame:
    """Adds gapless ranks from 0 within ``keys``; ``row`` must be unique."""
    buckets = max(1, min(1 << 14, n_rows // BUCKET_ROWS))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    counts = df.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*keys, "_bucket", before.alias("_before"))
    inner = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy("row")) - 1
    return df.withColumn("_inner", inner).join(counts, [*keys, "_bucket"]).withColumn(name, F.col("_before") + F.col("_inner")).drop("_bucket", "_inner", "_before")


def quotas(asked: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many linked documents may move from shard to shard, and how many free ones then move.

    Both are tables of shards by shards; together they leave each shard as large as it was.
    """
    n = len(free)
    surplus = np.maximum(asked - asked.T, 0)
    need = surplus.sum(axis=0)
    share = np.minimum(1.0, free / np.maximum(need, 1))
    moves = np.minimum(asked, asked.T) + np.floor(surplus * share[None, :]).astype(np.int64)
    return moves, np.maximum(moves - moves.T, 0).T.reshape(n, n)


def _table(df: DataFrame, shards: int) -> np.ndarray:
    out = np.zeros((shards, shards), np.int64)
    for r in df.collect():  # at most shards * shards rows
        out[r[0], r[1]] = r[2]
    return out


def _limits(table: np.ndarray) -> Column:
    """The entry of a table of shards by shards for the columns ``shard`` and ``target``."""
    flat = F.array(*(F.lit(int(x)) for x in table.ravel()))
    return F.element_at(flat, F.col("shard") * len(table) + F.col("target") + 1)


def propagate(rows: DataFrame, n_rows: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``row, shard`` of all rows; ``rows`` has ``row`` and ``group``, null for a document without links."""
    state = ranked(rows.withColumn("all", F.lit(0)), ["all"], n_rows).select("row", "group", (F.col("rank") % shards).cast("int").alias("shard"))
    state = staged(state, "shards")
    for _ in range(rounds):
        linked, loose = state.where("group is not null"), state.where("group is null")
        free = np.zeros(shards, np.int64)
        for r in loose.groupBy("shard").count().collect():  # at most shards rows
            free[r["shard"]] = r["count"]
        votes = linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
        open_ = F.element_at(F.array(*(F.lit(bool(x)) for x in free > 0)), F.col("shard") + 1)
        best = F.max(F.struct(open_.alias("open"), "n", F.xxhash64("group", "shard").alias("tie"), "shard"))
        whole = F.count(F.lit(1)) == 1
        top = votes.groupBy("group").agg(best.alias("b"), whole.alias("whole")).where("not whole").select("group", F.col("b.shard").alias("target"))
        wishes = staged(linked.join(top, "group").where("shard <> target"), "shard-wishes")
        asked = _table(wishes.groupBy("shard", "target").count(), shards)
        if not asked.sum():
            break
        moves, back = quotas(asked, free)
        moving = ranked(wishes, ["shard", "target"], n_rows).where(F.col("rank") < _limits(moves)).select("row", F.col("target").alias("to"))
        # free rows of a shard go, by their rank, to one shard after the other
        ends = np.cumsum(back, axis=1)
        bounds = F.element_at(F.array(*(F.array(*(F.lit(int(x)) for x in r)) for r in ends)), F.col("shard") + 1)
        leaving = ranked(loose, ["shard"], n_rows).withColumn("ends", bounds)
        leaving = leaving.withColumn("to", F.size(F.filter("ends", lambda e: e <= F.col("rank")))).where(F.col("to") < shards)
        moved = moving.unionByName(leaving.select("row", F.col("to").cast("int")))
        state = staged(state.join(moved, "row", "left").select("row", "group", F.coalesce("to", "shard").alias("shard")), "shards")
    return state


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The shard and slot of each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    size = (F.octet_length(text) + OVERHEAD).cast("long")
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("hash"),
    )
    rows = staged(rows, "shard-rows")
    n_rows = rows.count()
    key = ["hash", "size", "text_crc32"]
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    linked = staged(rows.join(groups, key).select("row", *key, "n"), "shard-links")
    piece = max(1, n_rows // (shards * PIECE))
    large = ranked(linked.where(F.col("n") > piece), key, n_rows).withColumn("piece", F.floor(F.col("rank") / piece))
    named = linked.where(F.col("n") <= piece).withColumn("piece", F.lit(0).cast("long")).unionByName(large.drop("rank"))
    named = named.select("row", F.xxhash64(*key, "piece").alias("group"))
    placed = propagate(rows.select("row").join(named, "row", "left"), n_rows, shards)
    slots = ranked(placed.select("row", "shard"), ["shard"], n_rows, "slot")
    return rows.join(slots, "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
