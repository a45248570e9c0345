"""Keyed operators: dedupe, uniqueness check, upsert.

All three stay whole when one key holds a large share of the rows: what is shuffled per key
is at most one row (or one count) per map task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.dates import load_time
from tallyspan.schema import FACT_COLUMNS, NATURAL_KEY, SEQ

_HASH = "_hash"
# Tells rows apart that match nothing, not even each other.
_ALONE = "_alone"


def has_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _alone(keys: Sequence[str]) -> Column:
    """NULL for a complete key, else a number of the row's own. It only sets rows apart, and no
    result shows it."""
    return F.when(has_null(keys), F.monotonically_increasing_id())


def _key_group(keys: Sequence[str]) -> list[Column]:
    """What to group by: the key, led by a hash of it. Sorts by key then mostly compare one
    number in place of six columns, most of them text."""
    return [F.hash(*keys).alias(_HASH), *[F.col(k) for k in keys]]


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str] = NATURAL_KEY,
    order: Sequence[str] = ("load_date", SEQ),
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the one highest in the ``order`` columns (those of them there are),
    NULL being lowest. NULLs in the key count as equal.

    An aggregate rather than a ranking window: it settles each key within a map task before
    the shuffle, so a hot key does not end up in one reducer, and it sorts by key only.

    ``copies`` names a further column with the number of rows that the key had.
    """
    order = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    latest = df.groupBy(*_key_group(keys)).agg(F.max(F.struct(*order, *rest)).alias("_row"), *counted)
    return latest.select(
        *[
            F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
            for c in df.columns
            if c != SEQ
        ],
        *([copies] if copies else []),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """Keys held by more than one row, with the count. A key with a NULL equals no other."""
    return (
        df.filter(~has_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") > 1)
    )


def last_per_key(
    batch: DataFrame,
    batch_ts: dt.datetime,
    keys: Sequence[str] = NATURAL_KEY,
    columns: Sequence[str] = FACT_COLUMNS,
) -> DataFrame:
    """A batch reduced to the last row of each key; rows with a NULL in the key match nothing and all
    stay. ``load_date`` is ``batch_ts`` where a later row replaced an earlier one, else the row's own,
    else ``batch_ts``."""
    rest = [c for c in columns if c not in keys]
    rows = batch.withColumn(_ALONE, _alone(keys))
    latest = rows.groupBy(*_key_group([*keys, _ALONE])).agg(
        F.max(F.struct(SEQ, *rest)).alias("_last"), F.count(F.lit(1)).alias("_copies")
    )
    stamp = load_time(batch_ts)
    load_date = F.when(F.col("_copies") > 1, stamp).otherwise(
        F.coalesce(F.col("_last.load_date"), stamp)
    )
    return latest.select(
        *[
            load_date.alias(c)
            if c == "load_date"
            else (F.col(c) if c in keys else F.col(f"_last.{c}").alias(c))
            for c in columns
        ]
    )


def upsert(
    target: DataFrame,
    batch: DataFrame,
    batch_ts: dt.datetime,
    keys: Sequence[str] = NATURAL_KEY,
    by_range: bool = False,
    outcome: str | None = None,
) -> DataFrame:
    """``target`` after ``batch`` (which carries ``_seq``, the order of its rows).

    A new key is inserted. A known key takes over measures and file name and gets ``batch_ts``
    as its ``load_date``. The last of several rows with one key wins. A key with a NULL matches
    nothing: such rows are kept on both sides.

    The target must hold each complete key once; a second row with the same key fails the job.

    One union and one aggregate: each input is read once and shuffled once, a key's rows are
    settled within a task first, and a row with a NULL in its key is a group of its own, so that
    many of them meet in no task.

    ``by_range`` range-partitions that shuffle by the first key column and the key's hash, which
    leaves the result laid out for a write partitioned by that column, without a second shuffle. It
    costs a sampling pass, and the batch's own reduction, as a range shuffle settles nothing before it.

    ``outcome`` names a further column that says of each row whether it was ``inserted``, ``updated`` or
    ``kept``.
    """
    columns = list(FACT_COLUMNS)
    rest = [c for c in columns if c not in keys]
    stamp = load_time(batch_ts)
    order = batch.schema[SEQ].dataType

    known = target.select(*columns, F.lit(None).cast(order).alias(SEQ), F.lit(0).alias("_new"))
    if by_range:
        incoming = last_per_key(batch, batch_ts, keys, columns).withColumn(SEQ, F.lit(None).cast(order))
    else:
        incoming = batch.select(*columns, SEQ)
    both = known.unionByName(incoming.withColumn("_new", F.lit(1)))
    both = both.withColumn(_ALONE, _alone(keys))
    both = both.withColumn(_HASH, F.hash(*keys, _ALONE))
    grouping = [_HASH, *keys, _ALONE]
    if by_range:
        both = both.repartitionByRange(keys[0], _HASH)
        grouping = [keys[0], _HASH, *keys[1:], _ALONE]

    settled = both.groupBy(*grouping).agg(
        F.max(F.struct("_new", SEQ, *rest)).alias("_row"),
        F.sum(1 - F.col("_new")).alias("_known"),
        F.count(F.lit(1)).alias("_rows"),
    )
    clash = F.raise_error(
        F.concat(F.lit("target holds a key more than once: "), F.to_json(F.struct(*keys)))
    ).cast("boolean")
    replaced = F.when(F.col("_rows") > 1, stamp).otherwise(F.coalesce("_row.load_date", stamp))
    load_date = F.when(F.col("_row._new") == 1, replaced).otherwise(F.col("_row.load_date"))
    said = F.when(F.col("_row._new") == 0, "kept").when(F.col("_known") > 0, "updated").otherwise("inserted")
    return settled.filter(F.when(F.col("_known") > 1, clash).otherwise(F.lit(True))).select(
        *[
            F.col(c) if c in keys else (load_date if c == "load_date" else F.col(f"_row.{c}")).alias(c)
            for c in columns
        ],
        *([said.alias(outcome)] if outcome else []),
    )