"""Equi-joins in which a few keys may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy from one in this many rows on, so that many keys at most are heavy.
SHARE = 1024


def join_heavy(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which holds each key once; nulls match nothing.

    ``weight`` is a column of ``table`` that sums up, over all of it, to ``total`` at most and bounds the
    rows of the key. Of the keys with more than ``total / SHARE`` there are fewer than ``SHARE``: these are
    broadcast, so that their rows stay where they are. The other keys' rows are shuffled, none of
    them more than that share. ``rows`` and ``table`` are read twice and should be stored.
    """
    keys = list(keys)
    heavy = F.col(weight) * F.lit(SHARE) > F.lit(total)
    top = table.where(heavy)
    near = rows.join(F.broadcast(top), keys)
    far = rows.join(F.broadcast(top.select(*keys)), keys, "left_anti").join(table.where(~heavy), keys)
    return near.unionByName(far)
