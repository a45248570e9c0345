"""Results as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.kpi import METRICS


def metrics_json(df: DataFrame) -> DataFrame:
    """The rows of a metrics result as one JSON array, sorted by metric, NULLs written out.

    For the ungrouped results only, which have one row per metric; write a grouped result with
    :func:`write_json`, which stays distributed. Numbers are written as plain decimals.
    """
    if df.columns[0] != "metric" or len(df.columns) != 1 + len(METRICS.names):
        raise ValueError("expected an ungrouped metrics result")
    row = F.struct(
        "metric", *[F.col(c).cast("decimal(38,4)").alias(c) for c in df.columns[1:]]
    )
    rows = F.array_sort(F.collect_list(row))
    return df.agg(F.to_json(rows, {"ignoreNullFields": "false"}).alias("response"))


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per line, NULLs written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
