"""Provenance and size checks. Each is one aggregate with partial sums before its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.dates import round_to_second


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def load_batches(df: DataFrame) -> DataFrame:
    """Rows per load, a load being a load time rounded to the second; newest first."""
    return (
        df.groupBy(round_to_second(F.col("load_date")).alias("load_batch"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("load_batch").desc_nulls_first())
    )


def file_provenance(df: DataFrame) -> DataFrame:
    """First load, last load and rows per source file, latest first."""
    return (
        df.groupBy(F.coalesce("source_file_name", F.lit("(null)")).alias("file"))
        .agg(
            F.min("load_date").alias("first_load"),
            F.max("load_date").alias("last_load"),
            F.count(F.lit(1)).alias("rows"),
        )
        .orderBy(F.col("last_load").desc_nulls_first())
    )
