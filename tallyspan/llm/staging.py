"""Tables written to the shared folder: they cut lineage and survive a lost executor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.session import shared_folder


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of a batch that is handed to Python and back.
BATCH_BYTES = 4 << 20


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` with batches bounded in bytes, however long the texts are.

    Buffers of a batch lie outside the JVM's heap and are there twice. A bound that the session
    has set itself stays.
    """
    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def bounded_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_BYTES)


def boxed(documents: DataFrame, **more) -> DataFrame:
    """The rows as one column ``row``, so that whatever is added beside it clashes with no name of theirs."""
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])


def unboxed(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


#: Keys (of eight bytes) that a broadcast may hold at most.
BROADCAST_KEYS = 1 << 20


def with_keys(df: DataFrame, keys: DataFrame, name: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``name`` is among the distinct ``keys``; a shuffled join if they are many.

    ``keys`` must be cheap to count, such as a staged table.
    """
    keys = keys.select(name).distinct()
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if small else keys, name, how)
