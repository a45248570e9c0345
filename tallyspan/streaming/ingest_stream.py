"""Ingest of files as they arrive.

The table is the only state, so there is no watermark. The newest commit says which batch of each
query came last, so one that is replayed after a failure is not applied again, and finding that out reads
one commit however many there are. A query is known by its id, which a new checkpoint makes anew even
at a path used before.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspan.operators.clean import MALFORMED
from tallyspan.plans.pipeline import load_rows, utc_now
from tallyspan.schema import FILE_COLUMNS
from tallyspan.sources.csv_files import csv_options, text_schema, with_position
from tallyspan.sources.fact_table import has_tag


def ingest_stream(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    max_files: int = 1000,
    on_error: str = "fail",
    blank: str = "zero",
    clock: Callable[[], dt.datetime] = utc_now,
    rejects_path: str | None = None,
    source: str | None = None,
    multi_line: bool = False,
    grain: str = "month",
) -> StreamingQuery:
    """Upsert every new file of ``folder`` and stop when there is none left.

    With ``on_error="reject"`` each micro-batch has its own folder of rejects under
    ``rejects_path``, written again if the batch is replayed.

    ``source`` stands in for the name of the file, ``multi_line`` allows line breaks in quoted fields,
    and ``grain`` counts when the first batch makes the table.

    Files must have exactly the ten input columns, in order; any other header fails the query.
    """
    if on_error == "reject" and not rejects_path:
        raise ValueError("on_error='reject' needs a rejects_path, or the rows would be lost")
    rows = (
        spark.readStream.schema(text_schema(list(FILE_COLUMNS)))
        .options(**csv_options(multi_line))
        .option("maxFilesPerTrigger", max_files)
        .csv(folder)
        .select(
            *FILE_COLUMNS,
            MALFORMED,
            F.col("_metadata.file_name").alias("_file"),
            F.col("_metadata.file_modification_time").alias("_time"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_start"),
        )
    )

    # Made with the checkpoint, so it is there when the first batch comes, and stays.
    known: dict[str, str] = {}

    def apply(batch: DataFrame, batch_id: int) -> None:
        query_id = known.get("id") or known.setdefault("id", _query_id(batch.sparkSession, checkpoint))
        tag = f"{query_id}#{batch_id}"
        if not has_tag(batch.sparkSession, table, tag):
            load_rows(
                with_position(batch),
                table,
                clock(),
                source,
                on_error=on_error,
                blank=blank,
                rejects_path=rejects_path,
                rejects_folder=f"query={query_id}/batch={batch_id}",
                tag=tag,
                grain=grain,
            )

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when it made the checkpoint."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True)
    return json.loads(lines.first()["value"])["id"]
