"""Delimited input files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators.clean import MALFORMED
from tallyspan.schema import FILE_COLUMNS, SEQ

_OPTIONS = {
    "header": True,
    "sep": ",",
    "encoding": "UTF-8",
    # A quote inside a quoted field is written twice.
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])


def csv_options(multi_line: bool = False) -> dict:
    """Reader options. Every file's header is checked against the schema, so a file with other
    columns or another column order fails instead of being misread."""
    return _OPTIONS | {
        "enforceSchema": False,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
        "multiLine": multi_line,
    }


def read_ads_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, by_name: bool = False
) -> DataFrame:
    """The ten input columns as text, by header name, with the file name (``_file``), the row's
    position (``_seq``) and the raw line where it was malformed (``_malformed``).

    Only the header of one file is read ahead, and a file with another one fails. With ``by_name``
    files may have their columns in different orders, and further columns of their own: the headers
    are gathered in a distributed pass over the lines, without parsing them, and the files of each
    header get a reader. ``multi_line`` is needed for line breaks inside quoted
    fields, and costs the splitting of large files.
    """
    if by_name:
        groups = headers(spark, path)
    else:
        groups = {tuple(spark.read.options(**_OPTIONS, multiLine=multi_line).csv(path).columns): path}
    for header in groups:
        missing = [c for c in FILE_COLUMNS if c not in header]
        if missing:
            of = f" (in {groups[header][0]})" if by_name else ""
            raise ValueError(f"columns missing from the input{of}: {', '.join(missing)}")
    if not groups:
        return spark.createDataFrame([], text_schema([*FILE_COLUMNS])).selectExpr(
            "*", "'' AS _file", "timestamp_ntz'1970-01-01' AS _time", "'' AS _path", "0L AS _start"
        ).transform(with_position)
    parts = [
        spark.read.schema(text_schema(list(header)))
        .options(**csv_options(multi_line))
        .csv(files)
        .selectExpr(*FILE_COLUMNS, MALFORMED, *_PLACE)
        for header, files in groups.items()
    ]
    return with_position(reduce(DataFrame.unionByName, parts))


def headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. A header is the first line of a file, so it lies in its first split.

    One small row for each file comes to the driver, as it does when files are listed. More than
    ``MOST_HEADERS`` different ones are refused, for each gets a reader of its own.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "line").alias("line"))
    reader = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _OPTIONS.items() if k != "header"}
    # The same reader options take the line apart, so quoted names come out as they do in the scan.
    names = F.from_csv(F.col("line"), F.lit(", ".join(f"c{k} string" for k in range(_MOST_COLUMNS))), reader)
    found = first.select("path", F.array(*[names[f"c{k}"] for k in range(_MOST_COLUMNS)]).alias("names"))
    found = found.select("path", "names", F.xxhash64("names").alias("kind"))
    kinds = found.groupBy("kind").agg(F.first("names").alias("names")).limit(MOST_HEADERS + 1).collect()
    if len(kinds) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    groups: dict[int, list[str]] = {}
    for row in found.select("kind", "path").sort("path").collect():
        groups.setdefault(row["kind"], []).append(row["path"])
    return {_header(row["names"]): groups[row["kind"]] for row in kinds}


def _header(names: list[str | None]) -> tuple[str, ...]:
    while names and names[-1] is None:
        names.pop()
    return tuple("" if n is None else n.removeprefix("\ufeff") for n in names)


#: Different headers that one load may have, and the columns of a file.
MOST_HEADERS, _MOST_COLUMNS = 200, 100

_PLACE = (
    "_metadata.file_name AS _file",
    "_metadata.file_modification_time AS _time",
    "_metadata.file_path AS _path",
    "_metadata.file_block_start AS _start",
)


def with_position(rows: DataFrame) -> DataFrame:
    """``_seq`` from the file's time and path, offset of the split in it, and row number within
    the task. Ordered by it, rows come in the order the files arrived in, however they were
    split or dealt to micro-batches."""
    position = F.struct(
        F.col("_time").alias("time"),
        F.col("_path").alias("path"),
        F.col("_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.withColumn(SEQ, position).drop("_time", "_path", "_start")
