"""The stored fact table: parquet in one folder per month (or day), replaced part by part.

``date`` is part of the natural key, so a batch can only touch the parts its dates fall into.
Each write goes to a new folder under ``data``; a row set under ``commits`` then names, for
every part, the folder that holds it. Readers follow the newest commit, so they see all of a
batch or nothing of it, a failed job leaves only an unreferenced folder behind, and the target
can be read while its successor is written. A commit is as long as the table has parts, and says
all there is to know: which batch of each stream came last, and which catalog tables show the table.
What a read or write costs does not depend on the number of commits before it.

Months suit tables up to some TB. With more, choose days when the table is first written: a
batch then rewrites less.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.numbers import finite_or_raise, split_amount
from tallyspan.schema import ADS_SPEND_SCHEMA, FACT_COLUMNS, SEQ

PART = "_part"
NO_DATE = "none"
# Name of a part: pattern, and length of the same text in an ISO date.
_GRAINS = {"day": ("yyyy-MM-dd", 10), "month": ("yyyy-MM", 7)}
_COMMIT_SCHEMA = (
    "grain string, part string, folder string, streams map<string, bigint>, published array<string>"
)


@dataclass(frozen=True)
class TableState:
    """What a commit says: the version, the grain, the folder of each part, the last batch of
    each stream, and the names of the catalog tables that follow it."""

    version: int = 0
    grain: str | None = None
    parts: dict[str, str] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)
    published: tuple[str, ...] = ()

    def part_of(self, day: dt.date | None) -> str:
        return NO_DATE if day is None else day.isoformat()[: _GRAINS[self.grain][1]]

    def overlapping(self, low: dt.date, high: dt.date) -> list[str]:
        """Parts that can hold a date between the two. Part names sort like dates."""
        first, last = self.part_of(low), self.part_of(high)
        return [p for p in self.parts if p != NO_DATE and first <= p <= last]


def part_column(grain: str) -> Column:
    return F.coalesce(F.date_format("date", _GRAINS[grain][0]), F.lit(NO_DATE))


def _commit_rows(spark: SparkSession, path: str, version: int) -> DataFrame | None:
    """One commit; None if there is none, or its file is not in place yet."""
    try:
        rows = spark.read.schema(_COMMIT_SCHEMA).parquet(f"{path}/commits/version={version}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows if rows.inputFiles() else None


def _newest_version(spark: SparkSession, path: str) -> int:
    """Versions follow each other without gaps, so the newest is found by doubling and halving:
    as many looks as its number has digits, twice, and no list of all that came before."""

    def there(version: int) -> bool:
        return _commit_rows(spark, path, version) is not None

    if not there(1):
        return _newest_listed(spark, path)
    high = 2
    while there(high):
        high *= 2
    low = high // 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if there(middle) else (low, middle)
    return low


def _newest_listed(spark: SparkSession, path: str) -> int:
    """For a table whose first commits were taken away."""
    try:
        files = spark.read.schema(_COMMIT_SCHEMA).parquet(f"{path}/commits").inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return max((int(re.search(r"/version=(\d+)/", f)[1]) for f in files), default=0)


def table_state(spark: SparkSession, path: str) -> TableState:
    """The newest commit; version 0 for a table that does not exist yet. No other commit is read."""
    newest = _newest_version(spark, path)
    if not newest:
        return TableState()
    rows = _commit_rows(spark, path, newest).collect()
    parts = {r["part"]: r["folder"] for r in rows if r["part"] is not None}
    first = rows[0]
    return TableState(
        newest, first["grain"], parts, dict(first["streams"] or {}), tuple(first["published"] or ())
    )


def _batch_of(tag: str) -> tuple[str, int]:
    """A tag is the name of a stream, ``#`` and the number of a batch; without one the batch is 0."""
    name, _, number = tag.partition("#")
    return name, int(number or 0)


def has_tag(spark: SparkSession, path: str, tag: str, state: TableState | None = None) -> bool:
    """Whether a write with this tag, or with a later batch of its stream, was already committed."""
    name, number = _batch_of(tag)
    return (state or table_state(spark, path)).streams.get(name, -1) >= number


def table_anchor(
    spark: SparkSession, path: str, state: TableState | None = None
) -> dt.date | None:
    """The newest date of the table, from the file footers of its newest part."""
    state = state or table_state(spark, path)
    dated = [p for p in state.parts if p != NO_DATE]
    return stored_bounds(spark, path, state, [max(dated)]).first()["newest"] if dated else None


def table_rows(spark: SparkSession, path: str, state: TableState | None = None) -> int:
    """The number of rows of the table, from its file footers."""
    state = state or table_state(spark, path)
    return stored_bounds(spark, path, state, state.parts).first()["rows"]


def stored_bounds(
    spark: SparkSession, path: str, state: TableState, parts: Collection[str]
) -> DataFrame:
    """``rows``, ``oldest`` and ``newest`` of some parts. No row is read: the counts and bounds that Parquet
    keeps in each file's footer are enough, and Spark's newer file reader takes aggregates from there. A
    session of its own has that reader on, so the caller's settings stay."""
    footers = spark.newSession()
    older = footers.conf.get("spark.sql.sources.useV1SourceList").split(",")
    footers.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in older if s != "parquet"))
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows, none = F.count(F.lit(1)).alias("rows"), F.lit(None).cast("date")
    dated = _scan(footers, path, state, [p for p in parts if p != NO_DATE])
    bounds = dated.agg(rows, F.min("date").alias("oldest"), F.max("date").alias("newest"))
    if NO_DATE in parts:
        # A file without any date has no bounds, and must not be asked for them.
        undated = _scan(footers, path, state, [NO_DATE])
        bounds = bounds.unionByName(undated.agg(rows).select("rows", none.alias("oldest"), none.alias("newest")))
        bounds = bounds.agg(F.sum("rows").alias("rows"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest"))
    return bounds


def daily_sums(
    spark: SparkSession,
    path: str,
    between: tuple[dt.date, dt.date] | None = None,
    state: TableState | None = None,
) -> DataFrame:
    """Spend and conversions of the table by day and platform, as every write leaves them beside the parts
    it makes. The reports take them in place of fact rows; they are as many as there are days and platforms,
    however large the table. With ``between``, only the parts that can hold dates of that range."""
    state = state or table_state(spark, path)
    parts = state.parts if between is None or not state.parts else state.overlapping(*between)
    if not parts:
        return spark.createDataFrame([], _SUMS_SCHEMA)
    folders = [f"{path}/sums/{state.parts[p]}/{PART}={p}" for p in parts]
    try:
        return spark.read.schema(_SUMS_SCHEMA).parquet(*folders)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # Parts that were written before there were sums.
        return _sums_of(read_parts(spark, path, state, parts), [])


_SUMS_SCHEMA = "date date, platform string, whole bigint, fraction double, conversions bigint, rows bigint"


def _sums_of(rows: DataFrame, by: list[str]) -> DataFrame:
    whole, fraction = split_amount("spend")
    return rows.groupBy(*by, "date", "platform").agg(
        F.expr(f"sum({whole}) AS whole"),
        F.expr(f"sum({fraction}) AS fraction"),
        F.expr("sum(conversions) AS conversions"),
        F.expr("count(*) AS rows"),
    )


def read_table(
    spark: SparkSession,
    path: str,
    between: tuple[dt.date, dt.date] | None = None,
    state: TableState | None = None,
) -> DataFrame:
    """The table; with ``between``, only the parts that can hold dates of that range (filter
    the dates as well). A missing table is an empty DataFrame."""
    state = state or table_state(spark, path)
    parts = state.parts if between is None or not state.parts else state.overlapping(*between)
    return read_parts(spark, path, state, parts)


def read_parts(
    spark: SparkSession, path: str, state: TableState, parts: Iterable[str]
) -> DataFrame:
    """Some parts of the table as of a given state; parts it does not have are left out."""
    return _scan(spark, path, state, parts).select(*FACT_COLUMNS)


def physical_order(
    spark: SparkSession, path: str, state: TableState, parts: Iterable[str]
) -> DataFrame:
    """:func:`read_parts` with ``_seq``, the place of each row in its file: the last resort for
    ordering rows that are otherwise tied."""
    place = F.struct(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row")
    )
    return _scan(spark, path, state, parts).select(*FACT_COLUMNS, place.alias(SEQ))


def _scan(spark: SparkSession, path: str, state: TableState, parts: Iterable[str]) -> DataFrame:
    folders = [part_folder(path, state, p) for p in parts if p in state.parts]
    if not folders:
        return spark.createDataFrame([], ADS_SPEND_SCHEMA)
    return spark.read.schema(ADS_SPEND_SCHEMA).parquet(*folders)


def write_parts(
    df: DataFrame,
    path: str,
    state: TableState,
    replaced: Iterable[str],
    tag: str | None = None,
    laid_out: bool = False,
    grain: str = "month",
    before_commit: Callable[[], None] | None = None,
) -> int:
    """Replace the given parts of the table by the rows of ``df`` and return the new version.

    ``state`` is the one ``df`` was made from; if another write came in between, this one fails.
    ``laid_out`` says that ``df`` already comes range-partitioned by date; otherwise it is
    rebalanced, which splits large parts over several files and puts small ones together.
    ``grain`` counts for a new table only. ``before_commit`` is called when the data is there; if it
    raises, the table stays as it was.
    """
    spark = df.sparkSession
    grain = state.grain or grain
    folder = uuid.uuid4().hex
    rows = df.select(*FACT_COLUMNS, part_column(grain).alias(PART))
    rows = rows.withColumn("spend", F.expr(finite_or_raise("spend")))
    if not laid_out:
        rows = rows.hint("rebalance", F.col(PART))
    rows.write.partitionBy(PART).parquet(f"{path}/data/{folder}")
    if before_commit:
        before_commit()

    gone = set(replaced)
    parts = {p: f for p, f in state.parts.items() if p not in gone}
    written = _written_parts(spark, f"{path}/data/{folder}")
    clash = sorted(written & parts.keys())
    if clash:
        raise ValueError(f"rows for parts not meant to be replaced: {', '.join(clash)}")
    stored = spark.read.schema(f"{_schema_text()}, {PART} string").option("basePath", f"{path}/data/{folder}")
    sums = _sums_of(stored.parquet(f"{path}/data/{folder}"), [PART])
    sums.write.partitionBy(PART).parquet(f"{path}/sums/{folder}")
    parts |= dict.fromkeys(written, folder)
    streams = state.streams | dict([_batch_of(tag)] if tag else [])
    commit(spark, path, state, replace(state, grain=grain, parts=parts, streams=streams))
    return state.version + 1


def _written_parts(spark: SparkSession, folder: str) -> set[str]:
    """The parts a write produced, from the names of its files. Nothing is opened."""
    files = spark.read.schema(ADS_SPEND_SCHEMA).parquet(folder).inputFiles()
    return {found[1] for f in files if (found := re.search(f"/{PART}=([^/]*)/", f))}


def commit(spark: SparkSession, path: str, old: TableState, new: TableState) -> None:
    """Make ``new`` the version after ``old``, then point the catalog tables that follow it."""
    new = replace(new, version=old.version + 1)
    said = (new.streams, list(new.published))
    rows = [(new.grain, part, folder, *said) for part, folder in new.parts.items()]
    # An empty table still needs a row to exist as a version.
    log = spark.createDataFrame(rows or [(new.grain, None, None, *said)], _COMMIT_SCHEMA)
    # A second writer that started from the same version must fail, not overwrite.
    folder = f"{path}/commits/version={new.version}"
    try:
        log.coalesce(1).write.mode("error").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise RuntimeError(
            f"another write of version {new.version} is under way or done, or was cut off "
            f"while it committed; in the last case remove {folder} and run again"
        ) from e
    for name in new.published:
        point_table(spark, name, path, old, new)


def _schema_text() -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ADS_SPEND_SCHEMA)


def part_folder(path: str, state: TableState, part: str) -> str:
    return f"{path}/data/{state.parts[part]}/{PART}={part}"


def write_snapshot(
    df: DataFrame, path: str, tag: str | None = None, grain: str = "month"
) -> int:
    """Replace the whole table."""
    state = table_state(df.sparkSession, path)
    return write_parts(df, path, state, state.parts.keys(), tag, grain=grain)


# ---- catalog tables ---------------------------------------------------------------------------

_POINTS_AT, _SHOWS = "tallyspan.version", "tallyspan.path"


def publish_table(spark: SparkSession, path: str, name: str) -> None:
    """Show the stored table as the catalog table ``name``, now and after every later write.

    The catalog table is partitioned by part, and each partition lies in the folder that the newest
    commit names. A write moves the partitions it replaced, one statement each, so a query that
    starts in between can see a batch in part; :func:`read_table` never does. In a session that
    does not know the table yet the next write, or publishing again, makes it.
    """
    old = table_state(spark, path)
    if name in old.published:
        point_table(spark, name, path, TableState(), old)
    else:
        commit(spark, path, old, replace(old, published=(*old.published, name)))


def point_table(spark: SparkSession, name: str, path: str, old: TableState, new: TableState) -> None:
    """Bring a catalog table from one state to another. Only metadata is touched."""
    known = _properties(spark, name)
    if known and known.get(_SHOWS) != path:
        raise ValueError(f"{name} is another table, not the one stored at {path}")
    if known.get(_POINTS_AT) != str(old.version):
        old = TableState()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({_schema_text()}, `{PART}` string) USING parquet "
            f"PARTITIONED BY (`{PART}`) LOCATION '{path}/data' TBLPROPERTIES ('{_SHOWS}'='{path}')"
        )
    where = {p: f"PARTITION (`{PART}`='{p}')" for p in {*old.parts, *new.parts}}
    fresh = [f"{where[p]} LOCATION '{part_folder(path, new, p)}'" for p in new.parts if p not in old.parts]
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(fresh)}")
    for p, folder in new.parts.items():
        if old.parts.get(p, folder) != folder:
            spark.sql(f"ALTER TABLE {name} {where[p]} SET LOCATION '{part_folder(path, new, p)}'")
    for p in old.parts.keys() - new.parts.keys():
        spark.sql(f"ALTER TABLE {name} DROP {where[p]}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_POINTS_AT}'='{new.version}')")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """None at all for a table that is not there."""
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows} | {"": name}
