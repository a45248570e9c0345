"""The job chains: file to table, table to metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.dates import parse_day
from tallyspan.operators.clean import REASON, accepted, judge_rows, rejected, stamp_provenance
from tallyspan.operators.kpi import kpi_compact, metrics_of
from tallyspan.operators.many import metrics_many
from tallyspan.operators.merge import dedupe_latest, duplicate_keys, upsert
from tallyspan.operators.periods import (
    DEFAULT_DAYS,
    Periods,
    request_bounds,
    rolling_periods,
    window_periods,
)
from tallyspan.schema import NATURAL_KEY
from tallyspan.session import shared_folder
from tallyspan.sinks.json_rows import metrics_json, write_json
from tallyspan.sources.csv_files import read_ads_csv
from tallyspan.sources.fact_table import (
    TableState,
    daily_sums,
    part_column,
    physical_order,
    read_parts,
    table_anchor,
    table_state,
    write_parts,
)

# The window an ingest run reports on when none is given.
REPORT_START, REPORT_END = "2025-06-01", "2025-06-30"


def utc_now() -> dt.datetime:
    """One load time per run, so that a retried task stamps the same value."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class LoadCounts:
    """What became of a load's rows. ``read`` rows were ``accepted`` or ``rejected``; the keys of the
    accepted ones were ``inserted`` or ``updated``, and ``kept`` rows of the parts they fall into were left
    as they were."""

    read: int = 0
    accepted: int = 0
    rejected: int = 0
    inserted: int = 0
    updated: int = 0
    kept: int = 0


def upsert_table(
    table: str,
    batch: DataFrame,
    batch_ts: dt.datetime,
    tag: str | None = None,
    grain: str = "month",
) -> LoadCounts:
    """Upsert a batch into the stored table, reading and replacing only the parts (months or
    days) that the batch has dates in.

    The batch is read more than once; hand over stored rows, not a long plan. That the target
    holds no key twice is checked, and what happens to the rows counted, in the pass that writes.
    """
    spark = batch.sparkSession
    state = table_state(spark, table)
    touched = _parts_of(batch, state.grain or grain)
    target = read_parts(spark, table, state, touched)
    seen = Observation()
    outcomes = ("inserted", "updated", "kept")
    merged = upsert(target, batch, batch_ts, by_range=True, outcome="_outcome").observe(
        seen, *[F.count_if(F.col("_outcome") == o).alias(o) for o in outcomes]
    )
    write_parts(merged, table, state, touched, tag, laid_out=True, grain=grain)
    return LoadCounts(**{o: seen.get[o] for o in outcomes})


def _parts_of(df: DataFrame, grain: str) -> list[str]:
    """As many names as the input has months or days."""
    names = df.select(part_column(grain).alias("part")).distinct().collect()
    return [row["part"] for row in names]


def load_rows(
    rows: DataFrame,
    table: str,
    batch_ts: dt.datetime,
    source: str | None = None,
    on_error: str = "fail",
    blank: str = "zero",
    rejects_path: str | None = None,
    tag: str | None = None,
    grain: str = "month",
    rejects_folder: str | None = None,
) -> LoadCounts:
    """Text rows, as :func:`read_ads_csv` gives them, into the table.

    Judged rows are stored once in the shared folder, by verdict: parsing is not repeated for the
    passes of the upsert, row positions stay what they are if an executor is lost, and neither
    the accepted nor the rejected rows are read for the sake of the others.

    Rows are set aside only if ``rejects_path`` says where to. Each load has its own folder there,
    ``rejects_folder`` or one named by the load time. It is written before the table, and emptied if the
    table cannot be written, so a failed load can be repeated.
    """
    if on_error == "reject" and not rejects_path:
        raise ValueError("on_error='reject' needs a rejects_path, or the rows would be lost")
    spark = rows.sparkSession
    staged = shared_folder(spark, "staged")
    judged = judge_rows(stamp_provenance(rows, batch_ts, source), on_error, blank)
    judged = judged.withColumn(_VERDICT, F.col(REASON).isNotNull())
    seen = Observation()
    judged.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(_VERDICT).alias("rejected")).write.partitionBy(
        _VERDICT
    ).parquet(staged)
    read, bad = seen.get["read"], seen.get["rejected"]

    def verdict(is_rejected: bool) -> DataFrame:
        stored = spark.read.schema(judged.schema).option("basePath", staged)
        return stored.parquet(staged).filter(F.col(_VERDICT) == is_rejected).drop(_VERDICT)

    aside = rejects_path and f"{rejects_path.rstrip('/')}/{rejects_folder or _load_folder(batch_ts)}"
    if bad:
        write_json(rejected(verdict(True)), aside, "overwrite")
    try:
        counts = upsert_table(table, accepted(verdict(False)), batch_ts, tag, grain)
    except Exception:
        if bad:
            write_json(rejected(verdict(True)).limit(0), aside, "overwrite")
        raise
    return replace(counts, read=read, accepted=read - bad, rejected=bad)


_VERDICT = "_rejected"


def _load_folder(batch_ts: dt.datetime) -> str:
    return f"load={batch_ts.strftime('%Y%m%dT%H%M%S%f')}"


def run_ingest(
    spark: SparkSession,
    csv: str | list[str],
    table: str,
    start: str | None = REPORT_START,
    end: str | None = REPORT_END,
    batch_ts: dt.datetime | None = None,
    source: str | None = None,
    on_error: str = "fail",
    blank: str = "zero",
    rejects_path: str | None = None,
    multi_line: bool = False,
    grain: str = "month",
    by_name: bool = False,
) -> DataFrame:
    """Read, clean, type and upsert the files, then report the window once.

    A missing or empty bound is that of the fixed window; bounds are checked before anything is
    written. ``by_name`` takes files whose columns come in different orders.
    """
    start, end = parse_day(start or REPORT_START), parse_day(end or REPORT_END)
    load_rows(
        read_ads_csv(spark, csv, multi_line, by_name),
        table,
        batch_ts or utc_now(),
        source,
        on_error,
        blank,
        rejects_path,
        grain=grain,
    )
    return table_metrics(spark, table, start, end)


def table_metrics(
    spark: SparkSession, table: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Metrics of the stored table, from its daily sums in the parts of the two windows."""
    state = table_state(spark, table)
    periods = window_periods(start, end, lambda: table_anchor(spark, table, state))
    return metrics_of(_sums_for(spark, table, state, periods), periods)


def table_kpi(
    spark: SparkSession,
    table: str,
    report: Callable[..., DataFrame] = kpi_compact,
    n_days: int = DEFAULT_DAYS,
    **options,
) -> DataFrame:
    """A rolling report (``kpi_compact``, ``kpi_30d_vs_prior``, ``kpi_summary``, or ``kpi_by`` platform) of the
    stored table, from its daily sums."""
    state = table_state(spark, table)
    anchor = table_anchor(spark, table, state)
    sums = _sums_for(spark, table, state, rolling_periods(anchor, n_days))
    return report(sums, n_days=n_days, anchor=anchor, **options)


def table_metrics_many(
    spark: SparkSession, table: str, requests: DataFrame, change_name: str = "delta_pct"
) -> DataFrame:
    """:func:`metrics_many` of the stored table, from its daily sums."""
    state = table_state(spark, table)
    anchor = table_anchor(spark, table, state)
    return metrics_many(daily_sums(spark, table, state=state), requests, change_name, anchor)


def _sums_for(spark: SparkSession, table: str, state: TableState, periods: Periods) -> DataFrame:
    bounds = (periods.prior_from, periods.current_to)
    # Without a date to go by the table is empty, and there is nothing to leave out.
    return daily_sums(spark, table, bounds if None not in bounds else None, state)


def table_response(spark: SparkSession, table: str, request: str = "{}") -> str:
    """JSON request in, JSON array out."""
    start, end = request_bounds(request)
    return metrics_json(table_metrics(spark, table, start, end)).first()["response"]


def dedupe_table(spark: SparkSession, table: str) -> int:
    """Keep the latest row of each key; returns the number of rows that went.

    Parts without a repeated key are left as they are; the date is part of the key, so a part
    can be settled on its own. Finding them reads the key columns. The pass that writes the
    others counts the rows it read and the keys it wrote: had a key been written twice, they would not
    add up to the rows that finding them counted.
    """
    state = table_state(spark, table)
    if not state.parts:
        return 0
    keys = read_parts(spark, table, state, state.parts).groupBy(*NATURAL_KEY).agg(F.count(F.lit(1)).alias("_copies"))
    found = (
        keys.groupBy(part_column(state.grain).alias("part"))
        .agg(F.count(F.lit(1)).alias("keys"), F.sum("_copies").alias("rows"))
        .filter("rows > keys")
        .collect()
    )
    parts = [r["part"] for r in found]
    if not parts:
        return 0
    seen = Observation()
    latest = dedupe_latest(physical_order(spark, table, state, parts), copies="_copies").observe(
        seen, F.count(F.lit(1)).alias("keys"), F.sum("_copies").alias("rows")
    )
    expected = {c: sum(r[c] for r in found) for c in ("keys", "rows")}

    def check() -> None:
        if seen.get != expected:
            raise ValueError(f"keys and rows were {expected}, but {seen.get} while writing")

    write_parts(latest, table, state, parts, before_commit=check)
    return expected["rows"] - expected["keys"]


def require_unique(df: DataFrame) -> None:
    """Raise if a complete key occurs more than once."""
    found = duplicate_keys(df).first()
    if found is not None:
        raise ValueError(f"duplicate key: {found.asDict()}")
