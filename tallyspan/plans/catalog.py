"""The registered queries. Each takes ``(spark, sf_dir)`` and covers the whole of its tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.dates import parse_date
from tallyspan.functions.text import canon_platform, initcap_alnum
from tallyspan.operators import audit, kpi, many, merge, periods, rows
from tallyspan.operators.clean import cast_typed, clean_numbers, stamp_provenance
from tallyspan.plans.pipeline import dedupe_table, run_ingest, table_kpi, table_metrics, upsert_table
from tallyspan.plans.views import create_live_views, create_views
from tallyspan.schema import FACT_COLUMNS, FILE_COLUMNS, SEQ
from tallyspan.session import shared_folder
from tallyspan.sinks.json_rows import metrics_json
from tallyspan.sources import fact_table
from tallyspan.sources.fact_table import publish_table, read_table, table_state, write_snapshot
from tallyspan.sources.star import ads_from_events, ads_from_lineitem, text_rows_from_events
from tallyspan.streaming.ingest_stream import ingest_stream

KPI_COLUMNS = ("date", "platform", "spend", "conversions")
FIRST_LOAD = dt.datetime(2025, 7, 1, 8, 0, 0)
SECOND_LOAD = dt.datetime(2025, 7, 2, 8, 0, 0)
BATCH_FROM, TARGET_BEFORE = dt.date(2000, 7, 1), dt.date(2001, 1, 1)

SUMMARY_NAMES = {"value_current": "last_30", "value_prior": "prior_30", "abs_delta": "delta_abs"}

Query = Callable[[SparkSession, str], DataFrame]


def _kpi_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads_from_lineitem(spark, sf_dir, KPI_COLUMNS)


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads_from_lineitem(spark, sf_dir, (*FACT_COLUMNS, SEQ))


def kpi_compact(spark, sf_dir):
    return kpi.kpi_compact(_kpi_input(spark, sf_dir))


def kpi_compact_events_15d(spark, sf_dir):
    # The newest day is that of the events themselves; their daily sums need not be made to find it.
    days = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.to_date("ts").alias("date"))
    return kpi.kpi_compact(ads_from_events(spark, sf_dir), n_days=15, anchor=periods.resolve_anchor(days))


def kpi_30d_vs_prior(spark, sf_dir):
    return kpi.kpi_30d_vs_prior(_kpi_input(spark, sf_dir))


def kpi_by_platform(spark, sf_dir):
    return kpi.kpi_by(_kpi_input(spark, sf_dir))


def kpi_by_country_device(spark, sf_dir):
    ads = ads_from_lineitem(spark, sf_dir, ("date", "country", "device", "spend", "conversions"))
    return kpi.kpi_by(ads, ["country", "device"])


def kpi_by_rounding_ties(spark, sf_dir):
    """Orders as campaigns of a handful of conversions: half of the changes of two and two end in half a
    cent, which is rounded away from zero."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ads = items.select(
        F.when(F.col("l_linenumber") % 2 == 0, F.lit(dt.date(2001, 6, 30))).otherwise(F.lit(dt.date(2001, 5, 31))).alias("date"),
        F.col("l_orderkey").cast("string").alias("campaign"),
        F.col("l_extendedprice").alias("spend"),
        F.lit(1).alias("conversions"),
    )
    return kpi.kpi_by(ads, ["campaign"])


def kpi_by_platform_gaps(spark, sf_dir):
    """Platforms that are partly unknown, and refunds."""
    ads = ads_from_lineitem(spark, sf_dir, (*KPI_COLUMNS, SEQ))
    gaps = ads.withColumns(
        {
            "platform": F.when(F.col(f"{SEQ}.l_partkey") % 3 > 0, F.col("platform")),
            "spend": F.when(F.col(f"{SEQ}.l_suppkey") % 5 == 0, -F.col("spend")).otherwise(F.col("spend")),
        }
    )
    return kpi.kpi_by(gaps)


def kpi_30d_refunds(spark, sf_dir):
    """Spend below zero throughout, conversions in part."""
    ads = ads_from_lineitem(spark, sf_dir, (*KPI_COLUMNS, SEQ))
    less = F.when(F.col(f"{SEQ}.l_suppkey") % 2 == 0, -F.col("conversions")).otherwise(F.col("conversions"))
    return kpi.kpi_30d_vs_prior(ads.withColumns({"spend": -F.col("spend"), "conversions": less}))


def kpi_summary(spark, sf_dir):
    return kpi.kpi_summary(_kpi_input(spark, sf_dir))


def metrics_window(spark, sf_dir):
    return kpi.metrics(_kpi_input(spark, sf_dir), "2001-06-01", "2001-06-30")


def metrics_window_renamed(spark, sf_dir):
    ads = _kpi_input(spark, sf_dir)
    return kpi.metrics(ads, "2000-01-01", "2000-12-31", change_name="pct_delta")


def metrics_default(spark, sf_dir):
    return kpi.metrics_request(_kpi_input(spark, sf_dir), "{}")


def metrics_start_only(spark, sf_dir):
    return kpi.metrics_request(_kpi_input(spark, sf_dir), '{"start": "2001-09-01"}')


def metrics_end_only(spark, sf_dir):
    return kpi.metrics_request(_kpi_input(spark, sf_dir), '{"end": "2001-03-31"}')


def metrics_many(spark, sf_dir):
    """A week's window from every order date."""
    day = F.col("o_orderdate").cast("date")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    requests = orders.select(day.alias("start"), F.date_add(day, 6).alias("end")).distinct()
    return many.metrics_many(_kpi_input(spark, sf_dir), requests)


def metrics_many_requests(spark, sf_dir):
    """A JSON request per order: bounds in several spellings, missing, null or reversed."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    start, end = F.date_format(day, "yyyy/M/d"), F.date_format(F.date_add(day, (key % 40).cast("int") - 3), "M/d/yyyy")
    stamp = F.date_format(day, "yyyy-MM-dd'T'00:00:00'Z'")
    asked = (
        F.when(key % 4 == 0, F.format_string('{"start": "%s", "end": "%s"}', start, end))
        .when(key % 4 == 1, F.format_string('{"start": "%s"}', stamp))
        .when(key % 4 == 2, F.format_string('{"end": "%s", "start": null}', F.date_format(day, "yyyyMMdd")))
        .otherwise("{}")
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    requests = many.parse_requests(orders.select(key.alias("request_id"), asked.alias("request")))
    return many.metrics_many(_kpi_input(spark, sf_dir), requests).drop("start", "end")


def metrics_response(spark, sf_dir):
    return metrics_json(metrics_window(spark, sf_dir))


def ads_daily(spark, sf_dir):
    return rows.ads_daily(ads_from_lineitem(spark, sf_dir, FILE_COLUMNS))


def ads_daily_view(spark, sf_dir):
    create_views(ads_from_lineitem(spark, sf_dir, FILE_COLUMNS), ["v_ads_daily"])
    return spark.sql(
        """
        SELECT country, device, count(*) AS ads, count(cac) AS ads_with_cac,
               round(max(cac), 4) AS worst_cac, round(max(roas), 4) AS best_roas
        FROM v_ads_daily
        GROUP BY country, device
        """
    )


def kpi_summary_view(spark, sf_dir):
    create_views(_kpi_input(spark, sf_dir), ["kpi_30d_vs_prior"])
    rows = spark.table("kpi_30d_vs_prior").filter(F.col("metric").isin("CAC", "ROAS"))
    percent = F.round(F.col("pct_delta") * 100, 2)
    return rows.select("metric", *[F.col(c).alias(n) for c, n in SUMMARY_NAMES.items()], percent.alias("delta_pct"))


def live_views(spark, sf_dir):
    """Views made over a stored table before half of its rows came."""
    ads = _ordered(spark, sf_dir)
    table, staged = shared_folder(spark, "table"), shared_folder(spark, "staged")
    name = f"ads_{uuid.uuid4().hex}"
    write_snapshot(merge.dedupe_latest(ads.filter(F.col("date") < F.lit(BATCH_FROM))), table)
    publish_table(spark, table, name)
    create_live_views(spark, name, [f"{name}_daily", f"{name}_kpi"])
    ads.filter(F.col("date") >= F.lit(BATCH_FROM)).write.parquet(staged)
    upsert_table(table, spark.read.parquet(staged), SECOND_LOAD)
    return spark.sql(
        f"""
        SELECT metric AS name, value_current, value_prior, abs_delta, pct_delta FROM {name}_kpi
        UNION ALL
        SELECT country, round(max(cac), 4), round(max(roas), 4), double(count(*)), double(count(cac))
        FROM {name}_daily GROUP BY country
        """
    )


def dedupe_latest(spark, sf_dir):
    return merge.dedupe_latest(_ordered(spark, sf_dir))


def duplicate_keys(spark, sf_dir):
    return merge.duplicate_keys(ads_from_lineitem(spark, sf_dir))


def upsert_batch(spark, sf_dir):
    ads = _ordered(spark, sf_dir)
    target = merge.dedupe_latest(ads.filter(F.col("date") < F.lit(TARGET_BEFORE)))
    batch = ads.filter(F.col("date") >= F.lit(BATCH_FROM))
    return merge.upsert(target, batch, SECOND_LOAD)


def upsert_null_keys(spark, sf_dir):
    """A batch whose keys are partly incomplete, on a table that already holds such rows."""
    ads = ads_from_lineitem(spark, sf_dir, (*FACT_COLUMNS, SEQ))
    known, part = F.col("platform"), F.col(f"{SEQ}.l_partkey")
    ads = ads.withColumns(
        {
            "platform": F.when(part % 4 > 0, known),
            "date": F.when(part % 7 > 0, F.col("date")),
            "load_date": F.when(part % 2 == 0, F.col("load_date")),
        }
    )
    line = F.col(f"{SEQ}.l_linenumber")
    complete = merge.dedupe_latest(ads.filter(line <= 3).filter("platform IS NOT NULL AND date IS NOT NULL"))
    incomplete = ads.filter(line <= 3).filter("platform IS NULL OR date IS NULL").select(*FACT_COLUMNS)
    return merge.upsert(complete.unionByName(incomplete), ads.filter(line >= 3), SECOND_LOAD)


def row_count(spark, sf_dir):
    return audit.row_count(ads_from_lineitem(spark, sf_dir, ("date",)))


def load_batches(spark, sf_dir):
    return audit.load_batches(ads_from_lineitem(spark, sf_dir, ("load_date",)))


def load_batches_subsecond(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return audit.load_batches(events.select(F.col("ts").alias("load_date")))


def file_provenance(spark, sf_dir):
    return audit.file_provenance(
        ads_from_lineitem(spark, sf_dir, ("load_date", "source_file_name"))
    )


def file_provenance_unnamed(spark, sf_dir):
    """Some rows do not know their file."""
    ads = ads_from_lineitem(spark, sf_dir, ("load_date", "source_file_name", SEQ))
    name = F.when(F.col(f"{SEQ}.l_linenumber") % 3 != 0, F.col("source_file_name"))
    return audit.file_provenance(ads.withColumn("source_file_name", name))


def clean_number_text(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = items.select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit(" "), F.format_number("l_extendedprice", 2)).alias("spend"),
        F.when(F.col("l_quantity") > 1, F.format_number(F.col("l_quantity") * 1000, 0)).alias(
            "clicks"
        ),
        F.concat(F.col("l_quantity").cast("int"), F.lit(".0")).alias("impressions"),
        F.when(F.col("l_linestatus") == "F", "n/a").otherwise("12").alias("conversions"),
    )
    return clean_numbers(text)


def typed_rows(spark, sf_dir):
    rows_in = stamp_provenance(text_rows_from_events(spark, sf_dir), FIRST_LOAD)
    return cast_typed(rows_in)[0]


def _dirty_rows(spark, sf_dir):
    """Event rows with faults that depend on the event's own number."""
    number = F.get_json_object("props", "$.k").cast("int")
    text = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.when(number < 5, "").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date"),
        F.col("event_type").alias("platform"),
        F.lit("").alias("account"),
        F.format_string("%s-%010d", "event_type", "event_id").alias("campaign"),
        F.lit("").alias("country"),
        F.lit("Mobile").alias("device"),
        F.when(number.between(5, 9), "abc").otherwise(F.col("value").cast("string")).alias("spend"),
        F.when(number.between(10, 14), "7.6").otherwise("7.0").alias("clicks"),
        F.when(number.between(15, 19), "3,000,000,000").otherwise("1,000").alias("impressions"),
        F.when(number.between(20, 24), "NaN").alias("conversions"),
    )
    return stamp_provenance(text, FIRST_LOAD, source="dirty.csv")


def rejected_rows(spark, sf_dir):
    rejects = cast_typed(_dirty_rows(spark, sf_dir), on_error="reject")[1]
    return rejects.groupBy(F.col("_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("rejected"), F.max("campaign").alias("last_campaign")
    )


def accepted_rows(spark, sf_dir):
    good = cast_typed(_dirty_rows(spark, sf_dir), on_error="reject", blank="null")[0]
    return good.groupBy("date", "platform").agg(
        F.count(F.lit(1)).alias("accepted"),
        F.round(F.sum("spend"), 2).alias("spend"),
        F.sum("clicks").alias("clicks"),
        F.sum("impressions").alias("impressions"),
        F.count("conversions").alias("with_conversions"),
    )


def period_tags(spark, sf_dir):
    ads = ads_from_lineitem(spark, sf_dir, ("date",))
    windows = periods.rolling_periods(periods.resolve_anchor(ads))
    return ads.groupBy(F.expr(f"{periods.period_tag(windows)} AS period")).agg(
        F.count(F.lit(1)).alias("ads")
    )


def canonical_platforms(spark, sf_dir):
    ads = ads_from_lineitem(spark, sf_dir, ("platform",))
    return ads.groupBy(
        F.col("platform").alias("raw"), canon_platform(F.col("platform")).alias("platform")
    ).agg(F.count(F.lit(1)).alias("ads"))


def capitalised_text(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        "o_orderkey", initcap_alnum(F.col("o_orderpriority")).alias("priority")
    )


def parsed_dates(spark, sf_dir):
    """The order date written in four ways, and read back."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    text = (
        F.when(key % 4 == 0, F.date_format(day, "yyyy-M-d"))
        .when(key % 4 == 1, F.date_format(day, "yyyyMMdd"))
        .when(key % 4 == 2, F.date_format(day, "M/d/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM"))
    )
    return orders.select("o_orderkey", parse_date(text).alias("day"))


def _files(rows):
    folder = shared_folder(rows.sparkSession, "input")
    rows.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    return folder


def _event_files(spark, sf_dir):
    return _files(text_rows_from_events(spark, sf_dir))


def ingest_rejected(spark, sf_dir):
    """What a load of faulty files stored and what it set aside, by reason."""
    table, aside = shared_folder(spark, "table"), shared_folder(spark, "rejects")
    files = _files(_dirty_rows(spark, sf_dir).select(*FILE_COLUMNS))
    run_ingest(spark, files, table, batch_ts=FIRST_LOAD, on_error="reject", rejects_path=aside)
    stored = read_table(spark, table).select(F.lit("stored").alias("reason"), "campaign")
    rejects = spark.read.json(aside).select(F.col("_reason").alias("reason"), "campaign")
    return stored.unionByName(rejects).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("campaign").alias("campaigns")
    )


def ingest_mixed_headers(spark, sf_dir):
    """Files whose columns come in three orders, one of them with a column of its own."""
    rows, table = text_rows_from_events(spark, sf_dir), shared_folder(spark, "table")
    number = F.regexp_extract("campaign", r"([0-9]+)$", 1).cast("long") % 3
    orders = [FILE_COLUMNS, (*FILE_COLUMNS[5:], *FILE_COLUMNS[:5]), ("account", *reversed(FILE_COLUMNS))]
    files = []
    for k, names in enumerate(orders):
        some = rows.filter(number == k)
        if k == 2:
            names = ("note", *names[1:])
            some = some.withColumn("note", F.lit("x, y"))
        files.append(_files(some.select(*names)))
    run_ingest(spark, files, table, batch_ts=FIRST_LOAD, source="ads_spend.csv", by_name=True)
    return read_table(spark, table)


def ingest_rerun(spark, sf_dir):
    """The same files ingested twice: only the load time moves."""
    files, table = _event_files(spark, sf_dir), shared_folder(spark, "table")
    for batch_ts in (FIRST_LOAD, SECOND_LOAD):
        run_ingest(spark, files, table, batch_ts=batch_ts, source="ads_spend.csv")
    return read_table(spark, table)


def ingest_metrics(spark, sf_dir):
    files, table = _event_files(spark, sf_dir), shared_folder(spark, "table")
    return run_ingest(spark, files, table, "2024-01-16", "2024-01-30", batch_ts=FIRST_LOAD)


def ingest_streamed(spark, sf_dir):
    files, table = _event_files(spark, sf_dir), shared_folder(spark, "table")
    checkpoint = shared_folder(spark, "stream")
    for _ in range(2):
        query = ingest_stream(spark, files, table, checkpoint, clock=lambda: FIRST_LOAD)
        query.awaitTermination()
    return read_table(spark, table).drop("source_file_name")


def _stored(spark, sf_dir):
    """Line items stored, deduplicated in place, and a batch upserted."""
    ads = _ordered(spark, sf_dir)
    table, staged = shared_folder(spark, "table"), shared_folder(spark, "staged")
    write_snapshot(ads, table)
    dedupe_table(spark, table)
    ads.filter(F.col("date") >= F.lit(BATCH_FROM)).write.parquet(staged)
    upsert_table(table, spark.read.parquet(staged), SECOND_LOAD)
    return table


def stored_metrics(spark, sf_dir):
    """The default window of a stored table, from its daily sums."""
    return table_metrics(spark, _stored(spark, sf_dir))


def stored_kpi_by_platform(spark, sf_dir):
    """Platforms of a stored table, from its daily sums."""
    return table_kpi(spark, _stored(spark, sf_dir), kpi.kpi_by)


def stored_bounds(spark, sf_dir):
    """Rows and dates of a stored table, from its file footers."""
    table = _stored(spark, sf_dir)
    state = table_state(spark, table)
    return fact_table.stored_bounds(spark, table, state, state.parts)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        kpi_compact,
        kpi_compact_events_15d,
        kpi_30d_vs_prior,
        kpi_by_platform,
        kpi_by_country_device,
        kpi_by_rounding_ties,
        kpi_by_platform_gaps,
        kpi_30d_refunds,
        kpi_summary,
        metrics_window,
        metrics_window_renamed,
        metrics_default,
        metrics_start_only,
        metrics_end_only,
        metrics_many,
        metrics_many_requests,
        metrics_response,
        ads_daily,
        ads_daily_view,
        kpi_summary_view,
        live_views,
        dedupe_latest,
        duplicate_keys,
        upsert_batch,
        upsert_null_keys,
        row_count,
        load_batches,
        load_batches_subsecond,
        file_provenance,
        file_provenance_unnamed,
        clean_number_text,
        typed_rows,
        rejected_rows,
        accepted_rows,
        period_tags,
        canonical_platforms,
        capitalised_text,
        parsed_dates,
        ingest_rerun,
        ingest_metrics,
        ingest_rejected,
        ingest_mixed_headers,
        ingest_streamed,
        stored_metrics,
        stored_kpi_by_platform,
        stored_bounds,
    )
}
