"""Advertising-spend analytics as PySpark DataFrame functions."""

from tallyspan.functions.dates import parse_date, round_to_second
from tallyspan.functions.numbers import parse_number
from tallyspan.functions.text import canon_platform, initcap_alnum
from tallyspan.operators.audit import file_provenance, load_batches, row_count
from tallyspan.operators.clean import cast_typed, clean_numbers, stamp_provenance
from tallyspan.operators.kpi import (
    kpi_30d_vs_prior,
    kpi_by,
    kpi_compact,
    kpi_long,
    kpi_summary,
    metrics,
    metrics_request,
    period_totals,
)
from tallyspan.operators.many import metrics_many, parse_requests, running_totals
from tallyspan.operators.merge import dedupe_latest, duplicate_keys, upsert
from tallyspan.operators.periods import (
    Periods,
    explicit_periods,
    period_tag,
    periods_from_json,
    resolve_anchor,
    rolling_periods,
)
from tallyspan.operators.rows import ads_daily
from tallyspan.plans.pipeline import (
    LoadCounts,
    dedupe_table,
    load_rows,
    require_unique,
    run_ingest,
    table_kpi,
    table_metrics,
    table_metrics_many,
    table_response,
    upsert_table,
)
from tallyspan.plans.views import create_live_views, create_views
from tallyspan.schema import ADS_SPEND_SCHEMA, NATURAL_KEY
from tallyspan.session import build_session
from tallyspan.sinks.json_rows import metrics_json, write_json
from tallyspan.sources.csv_files import read_ads_csv
from tallyspan.sources.fact_table import (
    daily_sums,
    publish_table,
    read_table,
    stored_bounds,
    table_anchor,
    table_rows,
    write_snapshot,
)
from tallyspan.streaming.ingest_stream import ingest_stream
