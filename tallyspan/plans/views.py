"""The fact table and its reports as views, for SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyspan.operators.kpi import (
    COMPACT,
    exact_totals,
    kpi_compact,
    measured,
    metric_cells,
    reported,
    window_sums,
)
from tallyspan.operators.periods import DEFAULT_DAYS
from tallyspan.operators.rows import ads_daily, daily_columns
from tallyspan.sources.fact_table import NO_DATE, PART

VIEWS = ("ads_spend", "v_ads_daily", "kpi_30d_vs_prior")


def create_views(
    df: DataFrame, names: Sequence[str] = VIEWS, anchor: dt.date | None = None
) -> None:
    """Temporary views over fact rows: ``ads_spend`` (the rows), ``v_ads_daily`` (with CAC and
    ROAS per row) and ``kpi_30d_vs_prior`` (the compact comparison, bounds fixed at this
    moment). All are evaluated when queried; a view that is not asked for costs nothing.
    """
    made = {
        "ads_spend": lambda: df,
        "v_ads_daily": lambda: ads_daily(df),
        "kpi_30d_vs_prior": lambda: kpi_compact(df, anchor=anchor),
    }
    for name in names:
        made[name]().createOrReplaceTempView(name)


def create_live_views(
    spark: SparkSession, table: str, names: Sequence[str] = VIEWS[1:], n_days: int = DEFAULT_DAYS
) -> None:
    """Views in the catalog over a published table (see ``publish_table``): ``v_ads_daily`` and
    ``kpi_30d_vs_prior``, under the given names. They are SQL texts, so they show the table as it is when
    they are asked, and the comparison ends at the newest date of that moment.
    """
    daily, comparison = names
    spark.sql(f"CREATE OR REPLACE VIEW {daily} AS SELECT {', '.join(daily_columns())} FROM {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {comparison} AS {comparison_sql(table, n_days)}")


def comparison_sql(table: str, n_days: int = DEFAULT_DAYS) -> str:
    """The compact comparison as one SELECT. The newest date is a scalar subquery on the newest part; it is
    known before the fact scan begins, which then opens the parts of both windows only."""
    top = "(SELECT day FROM newest)"
    first, last = f"date_sub({top}, {2 * n_days - 1})", top
    now = f"date BETWEEN date_sub({top}, {n_days - 1}) AND {top}"
    before = f"date BETWEEN {first} AND date_sub({top}, {n_days})"
    # The name of a part is the beginning of the date's ISO text.
    parts = f"`{PART}` BETWEEN left(string({first}), 7) AND string({last})"
    return f"""
        WITH newest AS (
          SELECT max(date) AS day FROM {table}
          WHERE `{PART}` = (SELECT max(`{PART}`) FROM {table} WHERE `{PART}` <> '{NO_DATE}')
        ), measured AS (
          SELECT {", ".join(measured())} FROM {table} WHERE {parts} AND date BETWEEN {first} AND {last}
        ), sums AS (
          SELECT {", ".join(window_sums(now, before))} FROM measured
        ), totals AS (
          SELECT {", ".join(exact_totals())} FROM sums
        ), cells AS (
          SELECT {metric_cells(COMPACT)} FROM totals
        )
        SELECT {", ".join(reported(COMPACT))} FROM cells ORDER BY metric
    """
