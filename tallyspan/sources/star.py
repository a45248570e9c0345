"""The star-schema tables shaped as fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.schema import FACT_COLUMNS, SEQ

# Raw platform spellings handed out by number.
RAW_PLATFORMS = (" Google Ads", "fb", "tik-tok ads", "adwords", "META", "bing_ads")


def _raw_platform(number: str) -> str:
    names = ", ".join(f"'{n}'" for n in RAW_PLATFORMS)
    return f"element_at(array({names}), int({number} % {len(RAW_PLATFORMS)} + 1))"


_FROM_LINEITEM = {
    "date": "date(l_shipdate)",
    "platform": _raw_platform("l_suppkey"),
    "account": "concat('acct-', l_suppkey % 10)",
    "campaign": "concat('cmp-', l_partkey % 50)",
    "country": "n_name",
    "device": "l_linestatus",
    "spend": "l_extendedprice",
    "clicks": "int(l_quantity * 10)",
    "impressions": "int(l_quantity * 100)",
    "conversions": "int(l_quantity)",
    "load_date": "l_shipdate + make_dt_interval(l_linenumber)",
    "source_file_name": "concat('lineitem_', l_linestatus, '.csv')",
    SEQ: "struct(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS spend, "
    "int(l_quantity) AS conversions)",
}

_EVENT_NUMBER = "int(get_json_object(props, '$.k'))"


def ads_from_lineitem(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = FACT_COLUMNS
) -> DataFrame:
    """One fact row per line item.

    Only the country needs other tables. Without it no join is planned, and columns not asked
    for are not read. The supplier side grows with the data, so the join strategy is left to
    the optimizer, which broadcasts by measured size only.
    """
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if "country" in columns:
        nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
        home = (
            spark.read.parquet(f"{sf_dir}/supplier.parquet")
            .select("s_suppkey", "s_nationkey")
            .join(nation, F.expr("s_nationkey = n_nationkey"), "left")
        )
        items = items.join(home, F.expr("l_suppkey = s_suppkey"), "left")
    return items.selectExpr(*[f"{_FROM_LINEITEM[c]} AS {c}" for c in columns])


def ads_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted per day, platform and account."""
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .groupBy(
            F.expr("date(ts) AS date"),
            F.expr(f"{_raw_platform(_EVENT_NUMBER)} AS platform"),
            F.expr("string(user_id % 10) AS account"),
        )
        .agg(
            F.expr("sum(value) AS spend"),
            F.expr("int(count_if(event_type = 'click')) AS clicks"),
            F.expr("int(count_if(event_type = 'view')) AS impressions"),
            F.expr("int(count_if(event_type = 'purchase')) AS conversions"),
        )
    )


def text_rows_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per event, as an input file would hold it: thousands commas, surrounding
    spaces, counters written as ``7.0``, blank measures. The event id makes every key unique."""
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .selectExpr("*", f"{_EVENT_NUMBER} AS k")
        .selectExpr(
            "date_format(ts, 'yyyy-MM-dd') AS date",
            f"{_raw_platform('k')} AS platform",
            "concat('user-', user_id) AS account",
            "concat(event_type, '-', event_id) AS campaign",
            "CASE WHEN k % 2 = 0 THEN '' ELSE 'US' END AS country",
            "'Mobile' AS device",
            "concat(' ', format_number(value * 100, 2)) AS spend",
            "CASE WHEN k > 0 THEN string(k) END AS clicks",
            "format_number(k * 1000, 0) AS impressions",
            "concat(k, '.0') AS conversions",
        )
    )
