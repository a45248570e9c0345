"""Row-level KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyspan.functions.numbers import ratio
from tallyspan.operators.kpi import REVENUE_PER_CONVERSION
from tallyspan.schema import FILE_COLUMNS


def daily_columns() -> list[str]:
    """SQL text of the columns of :func:`ads_daily`."""
    revenue = f"conversions * {REVENUE_PER_CONVERSION}D"
    return [
        *FILE_COLUMNS,
        f"{ratio('spend', 'conversions', 'positive')} AS cac",
        f"{ratio(revenue, 'spend', 'positive')} AS roas",
    ]


def ads_daily(df: DataFrame) -> DataFrame:
    """Each fact row with its own CAC and ROAS, unrounded; NULL where the divisor is not
    positive. A projection: it keeps the partitioning of its input."""
    return df.selectExpr(*daily_columns())
