"""Metrics of many windows at once.

A window's totals are the difference of two running totals, those up to its last day and those up
to the day before its first. The facts are added up by day once; running totals of all days of the
calendar between the first and last date asked for are looked up by equality. So the work is one pass over the
facts plus one over the requests, however much the windows overlap, and nothing is joined by range.

Running totals are made within months, and months are put in a row after that: no group has more rows than a
month has days, or the calendar has months.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.dates import parse_date
from tallyspan.functions.numbers import COUNT, exact_amount
from tallyspan.operators.kpi import METRICS, kpi_long, measured_rows
from tallyspan.operators.periods import DEFAULT_DAYS, resolve_anchor

#: Sums and counts of a day; a count tells a total of nothing, which is NULL, from a total of 0.
_SUMS = ("amount", "amounts", "conversions", "conversions_known")


def parse_requests(requests: DataFrame, column: str = "request") -> DataFrame:
    """JSON requests such as ``{"start": "2025-06-01"}`` to ``start`` and ``end``, beside the other columns.
    Dates may be spelled as in files. A request that is no object, or a bound that is no date, fails."""
    fields = F.from_json(F.col(f"`{column}`"), "start string, end string", {"mode": "FAILFAST"})
    parsed = requests.withColumn("_fields", fields)

    def bound(name: str) -> Column:
        text = F.col(f"_fields.{name}")
        day = parse_date(text)
        wrong = F.raise_error(F.concat(F.lit("not a date: "), F.to_json(F.col("_fields")))).cast("date")
        return F.when(text.isNotNull() & day.isNull(), wrong).otherwise(day)

    empty = F.col("_fields").isNull()
    whole = F.raise_error(F.concat(F.lit("not a request: "), F.coalesce(F.col(f"`{column}`"), F.lit("null")))).cast("boolean")
    kept = parsed.filter(F.when(empty, whole).otherwise(F.lit(True)))
    return kept.withColumns({"start": bound("start"), "end": bound("end")}).drop("_fields", column)


def running_totals(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """A row for each day from ``first`` to ``last`` with the totals from ``first`` up to it."""
    daily = (
        measured_rows(df.filter(F.col("date").between(F.lit(first), F.lit(last))))
        .groupBy("date")
        .agg(
            F.expr("sum(whole) AS whole"),
            F.expr("sum(fraction) AS fraction"),
            F.expr("count(whole) AS amounts"),
            F.expr("sum(conversions) AS conversions"),
            F.expr("count(conversions) AS conversions_known"),
        )
        .selectExpr("date", f"{exact_amount('whole', 'fraction')} AS amount", *_SUMS[1:])
    )
    calendar = df.sparkSession.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")
    )
    days = calendar.join(daily, "date", "left").withColumn("month", F.trunc("date", "month"))
    inside = Window.partitionBy("month").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    days = days.select("date", "month", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in _SUMS])
    months = days.groupBy("month").agg(*[F.max_by(c, "date").alias(c) for c in _SUMS])
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select("month", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in _SUMS])
    return days.join(months, "month").select("date", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in _SUMS])


def metrics_many(
    df: DataFrame,
    requests: DataFrame,
    change_name: str = "delta_pct",
    anchor: dt.date | None = None,
    n_days: int = DEFAULT_DAYS,
) -> DataFrame:
    """:func:`metrics` for every row of ``requests``: its columns, then the four metrics of the window from ``start``
    to ``end`` (dates) against the equally long one before it. Rows are in no order.

    A NULL ``end`` is the newest date of ``df``, a NULL ``start`` the newest date less 29 days; windows that
    are reversed or hold no rows have NULL totals. Requests without a bound to go by (an empty ``df``) have NULLs
    throughout.
    """
    named = [c for c in requests.columns if c not in ("start", "end")]
    taken = {"metric", *METRICS.names[:3], change_name} & set(named)
    if taken:
        raise ValueError(f"columns of the requests that the result needs: {', '.join(sorted(taken))}")
    spec = replace(METRICS, names=METRICS.names[:3] + (change_name,))
    newest = F.lit(anchor or resolve_anchor(df)).cast("date")
    asked = requests.select(
        F.struct(*[F.col(f"`{c}`") for c in (*named, "start", "end")]).alias("_asked"),
        F.coalesce("start", F.date_sub(newest, n_days - 1)).alias("_from"),
        F.coalesce("end", newest).alias("_to"),
    )
    # The window's last day, the day before it, and the day before the earlier window.
    asked = asked.selectExpr("_asked", "_to", "date_sub(_from, 1) AS _until", "datediff(_to, _from) + 1 AS _n")
    asked = asked.withColumn("_before", F.expr("date_sub(_until, _n)"))
    first, last = asked.filter("_n > 0").agg(F.min("_before"), F.max("_to")).first()
    if first is None:  # no window has a day
        first = last = dt.date(1970, 1, 1)
    totals = running_totals(df, first, last)

    for window, day in (("hi", "_to"), ("mid", "_until"), ("lo", "_before")):
        side = totals.select(F.col("date").alias(f"_{window}_date"), *[F.col(c).alias(f"_{window}_{c}") for c in _SUMS])
        asked = asked.join(side, (F.col(day) == F.col(f"_{window}_date")) & (F.col("_n") > 0), "left")

    def gained(name: str, known: str, late: str, early: str) -> Column:
        gain = F.col(f"_{late}_{name}") - F.col(f"_{early}_{name}")
        return F.when(F.col(f"_{late}_{known}") > F.col(f"_{early}_{known}"), gain)

    spans = (("now", "hi", "mid"), ("before", "mid", "lo"))
    sums = asked.select(
        "_asked",
        *[gained("amount", "amounts", *span).alias(f"spend_{w}") for w, *span in spans],
        *[gained("conversions", "conversions_known", *span).cast(COUNT).alias(f"conversions_{w}") for w, *span in spans],
    )
    return kpi_long(sums, spec, ["_asked"]).select("_asked.*", "metric", *spec.names)
