"""Period-over-period KPIs.

Every variant is one scan with conditional sums followed by ``stack``; the variants differ in
the :class:`KpiSpec` only. The scan reads date, spend and conversions (and the dimensions),
with the date range pushed down; the shuffle carries partial sums, so neither a hot
dimension value nor the size of the fact table matters to it.

Totals are decimals, quotients fixed-point numbers of 12 decimals, and changes are differences of
these, rounded once: a change that ends in an exact half is rounded away from zero. Only the
reported values are DOUBLE.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.numbers import (
    AMOUNT,
    COUNT,
    FIXED,
    exact_amount,
    fixed_ratio,
    rounded_share,
    split_amount,
)
from tallyspan.functions.text import canon_platform
from tallyspan.operators.periods import (
    DEFAULT_DAYS,
    Periods,
    period_tag,
    request_bounds,
    resolve_anchor,
    rolling_periods,
    window_periods,
)

REVENUE_PER_CONVERSION = 100.0


@dataclass(frozen=True)
class KpiSpec:
    """How a comparison is reported."""

    # Metric name to the decimals of its values and of its absolute change.
    digits: tuple[tuple[str, int], ...]
    guard: str
    pct_scale: int
    pct_digits: int
    # Names of: current value, prior value, absolute change, relative change.
    names: tuple[str, str, str, str]


COMPACT = KpiSpec(
    digits=(("CAC", 4), ("Conversions", 4), ("ROAS", 4), ("Spend", 4)),
    guard="nonzero",
    pct_scale=1,
    pct_digits=4,
    names=("value_current", "value_prior", "abs_delta", "pct_delta"),
)
THIRTY_DAY = KpiSpec(
    digits=(("CAC", 2), ("ROAS", 4)),
    guard="positive",
    pct_scale=100,
    pct_digits=2,
    names=("last_30_value", "prior_30_value", "delta_abs", "delta_pct"),
)
SUMMARY = KpiSpec(
    digits=(("CAC", 4), ("ROAS", 4)),
    guard="nonzero",
    pct_scale=100,
    pct_digits=2,
    names=("last_30", "prior_30", "delta_abs", "delta_pct"),
)
METRICS = KpiSpec(
    digits=COMPACT.digits,
    guard="nonzero",
    pct_scale=100,
    pct_digits=2,
    names=("value_current", "value_prior", "abs_delta", "delta_pct"),
)


MEASURED = ("whole", "fraction", "conversions")


def measured(dims: Sequence[str] = ()) -> list[str]:
    """SQL text of the columns that are summed: dimensions, date, spend in two parts, conversions."""
    whole, fraction = split_amount("spend")
    return [*dims, "date", f"{whole} AS whole", f"{fraction} AS fraction", "conversions"]


def measured_rows(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fact rows cut down to what is summed. Rows that are sums already, such as the stored daily
    ones, stay as they are."""
    if set(MEASURED) <= set(df.columns):
        return df
    return df.selectExpr(*measured([f"`{c}`" for c in by]))


def window_sums(now: str, before: str) -> list[str]:
    """SQL text of the sums of both windows, given their tests."""
    return [
        f"sum(CASE WHEN {hit} THEN {measure} END) AS {measure}_{window}"
        for measure in MEASURED
        for window, hit in (("now", now), ("before", before))
    ]


def exact_totals() -> list[str]:
    """SQL text of the decimal totals, given the sums."""
    return [
        f"{exact_amount('whole_now', 'fraction_now')} AS spend_now",
        f"{exact_amount('whole_before', 'fraction_before')} AS spend_before",
        f"CAST(conversions_now AS {COUNT}) AS conversions_now",
        f"CAST(conversions_before AS {COUNT}) AS conversions_before",
    ]


def period_sums(
    df: DataFrame,
    periods: Periods,
    by: Sequence[str] = (),
    merged: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Decimal spend and conversions of both windows, one row per group (one row in all without
    groups, even for no input). A window without rows has NULL totals, not 0.

    A group with a NULL in its key is reported once per window, as an outer join of the two
    windows on that key would: NULLs do not match.

    ``merged`` gives expressions that bring several values of a dimension together. They are
    applied to the groups of the raw values, not to the rows; NULL must stay NULL.

    ``df`` holds fact rows or sums of them (see :func:`measured_rows`); so it may for all reports here.
    """
    dims = [f"`{c}`" for c in by]
    rows = measured_rows(df.filter(periods.in_either()), by)
    sums = [F.expr(e) for e in window_sums(periods.in_current(), periods.in_prior())]
    if by:
        # The tag only splits groups whose key holds a NULL; other rows share a NULL tag.
        unmatched = " OR ".join(f"{c} IS NULL" for c in dims)
        tag = F.expr(f"CASE WHEN {unmatched} THEN {period_tag(periods)} END AS _tag")
        totals = rows.groupBy(*by, tag).agg(*sums)
    else:
        totals = rows.agg(*sums)
    if merged:
        again = [f"{measure}_{window}" for measure in MEASURED for window in ("now", "before")]
        totals = (
            totals.withColumns(dict(merged))
            .groupBy(*by, "_tag")
            .agg(*[F.expr(f"sum({c}) AS {c}") for c in again])
        )
    return totals.selectExpr(*dims, *exact_totals())


def period_totals(
    df: DataFrame,
    periods: Periods,
    by: Sequence[str] = (),
    merged: Mapping[str, Column] | None = None,
) -> DataFrame:
    """:func:`period_sums` as DOUBLE."""
    sums = period_sums(df, periods, by, merged)
    names = ("spend_now", "spend_before", "conversions_now", "conversions_before")
    return sums.selectExpr(*[f"`{c}`" for c in by], *[f"double({c}) AS {c}" for c in names])


def _metric(name: str, window: str, guard: str) -> str:
    spend = f"CAST(spend_{window} AS {AMOUNT})"
    conversions = f"CAST(conversions_{window} AS {COUNT})"
    if name == "CAC":
        return fixed_ratio(spend, conversions, guard)
    if name == "ROAS":
        revenue = f"CAST({conversions} * {int(REVENUE_PER_CONVERSION)} AS DECIMAL(22, 0))"
        return fixed_ratio(revenue, spend, guard)
    return f"CAST({({'Spend': spend, 'Conversions': conversions})[name]} AS {FIXED})"


def metric_cells(spec: KpiSpec) -> str:
    """SQL text that turns totals into a row per metric: ``metric``, ``_now``, ``_before``."""
    cells = ", ".join(
        f"'{name}', {_metric(name, 'now', spec.guard)}, {_metric(name, 'before', spec.guard)}"
        for name, _ in spec.digits
    )
    return f"stack({len(spec.digits)}, {cells}) AS (metric, _now, _before)"


def reported(spec: KpiSpec) -> list[str]:
    """SQL text of the reported columns, given the rows of :func:`metric_cells`."""
    change = "(_now - _before)"
    now, before, absolute, relative = spec.names
    return [
        "metric",
        f"{_rounded('_now', spec)} AS {now}",
        f"{_rounded('_before', spec)} AS {before}",
        f"{_rounded(change, spec)} AS {absolute}",
        f"{rounded_share(change, '_before', spec.pct_scale, spec.pct_digits)} AS {relative}",
    ]


def kpi_long(totals: DataFrame, spec: KpiSpec, by: Sequence[str] = ()) -> DataFrame:
    """Totals to one row per metric. Changes are taken on unrounded values and rounded once."""
    dims = [f"`{c}`" for c in by]
    return totals.selectExpr(*dims, metric_cells(spec)).selectExpr(*dims, *reported(spec))


def _rounded(value: str, spec: KpiSpec) -> str:
    """To the decimals of the row's metric; ``round`` wants their number as a constant."""
    usual = spec.digits[-1][1]
    text = f"round({value}, {usual})"
    for name, digits in spec.digits:
        if digits != usual:
            text = f"CASE WHEN metric = '{name}' THEN round({value}, {digits}) ELSE {text} END"
    return f"double({text})"


def _rolling(df: DataFrame, n_days: int, anchor: dt.date | None) -> Periods:
    return rolling_periods(resolve_anchor(df) if anchor is None else anchor, n_days)


def kpi_compact(
    df: DataFrame, n_days: int = DEFAULT_DAYS, anchor: dt.date | None = None
) -> DataFrame:
    """CAC, conversions, ROAS and spend of the last ``n_days`` against the ``n_days`` before;
    the relative change is a fraction. Pass ``anchor`` when the newest date is known."""
    return kpi_long(period_sums(df, _rolling(df, n_days, anchor)), COMPACT).orderBy("metric")


def kpi_30d_vs_prior(
    df: DataFrame, n_days: int = DEFAULT_DAYS, anchor: dt.date | None = None
) -> DataFrame:
    """CAC and ROAS only; negative totals give NULL; the relative change is a percentage."""
    return kpi_long(period_sums(df, _rolling(df, n_days, anchor)), THIRTY_DAY).orderBy("metric")


def kpi_summary(
    df: DataFrame, n_days: int = DEFAULT_DAYS, anchor: dt.date | None = None
) -> DataFrame:
    """CAC and ROAS of :func:`kpi_compact` under short names, with percentages."""
    return kpi_long(period_sums(df, _rolling(df, n_days, anchor)), SUMMARY).orderBy("metric")


def kpi_by(
    df: DataFrame,
    dims: Sequence[str] = ("platform",),
    canon: bool = True,
    spec: KpiSpec = THIRTY_DAY,
    n_days: int = DEFAULT_DAYS,
    anchor: dt.date | None = None,
) -> DataFrame:
    """The comparison per dimension value. The anchor is the newest date of the whole input.

    ``canon`` merges the spellings of a platform when it is among the dimensions.
    """
    dims = list(dims)
    periods = _rolling(df, n_days, anchor)
    merged = {"platform": canon_platform(F.col("platform"))} if canon and "platform" in dims else None
    ordered = [F.col(c).asc_nulls_last() for c in dims]
    totals = period_sums(df, periods, dims, merged)
    return kpi_long(totals, spec, dims).orderBy(*ordered, "metric")


def metrics(
    df: DataFrame,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    change_name: str = "delta_pct",
    anchor: dt.date | None = None,
) -> DataFrame:
    """All four metrics of an explicit window against the equally long one before it.

    A missing ``end`` is the newest date, a missing ``start`` the newest date less 29 days,
    each on its own. ``change_name`` renames the last column (``pct_delta`` is also in use).
    """
    periods = window_periods(
        start, end, lambda: resolve_anchor(df) if anchor is None else anchor
    )
    return metrics_of(df, periods, change_name)


def metrics_of(df: DataFrame, periods: Periods, change_name: str = "delta_pct") -> DataFrame:
    """:func:`metrics` for windows already worked out."""
    spec = replace(METRICS, names=METRICS.names[:3] + (change_name,))
    return kpi_long(period_sums(df, periods), spec).orderBy("metric")


def metrics_request(df: DataFrame, request: str, anchor: dt.date | None = None) -> DataFrame:
    """:func:`metrics` for a JSON request such as ``{"start": "2025-06-01"}``."""
    start, end = request_bounds(request)
    return metrics(df, start, end, anchor=anchor)

