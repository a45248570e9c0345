"""The two date windows a comparison runs over.

Bounds are worked out first and reach the fact scan as literals. That is what lets the range
be pushed into the file reader and prune date partitions; a join against a one-row relation
of bounds would do neither.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.dates import parse_day

DEFAULT_DAYS = 30


@dataclass(frozen=True)
class Periods:
    """Inclusive bounds of the current window and of the one before it, and the SQL text of the
    tests for them."""

    current_from: dt.date | None
    current_to: dt.date | None
    prior_from: dt.date | None
    prior_to: dt.date | None

    def in_current(self, day: str = "date") -> str:
        return _between(day, self.current_from, self.current_to)

    def in_prior(self, day: str = "date") -> str:
        return _between(day, self.prior_from, self.prior_to)

    def in_either(self, day: str = "date") -> str:
        """One range over both windows; reversed windows leave it empty."""
        return _between(day, self.prior_from, self.current_to)


def _between(day: str, low: dt.date | None, high: dt.date | None) -> str:
    if low is None or high is None:
        return "false"
    return f"`{day}` BETWEEN DATE'{low.isoformat()}' AND DATE'{high.isoformat()}'"


def resolve_anchor(df: DataFrame, date_col: str = "date") -> dt.date | None:
    """The newest date, or None for an empty input. Reads the date column only."""
    return df.agg(F.max(date_col)).first()[0]


def rolling_periods(anchor: dt.date | None, n_days: int = DEFAULT_DAYS) -> Periods:
    """The ``n_days`` ending at the anchor, and the ``n_days`` before those."""
    if anchor is None:
        return Periods(None, None, None, None)
    return explicit_periods(anchor - dt.timedelta(days=n_days - 1), anchor)


def explicit_periods(start: dt.date | None, end: dt.date | None) -> Periods:
    """From ``start`` to ``end``, and as many days right before.

    Reversed bounds are kept as they are: they describe an empty window.
    """
    if start is None or end is None:
        return Periods(start, end, None, None)
    length = end - start + dt.timedelta(days=1)
    return Periods(start, end, start - length, end - length)


def window_periods(
    start: str | dt.date | None,
    end: str | dt.date | None,
    anchor: Callable[[], dt.date | None],
    n_days: int = DEFAULT_DAYS,
) -> Periods:
    """Explicit bounds, each one filled on its own from the anchor when absent.

    ``anchor`` is only called when a bound is missing, so a full request costs no extra job.
    """
    low = None if start is None else parse_day(start)
    high = None if end is None else parse_day(end)
    if low is None or high is None:
        newest = anchor()
        if newest is not None:
            low = newest - dt.timedelta(days=n_days - 1) if low is None else low
            high = newest if high is None else high
    return explicit_periods(low, high)


def request_bounds(request: str) -> tuple[str | None, str | None]:
    """``start`` and ``end`` of a JSON request. Missing and null both mean "use the default";
    empty text does not, and fails later as no date."""
    fields = json.loads(request)
    if not isinstance(fields, dict):
        raise ValueError("the request must be a JSON object")
    start, end = (fields.get(name) for name in ("start", "end"))
    return (None if start is None else str(start), None if end is None else str(end))


def periods_from_json(df: DataFrame, request: str) -> Periods:
    """The windows a JSON request asks for, missing bounds taken from the newest date."""
    start, end = request_bounds(request)
    return window_periods(start, end, lambda: resolve_anchor(df))


def period_tag(periods: Periods, day: str = "date") -> str:
    """SQL text giving ``'last'``, ``'prev'`` or NULL."""
    return (
        f"CASE WHEN {periods.in_current(day)} THEN 'last' "
        f"WHEN {periods.in_prior(day)} THEN 'prev' END"
    )
