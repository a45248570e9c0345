"""Date and timestamp expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def load_time(ts: dt.datetime) -> Column:
    """A literal without time zone, whatever the session's; a time that has one is put to UTC."""
    if ts.tzinfo is not None:
        ts = ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.expr(f"TIMESTAMP_NTZ'{ts.isoformat(sep=' ')}'")


# The spellings of a date; files and requests take the same.
_TIME = r"([T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?( ?(Z|[+-][0-9]{2}:?[0-9]{2}))?)?"
YEAR_FIRST = rf"([0-9]{{4}})[-/]([0-9]{{1,2}})[-/]([0-9]{{1,2}}){_TIME}"
PACKED = r"([0-9]{4})([0-9]{2})([0-9]{2})"
MONTH_FIRST = r"([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4})"


def parse_date(text: Column) -> Column:
    """Text to DATE: year-month-day (``-`` or ``/``, with or without leading zeros, a time of
    day is dropped), eight digits, or month/day/year. Anything else gives NULL."""
    body = F.btrim(text)

    day = None
    for pattern, parts in ((YEAR_FIRST, "$1-$2-$3"), (PACKED, "$1-$2-$3"), (MONTH_FIRST, "$3-$1-$2")):
        whole = rf"^{pattern}\z"
        hit, found = body.rlike(whole), F.regexp_replace(body, whole, parts).try_cast("date")
        day = F.when(hit, found) if day is None else day.when(hit, found)
    return day


def parse_day(text: str | dt.date) -> dt.date:
    """:func:`parse_date` for one text, which raises where that gives NULL. Dates stay."""
    if isinstance(text, dt.datetime):
        return text.date()
    if isinstance(text, dt.date):
        return text
    body = text.strip(" ")
    for pattern, order in ((YEAR_FIRST, (1, 2, 3)), (PACKED, (1, 2, 3)), (MONTH_FIRST, (3, 1, 2))):
        if found := re.fullmatch(pattern, body):
            return dt.date(*(int(found[k]) for k in order))
    raise ValueError(f"not a date: {text!r}")


def round_to_second(ts: Column) -> Column:
    """TIMESTAMP_NTZ to the nearest second, half up. Does not depend on the session zone."""
    moved = ts + F.make_dt_interval(secs=F.lit(0.5))
    fraction = F.date_part(F.lit("SECOND"), moved) % F.lit(1)
    return moved - F.make_dt_interval(secs=fraction)
