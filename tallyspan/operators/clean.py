"""From text rows to typed fact rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.dates import load_time, parse_date
from tallyspan.functions.numbers import (
    blank_value,
    body_to_double,
    is_finite,
    is_whole,
    number_body,
    parse_number,
)
from tallyspan.functions.text import blank_to
from tallyspan.schema import (
    COUNTERS,
    DEFAULT_SOURCE_NAME,
    FILE_COLUMNS,
    MEASURES,
    NATURAL_KEY,
    PROVENANCE,
    SEQ,
)

MALFORMED = "_malformed"
REASON = "_reason"
RAW = "_raw"


def stamp_provenance(
    df: DataFrame, batch_ts: dt.datetime, source: str | None = None
) -> DataFrame:
    """Load time and file name on every row.

    ``source`` overrides the file name the reader found (``_file``, when there is one).
    """
    found = F.col("_file") if "_file" in df.columns else F.lit(None).cast("string")
    name = found if source is None else F.lit(source)
    return df.withColumns(
        {
            "load_date": load_time(batch_ts),
            "source_file_name": blank_to(name, DEFAULT_SOURCE_NAME),
        }
    )


def clean_numbers(
    df: DataFrame, cols: Sequence[str] = MEASURES, blank: str = "zero"
) -> DataFrame:
    """Text measures to DOUBLE: thousands commas dropped, blank as told, rubbish to NULL."""
    return df.withColumns({c: parse_number(F.col(c), blank) for c in cols})


def judge_rows(df: DataFrame, on_error: str = "fail", blank: str = "zero") -> DataFrame:
    """Text rows to typed rows with two more columns: ``_reason``, why the row cannot become a
    fact row (NULL when it can), and ``_raw``, the text it came from when it cannot.

    A row is unusable for a malformed line, a missing or unreadable date, a measure that is no
    finite number, and a counter that is no whole number in range. ``on_error='fail'`` makes
    the first such row fail the job.

    The three projections build on each other, so every text is parsed once per row.
    """
    if on_error not in ("fail", "reject"):
        raise ValueError(f"on_error must be 'fail' or 'reject', not {on_error!r}")
    bodies = df.withColumns({f"_{c}_body": number_body(F.col(c)) for c in MEASURES})
    parsed = bodies.withColumns(
        {f"_{c}": body_to_double(F.col(f"_{c}_body")) for c in MEASURES}
        | {"_day": parse_date(F.col("date"))}
    )

    faults: list[tuple[Column, str]] = []
    if MALFORMED in df.columns:
        faults.append((F.col(MALFORMED).isNotNull(), "malformed line"))
    faults.append((F.col("_day").isNull(), "date"))
    for c in MEASURES:
        number = F.col(f"_{c}")
        sound = is_finite(number)
        if c in COUNTERS:
            sound = sound & is_whole(number)
        faults.append(((F.col(f"_{c}_body") != "") & ~F.coalesce(sound, F.lit(False)), c))
    reason = F.lit(None).cast("string")
    for fault, name in reversed(faults):
        reason = F.when(fault, name).otherwise(reason)
    text_columns = [c for c in (*FILE_COLUMNS, MALFORMED) if c in df.columns]
    judged = parsed.withColumns({REASON: reason, RAW: F.struct(*text_columns)})
    unusable = F.col(REASON).isNotNull()

    typed = {"date": F.col("_day")}
    # Empty text is delivered as NULL; in a key it is a value of its own.
    typed |= {c: F.coalesce(F.col(c), F.lit("")) for c in NATURAL_KEY if c != "date"}
    for c in MEASURES:
        number = F.when(F.col(f"_{c}_body") == "", blank_value(blank)).when(
            ~unusable, F.col(f"_{c}") + 0.0
        )
        typed[c] = number.cast("int") if c in COUNTERS else number
    kept = [F.col(c) for c in (*PROVENANCE, SEQ) if c in df.columns]
    row = F.struct(
        *[column.alias(c) for c, column in typed.items()],
        *kept,
        REASON,
        F.when(unusable, F.col(RAW)).alias(RAW),
    )
    # A filter on the verdict would otherwise be moved below the projections, and drag copies
    # of all the parsing along; it cannot pass a generator.
    rows = judged.select(F.inline(F.array(row)))
    if on_error == "reject":
        return rows
    # In a filter, the alarm goes off whichever columns are asked for.
    alarm = F.concat(F.lit("unusable "), F.col(REASON), F.lit(" in "), F.to_json(RAW))
    return rows.filter(
        F.when(unusable, F.raise_error(alarm).cast("boolean")).otherwise(F.lit(True))
    )


def accepted(judged: DataFrame) -> DataFrame:
    """The usable rows of :func:`judge_rows`."""
    return judged.filter(F.col(REASON).isNull()).drop(REASON, RAW)


def rejected(judged: DataFrame) -> DataFrame:
    """The text and the fault of the unusable rows of :func:`judge_rows`."""
    return judged.filter(F.col(REASON).isNotNull()).select(
        f"{RAW}.*", *[c for c in PROVENANCE if c in judged.columns], REASON
    )


def cast_typed(
    df: DataFrame, on_error: str = "fail", blank: str = "zero"
) -> tuple[DataFrame, DataFrame]:
    """Text rows to ``(typed rows, rejected text rows)``; see :func:`judge_rows`.

    With ``on_error='fail'`` reading the typed rows fails at the first unusable row.
    """
    strict = judge_rows(df, on_error, blank)
    lenient = judge_rows(df, "reject", blank)
    good = strict.drop(REASON, RAW) if on_error == "fail" else accepted(strict)
    return good, rejected(lenient)
