"""Number expressions: lenient parsing, guarded ratios, stable sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space a number may be surrounded by.
_OUTER_SPACE = (
    " \t\n\v\f\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def number_body(text: Column) -> Column:
    """The text of a number without thousands commas and outer white space; NULL, which is how
    the file reader delivers empty text, becomes empty."""
    bare = F.replace(F.coalesce(text, F.lit("")), F.lit(","), F.lit(""))
    return F.btrim(bare, F.lit(_OUTER_SPACE))


def body_to_double(body: Column) -> Column:
    """A number body to DOUBLE. NULL for empty text and for text that is no decimal number.

    The character test shuts out what the cast alone would take: type suffixes ("12d"), hex
    floats, "NaN" and "Infinity".
    """
    return F.when(body.rlike(r"^[0-9eE.+\-]+$"), body.try_cast("double"))


def is_finite(number: Column) -> Column:
    return F.abs(number) < float("inf")


def blank_value(blank: str) -> Column:
    """What an empty measure stands for: ``'zero'`` or ``'null'``."""
    if blank not in ("zero", "null"):
        raise ValueError(f"blank must be 'zero' or 'null', not {blank!r}")
    return F.lit(0.0) if blank == "zero" else F.lit(None).cast("double")


def parse_number(text: Column, blank: str = "zero") -> Column:
    """Text to DOUBLE; text that is no finite number gives NULL."""
    body = number_body(text)
    number = body_to_double(body)
    # Adding 0 turns -0.0 into 0.0.
    return F.when(body == "", blank_value(blank)).when(is_finite(number), number + 0.0)


def is_whole(number: Column) -> Column:
    """Whether a DOUBLE is a value INT can hold."""
    return (number == F.rint(number)) & number.between(_INT_MIN, _INT_MAX)


def ratio(numerator: str, denominator: str, guard: str = "nonzero") -> str:
    """SQL text of a division that gives NULL instead of failing.

    ``guard='nonzero'`` blanks a zero denominator, ``'positive'`` also a negative one.
    """
    if guard == "nonzero":
        return f"({numerator}) / nullif({denominator}, 0D)"
    if guard == "positive":
        return f"CASE WHEN {denominator} > 0 THEN ({numerator}) / {denominator} END"
    raise ValueError(f"guard must be 'nonzero' or 'positive', not {guard!r}")


def split_amount(amount: str) -> tuple[str, str]:
    """SQL text of the whole and the fractional part of a DOUBLE.

    A sum of doubles differs in its last bits with the order rows arrive in, more so the larger
    it gets. Whole parts add up exactly as BIGINT; what the fractions leave undecided is far
    behind the digits :func:`joined_amount` keeps. NaN and infinity raise, as no total holds them.
    """
    return f"floor({finite_or_raise(amount)})", f"{amount} - floor({amount})"


def finite_or_raise(amount: str) -> str:
    """SQL text of a DOUBLE that fails the query for NaN and infinity; NULL stays NULL."""
    return (
        f"CASE WHEN {amount} IS NULL OR abs({amount}) < double('Infinity') THEN {amount} "
        f"ELSE raise_error('{amount} is not a finite number') END"
    )


def joined_amount(whole: str, fraction: str) -> str:
    """SQL text of the DOUBLE made from summed parts, exact to 9 decimals."""
    return f"double({exact_amount(whole, fraction)})"


# A total to 9 decimals, a count, and a fixed-point KPI value to 12. Larger ones fail the query.
AMOUNT, COUNT, FIXED = "DECIMAL(26, 9)", "DECIMAL(19, 0)", "DECIMAL(30, 12)"


def exact_amount(whole: str, fraction: str) -> str:
    """SQL text of the decimal made from summed parts, exact to 9 decimals."""
    return f"CAST(CAST({whole} AS DECIMAL(38, 9)) + CAST({fraction} AS DECIMAL(38, 9)) AS {AMOUNT})"


def fixed_ratio(numerator: str, denominator: str, guard: str = "nonzero") -> str:
    """SQL text of :func:`ratio` on decimals: the quotient to 12 decimals, half away from zero.

    Spark cuts the scale of a decimal quotient when its operands are wide. The remainder's share is
    below one, so taken by itself it keeps all the decimals.
    """
    if guard not in ("nonzero", "positive"):
        raise ValueError(f"guard must be 'nonzero' or 'positive', not {guard!r}")
    d = f"nullif({denominator}, 0)"
    if guard == "positive":
        d = f"CASE WHEN {denominator} > 0 THEN {denominator} END"
    rest = f"({numerator}) % ({d})"
    whole = f"CAST((({numerator}) - {rest}) / ({d}) AS DECIMAL(18, 0))"
    return f"CAST({whole} + CAST(({rest}) / ({d}) AS DECIMAL(13, 12)) AS {FIXED})"


def rounded_share(part: str, of: str, scale: int, digits: int) -> str:
    """SQL text of ``scale * part / of`` rounded half away from zero to ``digits`` decimals, as a
    DOUBLE; NULL where ``of`` is zero. The operands are fixed-point; the tie is decided on the
    remainder, not on a quotient that was rounded before."""
    n = f"(CAST({part} AS {FIXED}) * CAST({scale * 10**digits} AS DECIMAL(5, 0)))"
    d = f"nullif({of}, 0)"
    rest = f"({n} % {d})"
    away = f"CASE WHEN 2 * abs({rest}) < abs({d}) THEN 0 WHEN ({n} < 0) = ({d} < 0) THEN 1 ELSE -1 END"
    step = f"CAST({10.0**-digits:.4f} AS DECIMAL(5, 4))"
    return f"double((CAST(({n} - {rest}) / {d} AS DECIMAL(30, 0)) + {away}) * {step})"
