"""Text expressions. All compile into whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings (lower case, trimmed) that mean the same platform.
PLATFORM_ALIASES: dict[str, tuple[str, ...]] = {
    "Google": ("google", "google ads", "googleads", "adwords"),
    "Meta": ("meta", "facebook", "fb", "facebook ads", "fb ads"),
}

_MARK = "\u0001 "


def initcap_alnum(text: Column) -> Column:
    """Capitalise every run of letters and digits, lower-casing the rest.

    Spark's ``initcap`` starts a word after a space only. A mark ending in a space is put
    behind every character that is neither letter nor digit, and taken out afterwards.
    """
    marked = F.regexp_replace(text, r"([^\p{L}\p{N}])", f"$1{_MARK}")
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def canon_platform(
    text: Column, aliases: Mapping[str, Sequence[str]] = PLATFORM_ALIASES
) -> Column:
    """Known spellings to one name, anything else trimmed and capitalised. NULL stays NULL."""
    trimmed = F.trim(text)
    folded = F.lower(trimmed)
    result = None
    for name, spellings in aliases.items():
        hit = folded.isin(*spellings)
        result = F.when(hit, name) if result is None else result.when(hit, name)
    plain = initcap_alnum(trimmed)
    return plain if result is None else result.otherwise(plain)


def blank_to(text: Column, default: str) -> Column:
    """NULL and empty text become ``default``."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))
