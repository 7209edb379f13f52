"""Text cleaning: sentinels, lenient and strict typing, suffix removal, substring tests."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "NA"


def blank_sentinel(col: Column, sentinel: str = MISSING) -> Column:
    """Null where the text equals the feed's marker for a missing value."""
    return F.nullif(col, F.lit(sentinel))


def to_double(col: Column) -> Column:
    """Lenient text to double: unreadable text and NaN both become null."""
    return F.nanvl(col.try_cast("double"), F.lit(None).cast("double"))


def _to_whole(col: Column, kind: str) -> Column:
    return F.coalesce(col.try_cast(kind), col.try_cast("double").try_cast(kind))


def to_int(col: Column) -> Column:
    """Lenient text to int; fractions are cut, so that ``30.5`` gives 30 rather than null."""
    return _to_whole(col, "int")


def to_long(col: Column) -> Column:
    return _to_whole(col, "bigint")


def to_day(col: Column) -> Column:
    """Lenient ISO text to date."""
    return col.try_cast("date")


def strict_double(col: Column) -> Column:
    """Text to double that fails the job on unreadable text, whatever the ANSI setting."""
    value = col.try_cast("double")
    unreadable = F.concat(F.lit("not a number: "), col)
    return F.when(col.isNotNull() & value.isNull(), F.raise_error(unreadable).cast("double")).otherwise(value)


def strip_suffixes(col: Column, suffixes: Iterable[str]) -> Column:
    """Drop one of the given endings; text without one of them stays as it is."""
    endings = "|".join(re.escape(s) for s in suffixes)
    return F.regexp_replace(col, f"(?:{endings})$", "")


def contains_ignoring_case(col: Column, needle: str) -> Column:
    """Case-insensitive literal substring test (``%`` and ``_`` have no special meaning)."""
    escaped = re.sub(r"([\\%_])", r"\\\1", needle)
    return col.ilike(f"%{escaped}%")
