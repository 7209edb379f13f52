"""Numeric rules that the reports depend on, each under its own name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """True division; a zero or null divisor gives null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def whole_ratio(top: Column, bottom: Column) -> Column:
    """Integer division cut towards zero; a zero or null divisor gives null."""
    return F.call_function("div", top, F.nullif(bottom, F.lit(0)))


def percent_change(new: Column, old: Column) -> Column:
    return ratio(new - old, old) * 100


def round_half_even(col: Column, places: int = 0) -> Column:
    """Banker's rounding in floating point; ``F.round`` is the half-away-from-zero rule."""
    scale = float(10**places)
    return F.rint(col * scale) / scale


def mean(col: Column, exact_scale: int | None = None) -> Column:
    """Mean of a double column.

    With ``exact_scale`` the values are taken as multiples of ``10**-exact_scale`` and
    summed as integers. The result then does not depend on the order in which partitions
    are merged. A sum beyond 64 bits fails under ANSI rather than wrapping.
    """
    if exact_scale is None:
        return F.avg(col)
    unit = float(10**exact_scale)
    units = F.sum(F.rint(col * unit).cast("bigint"))
    return F.try_divide(units / F.lit(unit), F.count(col))
