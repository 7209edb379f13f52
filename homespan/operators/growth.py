"""Change between periods: row-to-row within a city, and between two chosen years."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homespan.functions.numeric import percent_change, ratio

PLACE = ("CITY",)


def with_previous(
    gold: DataFrame,
    value: str,
    group: Iterable[str] = PLACE,
    period: str = "YEAR",
    require_consecutive: bool = False,
    name: str = "PREVIOUS",
) -> DataFrame:
    """Add the value of the group's previous row by period.

    A gap year is bridged unless ``require_consecutive``. On gold a group has one row per
    year, so no window partition grows with the raw data; two rows of one period fail the job, since
    ``group`` then lacks a column of gold's key.
    """
    group = list(group)
    window = Window.partitionBy(*group).orderBy(period)
    before = F.lag(period).over(window)
    previous = F.lag(value).over(window)
    if require_consecutive:
        previous = F.when(before == F.col(period) - 1, previous)
    repeated = F.when(before == F.col(period), F.lit(2)).otherwise(1)
    return gold.withColumn(name, F.when(one_row(repeated, group), previous))


def period_pair(
    gold: DataFrame,
    property_type: str,
    current_year: int,
    base_year: int,
    min_sold: int | None = None,
    cities: Iterable[str] | None = None,
    place: Sequence[str] = PLACE,
) -> DataFrame:
    """Each place's current year beside its base-year price, in one pass and without a self-join.

    ``place`` are the columns that tell places apart; with the year and the type they are the key of ``gold``, so each
    maximum is one value. Two rows for one key (gold was grouped by more columns than these) fail the job instead
    of blending two places. Places without current-year rows that meet ``min_sold`` are absent, as are those whose key
    has a null; a missing base year is null.
    """
    place = list(place)
    current = F.col("YEAR") == current_year
    if min_sold is not None:
        current = current & (F.col("TOTAL_HOMES_SOLD") >= min_sold)
    rows = gold.filter(
        (F.col("PROPERTY_TYPE") == property_type)
        & F.col("YEAR").isin(current_year, base_year)
    ).dropna(subset=place)
    if cities is not None:
        rows = rows.filter(F.col("CITY").isin(*cities))

    def at(condition: Column, column: str) -> Column:
        return F.max(F.when(condition, F.col(column)))

    years = F.greatest(*[F.count_if(F.col("YEAR") == y) for y in (current_year, base_year)])
    return (
        rows.groupBy(*place)
        .agg(
            at(current, "AVG_SALE_PRICE").alias("Current_Price"),
            at(current, "AVG_DAYS_ON_MARKET").alias("Days_On_Market"),
            at(current, "TOTAL_HOMES_SOLD").alias("Sales_Volume"),
            at(F.col("YEAR") == base_year, "AVG_SALE_PRICE").alias("Base_Price"),
            F.max(current).alias("HAS_CURRENT"),
            years.alias("ROWS_A_YEAR"),
        )
        .filter(F.col("HAS_CURRENT") & one_row(F.col("ROWS_A_YEAR"), place))
        .drop("HAS_CURRENT", "ROWS_A_YEAR")
    )


def one_row(rows: Column, place: Sequence[str]) -> Column:
    """True, or an error where a key has several rows."""
    several = F.raise_error(F.lit(f"several gold rows for one of ({', '.join(place)}), year and type: name all key columns"))
    return F.when(rows <= 1, F.lit(True)).otherwise(several.cast("boolean"))


def total_appreciation(current: Column, base: Column) -> Column:
    """Percent gained since the base; null unless the base is positive."""
    return F.when(base > 0, percent_change(current, base))


def annualized_return(current: Column, base: Column, years: int) -> Column:
    """Yearly percent that compounds to the total gain; null unless the base is positive."""
    if years == 0:
        raise ValueError("the years of the two prices are equal")
    return F.when(base > 0, (F.pow(ratio(current, base), F.lit(1.0 / years)) - 1) * 100)
