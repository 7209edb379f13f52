"""Yearly unemployment of one metro from monthly rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homespan.functions.numeric import mean


def of_metro(labour: DataFrame, metro: str, year: int) -> DataFrame:
    """Only the rows of one series: means over several metros say nothing about any."""
    return labour.filter((F.col("METRO_AREA") == metro) & (F.col("YEAR") == year))


def yearly_rate(labour: DataFrame, metro: str, year: int, exact_scale: int | None = None) -> DataFrame:
    """``YEAR, AVG_UNEMPLOYMENT_RATE``: one row, or none when the metro has no row in the year."""
    rate = mean(F.col("UNEMPLOYMENT_RATE"), exact_scale).alias("AVG_UNEMPLOYMENT_RATE")
    return of_metro(labour, metro, year).groupBy("YEAR").agg(rate)


def overall_rate(labour: DataFrame, metro: str, year: int, exact_scale: int | None = None) -> DataFrame:
    """``AVG_UNEMPLOYMENT_RATE``: always one row, null when the metro has no row in the year."""
    rate = mean(F.col("UNEMPLOYMENT_RATE"), exact_scale).alias("AVG_UNEMPLOYMENT_RATE")
    return of_metro(labour, metro, year).agg(rate)


def one_value(one_row: DataFrame, column: str) -> Column:
    """A column of an at-most-one-row frame as a value for every row of another; no join, null if no row."""
    return one_row.select(column).scalar()
