"""Bronze slice, silver cleaning, gold summary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homespan.functions.numeric import mean
from homespan.functions.text import blank_sentinel, to_day, to_double, to_int

GOLD_KEYS = ("CITY", "YEAR", "PROPERTY_TYPE")

MEASURES = {
    "MEDIAN_SALE_PRICE": to_double,
    "MEDIAN_LIST_PRICE": to_double,
    "MEDIAN_PPSF": to_double,
    "HOMES_SOLD": to_int,
    "INVENTORY": to_int,
    "MEDIAN_DOM": to_int,
}


def state_slice(raw: DataFrame, state_code: str) -> DataFrame:
    """Bronze: one state's rows with every source column."""
    return raw.filter(F.col("STATE_CODE") == state_code)


def metro_slice(market: DataFrame, word: str) -> DataFrame:
    """Rows whose metro name contains ``word`` (case matters)."""
    return market.filter(F.col("PARENT_METRO_REGION").contains(word))


def metro_cities(market: DataFrame, word: str) -> DataFrame:
    """Distinct cities of a metro; duplicates are folded before the shuffle."""
    return metro_slice(market, word).select("CITY").distinct()


def clean(bronze: DataFrame) -> DataFrame:
    """Silver: missing-markers to null, measures and period typed, unpriced rows dropped."""
    typed = {name: parse(blank_sentinel(F.col(name))) for name, parse in MEASURES.items()}
    typed["PERIOD_END_DATE"] = to_day(F.col("PERIOD_END"))
    return bronze.withColumns(typed).filter(F.col("MEDIAN_SALE_PRICE").isNotNull())


def between_years(silver: DataFrame, first: int, last: int) -> DataFrame:
    """Rows whose period ends within the years; a plain range that storage can prune by."""
    day = F.col("PERIOD_END_DATE")
    start, stop = (F.make_date(F.lit(y), F.lit(1), F.lit(1)) for y in (first, last + 1))
    return silver.filter((day >= start) & (day < stop))


def summarize(silver: DataFrame, keys: Iterable[str] = GOLD_KEYS, exact_scale: int | None = None) -> DataFrame:
    """Gold: one row per city, year and property type.

    The means weigh every monthly row the same. Groups fold map-side, so a city that
    holds a large share of the rows still sends one partial row per map task.
    """
    return (
        silver.withColumn("YEAR", F.year("PERIOD_END_DATE"))
        .groupBy(*keys)
        .agg(
            mean(F.col("MEDIAN_SALE_PRICE"), exact_scale).alias("AVG_SALE_PRICE"),
            mean(F.col("MEDIAN_PPSF"), exact_scale).alias("AVG_PRICE_PER_SQFT"),
            F.sum("HOMES_SOLD").alias("TOTAL_HOMES_SOLD"),
            F.avg("MEDIAN_DOM").alias("AVG_DAYS_ON_MARKET"),
            F.avg("INVENTORY").alias("AVG_INVENTORY"),
        )
    )
