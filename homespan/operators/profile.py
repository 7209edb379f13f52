"""Demographic profile of places and its match with a metro's market cities."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homespan.config import CENSUS_VARIABLES, PLACE_SUFFIXES
from homespan.functions.numeric import ratio, round_half_even
from homespan.functions.text import strip_suffixes, to_double, to_long

MONEY = ("MEDIAN_INCOME", "MEDIAN_HOME_VALUE")
COUNTS = ("POPULATION", "BACHELORS_DEGREE", "POPULATION_25PLUS", "TOTAL_POP_RACE", "WHITE_NON_HISPANIC")


def percent(fraction: Column) -> Column:
    """Percent with one decimal, halves to the even digit."""
    return round_half_even(fraction * 100, 1)


def place_profile(
    rows: DataFrame,
    variables: Mapping[str, str] = CENSUS_VARIABLES,
    suffixes: Iterable[str] = PLACE_SUFFIXES,
) -> DataFrame:
    """Typed place rows with bare city name, diversity and education percentages."""
    named = rows.withColumnsRenamed(dict(variables))
    typed = {c: to_double(F.col(c)) for c in MONEY} | {c: to_long(F.col(c)) for c in COUNTS}
    return named.withColumns(typed | {"CITY": strip_suffixes(F.col("CITY_NAME"), suffixes)}).withColumns(
        {
            "DIVERSITY_PCT": percent(1 - ratio(F.col("WHITE_NON_HISPANIC"), F.col("TOTAL_POP_RACE"))),
            "BACHELORS_PCT": percent(ratio(F.col("BACHELORS_DEGREE"), F.col("POPULATION_25PLUS"))),
        }
    )


def match_cities(places: DataFrame, cities: DataFrame, key: str = "CITY") -> DataFrame:
    """Places whose city is in ``cities``; each place at most once.

    The distinct folds ``cities`` map-side, so the join never moves its duplicates.
    """
    return places.join(cities.select(key).distinct(), key, "left_semi")


def largest_places(places: DataFrame, n: int = 20) -> DataFrame:
    columns = ["CITY", "POPULATION", "MEDIAN_INCOME", "MEDIAN_HOME_VALUE", "DIVERSITY_PCT", "BACHELORS_PCT"]
    return places.select(*columns).orderBy(F.desc("POPULATION"), "CITY").limit(n)
