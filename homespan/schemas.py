"""Declared schemas of every layer, and the check that a frame carries them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    """``name type, ...`` of atomic types; made without a session, so that modules import anywhere."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


MARKET_COLUMNS = (
    "CITY", "STATE", "STATE_CODE", "PARENT_METRO_REGION", "PERIOD_END", "PROPERTY_TYPE",
    "MEDIAN_SALE_PRICE", "MEDIAN_LIST_PRICE", "MEDIAN_PPSF", "HOMES_SOLD", "INVENTORY", "MEDIAN_DOM",
)

MARKET = T.StructType([T.StructField(name, T.StringType()) for name in MARKET_COLUMNS])

SILVER = _struct(
    "CITY string, STATE string, STATE_CODE string, PARENT_METRO_REGION string, PERIOD_END string, "
    "PROPERTY_TYPE string, MEDIAN_SALE_PRICE double, MEDIAN_LIST_PRICE double, MEDIAN_PPSF double, "
    "HOMES_SOLD int, INVENTORY int, MEDIAN_DOM int, PERIOD_END_DATE date"
)

GOLD = _struct(
    "CITY string, YEAR int, PROPERTY_TYPE string, AVG_SALE_PRICE double, AVG_PRICE_PER_SQFT double, "
    "TOTAL_HOMES_SOLD bigint, AVG_DAYS_ON_MARKET double, AVG_INVENTORY double"
)

CENSUS = _struct(
    "CITY_NAME string, MEDIAN_INCOME double, MEDIAN_HOME_VALUE double, POPULATION bigint, "
    "BACHELORS_DEGREE bigint, POPULATION_25PLUS bigint, TOTAL_POP_RACE bigint, WHITE_NON_HISPANIC bigint, "
    "STATE_CODE string, PLACE_CODE string, CITY string, DIVERSITY_PCT double, BACHELORS_PCT double"
)

LABOUR = _struct("METRO_AREA string, YEAR int, MONTH string, UNEMPLOYMENT_RATE double")

LABOUR_PAYLOAD = (
    "Results struct<series: array<struct<seriesID: string, data: array<struct<"
    "year: string, period: string, periodName: string, value: string>>>>>"
)

SCORES = (
    "INCOME_SCORE", "EDUCATION_SCORE", "DIVERSITY_SCORE", "AFFORDABILITY_SCORE", "MARKET_SPEED_SCORE",
    "OVERALL_SCORE",
)


class SchemaMismatch(ValueError):
    """A frame lacks declared columns or carries them with other types."""


def schema_differences(df: DataFrame, declared: T.StructType) -> list[str]:
    """One line per declared column that is absent or of another type; extra columns are fine."""
    found = {f.name: f.dataType for f in df.schema}
    lines = []
    for field in declared:
        if field.name not in found:
            lines.append(f"{field.name}: missing")
        elif found[field.name] != field.dataType:
            lines.append(
                f"{field.name}: {found[field.name].simpleString()} instead of {field.dataType.simpleString()}"
            )
    return lines


def require_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    lines = schema_differences(df, declared)
    if lines:
        raise SchemaMismatch("; ".join(lines))
    return df
