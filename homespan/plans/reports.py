"""Reports over the gold table.

Every ``limit`` follows a total order: the measure, then key columns. Null measures sort
lowest, which is Spark's own default in both directions.

``place`` names the columns that tell places apart. Gold grouped by city alone has ``("CITY",)``; gold that keeps, say, the
metro beside the city passes both to every report, and places of one name stay apart in rows, folds, windows and ties.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homespan.functions.numeric import ratio, whole_ratio
from homespan.operators.growth import PLACE, annualized_return, period_pair, total_appreciation, with_previous
from homespan.operators.labour import one_value, overall_rate, yearly_rate
from homespan.sources.tables import materialize


def _of_type(gold: DataFrame, property_type: str) -> DataFrame:
    return gold.filter(F.col("PROPERTY_TYPE") == property_type)


# ---- prices by property type --------------------------------------------------------


def price_ranges(gold: DataFrame) -> DataFrame:
    """Highest, lowest and mean city price per property type."""
    price = F.col("AVG_SALE_PRICE")
    return (
        gold.filter(price.isNotNull())
        .groupBy("PROPERTY_TYPE")
        .agg(
            F.max(price).alias("HighestAvgPrice"),
            F.min(price).alias("LowestAvgPrice"),
            F.avg(price).alias("OverallAvgPrice"),
            F.count(F.lit(1)).alias("TotalRecords"),
        )
        .orderBy(F.desc("HighestAvgPrice"), "PROPERTY_TYPE")
    )


def price_extremes(gold: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """The dearest and the cheapest city-year of each property type.

    Both come from one aggregation with map-side folding: the least (price, city, year)
    triple, and the least triple with the price negated, so that ties resolve alike.
    """
    price = F.col("AVG_SALE_PRICE")
    rest = (*place, "YEAR", "TOTAL_HOMES_SOLD")

    def first_by(order: Column) -> Column:
        return F.min(F.struct(order.alias("ORDER_BY"), *rest, price.alias("AVG_SALE_PRICE")))

    def tagged(tag: str, found: str) -> Column:
        fields = (*place, "YEAR", "AVG_SALE_PRICE", "TOTAL_HOMES_SOLD")
        return F.struct(F.lit(tag).alias("PriceCategory"), *[F.col(f"{found}.{f}").alias(f) for f in fields])

    per_type = (
        gold.filter(price.isNotNull())
        .groupBy("PROPERTY_TYPE")
        .agg(first_by(-price).alias("TOP"), first_by(price).alias("BOTTOM"))
    )
    rows = per_type.select("PROPERTY_TYPE", F.inline(F.array(tagged("HIGHEST", "TOP"), tagged("LOWEST", "BOTTOM"))))
    return rows.select(
        "PriceCategory", "PROPERTY_TYPE", *place, "YEAR", "AVG_SALE_PRICE", "TOTAL_HOMES_SOLD"
    ).orderBy(F.desc("PriceCategory"), "PROPERTY_TYPE")


# ---- top lists ----------------------------------------------------------------------


def top_cities_latest_year(
    gold: DataFrame, property_type: str, n: int = 10, place: Sequence[str] = PLACE
) -> DataFrame:
    """Dearest cities of a type in the latest year of the whole table, whatever the type.

    Reads ``gold`` twice; pass a table stored by year. The latest year then comes from its folders' names alone, and at run
    time the rows are read from that year's files only.
    """
    latest = gold.agg(F.max("YEAR")).scalar()
    return (
        _of_type(gold, property_type)
        .filter((F.col("YEAR") == latest) & F.col("AVG_SALE_PRICE").isNotNull())
        .select(*place, "YEAR", "AVG_SALE_PRICE", "AVG_PRICE_PER_SQFT", "TOTAL_HOMES_SOLD")
        .orderBy(F.desc("AVG_SALE_PRICE"), *place)
        .limit(n)
    )


def top_cities_min_volume(
    gold: DataFrame, property_type: str, year: int, min_sold: int, n: int = 10, place: Sequence[str] = PLACE
) -> DataFrame:
    """Dearest cities of a type and year with enough sales to trust the price."""
    return (
        _of_type(gold, property_type)
        .filter(
            (F.col("YEAR") == year) & (F.col("TOTAL_HOMES_SOLD") >= min_sold) & F.col("AVG_SALE_PRICE").isNotNull()
        )
        .select(*place, "PROPERTY_TYPE", "YEAR", "AVG_SALE_PRICE", "AVG_PRICE_PER_SQFT", "TOTAL_HOMES_SOLD")
        .orderBy(F.desc("AVG_SALE_PRICE"), *place)
        .limit(n)
    )


def deal_score() -> Column:
    """Low for cheap, fast and busy markets."""
    return (
        F.col("AVG_SALE_PRICE") / 1_000_000.0 + F.col("AVG_DAYS_ON_MARKET") / 100.0 - F.col("TOTAL_HOMES_SOLD") / 100.0
    )


def best_deals(
    gold: DataFrame, property_type: str, year: int, min_sold: int, n: int = 20, place: Sequence[str] = PLACE
) -> DataFrame:
    return (
        _of_type(gold, property_type)
        .filter(
            (F.col("YEAR") == year)
            & (F.col("TOTAL_HOMES_SOLD") >= min_sold)
            & F.col("AVG_DAYS_ON_MARKET").isNotNull()
            & F.col("AVG_SALE_PRICE").isNotNull()
        )
        .select(
            *place, "YEAR", "PROPERTY_TYPE", "AVG_SALE_PRICE", "AVG_DAYS_ON_MARKET", "TOTAL_HOMES_SOLD",
            "AVG_PRICE_PER_SQFT", deal_score().alias("DealScore"),
        )
        .orderBy("DealScore", *place)
        .limit(n)
    )


def top_cities(
    gold: DataFrame, property_type: str, year: int, n: int = 10, place: Sequence[str] = PLACE
) -> DataFrame:
    """Dearest cities of a year by rounded mean price, with days on market and total sold."""
    return (
        _of_type(gold, property_type)
        .filter(F.col("YEAR") == year)
        .groupBy(*place)
        .agg(
            F.round(F.avg("AVG_SALE_PRICE"), 0).alias("AVG_PRICE"),
            F.round(F.avg("AVG_DAYS_ON_MARKET"), 0).alias("AVG_DOM"),
            F.sum("TOTAL_HOMES_SOLD").alias("TOTAL_SOLD"),
        )
        .orderBy(F.desc("AVG_PRICE"), *place)
        .limit(n)
    )


# ---- trends -------------------------------------------------------------------------


def yearly_trend(gold: DataFrame, city: str, property_type: str, first_year: int) -> DataFrame:
    """One city's price and volume per year."""
    return (
        _of_type(gold, property_type)
        .filter((F.col("CITY") == city) & (F.col("YEAR") >= first_year))
        .groupBy("YEAR")
        .agg(
            F.round(F.avg("AVG_SALE_PRICE"), 0).alias("AVG_PRICE"),
            F.round(F.sum("TOTAL_HOMES_SOLD"), 0).alias("TOTAL_SOLD"),
        )
        .orderBy("YEAR")
    )


def _named_cities(gold: DataFrame, cities: Iterable[str], property_type: str, first_year: int) -> DataFrame:
    return _of_type(gold, property_type).filter(F.col("CITY").isin(*cities) & (F.col("YEAR") >= first_year))


def city_year_panel(
    gold: DataFrame, cities: Iterable[str], property_type: str, first_year: int, place: Sequence[str] = PLACE
) -> DataFrame:
    return (
        _named_cities(gold, cities, property_type, first_year)
        .select(
            *place,
            "YEAR",
            F.round("AVG_SALE_PRICE", 0).alias("AVG_PRICE"),
            F.round("AVG_DAYS_ON_MARKET", 0).alias("DAYS_ON_MARKET"),
        )
        .orderBy(*place, "YEAR")
    )


def yearly_change(
    gold: DataFrame,
    cities: Iterable[str],
    property_type: str,
    first_year: int,
    require_consecutive: bool = False,
    place: Sequence[str] = PLACE,
) -> DataFrame:
    """Price change against the previous kept year; each city's first kept year has none."""
    price, previous = F.col("AVG_SALE_PRICE"), F.col("PREVIOUS")
    rows = _named_cities(gold, cities, property_type, first_year)
    return (
        with_previous(rows, "AVG_SALE_PRICE", place, require_consecutive=require_consecutive)
        .select(
            *place,
            "YEAR",
            F.round(price, 0).alias("AVG_PRICE"),
            F.round(price - previous, 0).alias("PRICE_CHANGE"),
            F.round(ratio(price - previous, previous) * 100, 1).alias("PCT_CHANGE"),
        )
        .orderBy(*place, "YEAR")
    )


# ---- two-year scores ----------------------------------------------------------------


def appreciation(
    gold: DataFrame,
    property_type: str,
    current_year: int,
    base_year: int,
    min_sold: int | None = None,
    cities: Iterable[str] | None = None,
    place: Sequence[str] = PLACE,
) -> DataFrame:
    """Total gain and annualised return of every city that has both years."""
    now, base = F.col("Current_Price"), F.col("Base_Price")
    return (
        period_pair(gold, property_type, current_year, base_year, min_sold, cities, place)
        .filter(base.isNotNull())
        .withColumns(
            {
                "Appreciation_Pct": total_appreciation(now, base),
                "Annualized_Return_Pct": annualized_return(now, base, current_year - base_year),
            }
        )
    )


def investment_score(
    gold: DataFrame,
    labour: DataFrame,
    property_type: str,
    current_year: int,
    base_year: int,
    labour_year: int,
    min_sold: int,
    price_cap: float,
    cities: Iterable[str] | None = None,
    n: int = 20,
    exact_scale: int | None = None,
    place: Sequence[str] = PLACE,
    *,
    metro: str,
) -> DataFrame:
    """Lowest score is best: cheap, appreciating, low unemployment. Empty when the labour year is absent."""
    rate = yearly_rate(labour, metro, labour_year, exact_scale)
    found = one_value(rate.select(F.struct("AVG_UNEMPLOYMENT_RATE").alias("RATE")), "RATE")
    gain = F.coalesce("Annualized_Return_Pct", F.lit(0.0))
    score = F.col("Current_Price") / 100_000.0 * 0.3 + (100 - gain) * 0.5 + F.col("Unemployment_Rate") * 0.2
    return (
        appreciation(gold, property_type, current_year, base_year, min_sold, cities, place)
        .filter(F.col("Current_Price") < price_cap)
        .withColumn("RATE", found)
        .filter(F.col("RATE").isNotNull())
        .withColumn("Unemployment_Rate", F.col("RATE.AVG_UNEMPLOYMENT_RATE"))
        .select(
            *place, "Current_Price", "Days_On_Market", "Sales_Volume", "Base_Price", "Unemployment_Rate",
            "Appreciation_Pct", "Annualized_Return_Pct", score.alias("Investment_Score"),
        )
        .orderBy("Investment_Score", *place)
        .limit(n)
    )


def ultimate_score(
    gold: DataFrame,
    labour: DataFrame,
    property_type: str,
    current_year: int,
    base_year: int,
    labour_year: int,
    min_sold: int,
    cities: Iterable[str] | None = None,
    integer_volume_ratio: bool = False,
    n: int = 20,
    exact_scale: int | None = None,
    place: Sequence[str] = PLACE,
    *,
    metro: str,
) -> DataFrame:
    """Price, speed, volume, appreciation and unemployment in one score; lowest is best.

    The maxima are over every city with a current year, also those without a base year. Both they and the rows come
    from the city-level pair, which is stored in the checkpoint folder when the report is asked for, so that whatever
    gold is made of is read and grouped once under any settings. ``integer_volume_ratio`` divides volumes as whole
    numbers. A missing labour year leaves the score null.
    """
    pair = materialize(period_pair(gold, property_type, current_year, base_year, min_sold, cities, place))
    maxima = pair.agg(
        F.struct(
            F.max("Current_Price").alias("price"),
            F.max("Days_On_Market").alias("days"),
            F.max("Sales_Volume").alias("sold"),
        ).alias("TOP")
    )
    now, base = F.col("Current_Price"), F.col("Base_Price")
    share = (whole_ratio if integer_volume_ratio else ratio)(F.col("Sales_Volume"), F.col("TOP.sold"))
    score = (
        ratio(now, F.col("TOP.price")) * 25
        + ratio(F.col("Days_On_Market"), F.col("TOP.days")) * 20
        + (1 - share) * 15
        + F.when(base > 0, (1 - ratio(now - base, base)) * 25).otherwise(25.0)
        + F.col("Unemployment_Rate") / 10 * 15
    )
    return (
        pair.filter(base.isNotNull())
        .withColumns(
            {
                "TOP": one_value(maxima, "TOP"),
                "Unemployment_Rate": one_value(
                    overall_rate(labour, metro, labour_year, exact_scale), "AVG_UNEMPLOYMENT_RATE"
                ),
            }
        )
        .select(
            *place, "Current_Price", "Days_On_Market", "Sales_Volume", "Base_Price",
            F.round(total_appreciation(now, base), 1).alias("Appreciation_Pct"),
            "Unemployment_Rate", score.alias("Ultimate_Score"),
        )
        .orderBy("Ultimate_Score", *place)
        .limit(n)
    )


# ---- dashboard datasets -------------------------------------------------------------


def price_trend(gold: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Line chart: mean city price per year and property type."""
    return (
        gold.filter(F.col("YEAR").between(first_year, last_year))
        .groupBy("YEAR", "PROPERTY_TYPE")
        .agg(F.avg("AVG_SALE_PRICE").alias("AVG_PRICE"))
        .orderBy("YEAR", "PROPERTY_TYPE")
    )


def property_types(gold: DataFrame) -> DataFrame:
    """Slicer values."""
    return gold.select("PROPERTY_TYPE").distinct().orderBy("PROPERTY_TYPE")


def city_metrics(gold: DataFrame, property_type: str | None = None, place: Sequence[str] = PLACE) -> DataFrame:
    """Detail table, for one slicer value or all."""
    rows = gold if property_type is None else _of_type(gold, property_type)
    return rows.orderBy(*place, "YEAR", "PROPERTY_TYPE")


def kpi_cards(gold: DataFrame, property_type: str | None = None) -> DataFrame:
    """Total homes sold and mean city price, for one slicer value or all."""
    rows = gold if property_type is None else _of_type(gold, property_type)
    return rows.agg(
        F.sum("TOTAL_HOMES_SOLD").alias("TOTAL_HOMES_SOLD"), F.avg("AVG_SALE_PRICE").alias("AVG_PRICE")
    )
