"""City table that the ranking scores, its head and tail, and agreement with an outside list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homespan.functions.numeric import ratio
from homespan.functions.text import contains_ignoring_case
from homespan.operators.labour import one_value, overall_rate

MARKET_COLUMNS = ("AVG_SALE_PRICE", "AVG_PRICE_PER_SQFT", "TOTAL_HOMES_SOLD", "AVG_DAYS_ON_MARKET")


def market_of_year(gold: DataFrame, year: int, property_type: str) -> DataFrame:
    return gold.filter((F.col("YEAR") == year) & (F.col("PROPERTY_TYPE") == property_type))


def combine(
    places: DataFrame,
    gold: DataFrame,
    labour: DataFrame,
    year: int,
    property_type: str,
    labour_year: int,
    key: str | Sequence[str] = "CITY",
    exact_scale: int | None = None,
    *,
    metro: str,
) -> DataFrame:
    """Places with their market year (inner join on ``key``; null keys never match) and the metro's yearly rate."""
    keys = [key] if isinstance(key, str) else list(key)
    market = market_of_year(gold, year, property_type).select(*keys, *MARKET_COLUMNS)
    rate = one_value(overall_rate(labour, metro, labour_year, exact_scale), "AVG_UNEMPLOYMENT_RATE")
    return places.join(market, keys, "inner").withColumn("UNEMPLOYMENT_RATE", rate)


def head(ranking: DataFrame, n: int = 10) -> DataFrame:
    return ranking.orderBy(F.asc_nulls_last("RANK"), "CITY").limit(n)


def tail(ranking: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` in rank order; unranked places come after all ranked ones."""
    last = ranking.orderBy(F.desc_nulls_first("RANK"), F.desc("CITY")).limit(n)
    return last.orderBy(F.asc_nulls_last("RANK"), "CITY")


def benchmark_list(spark: SparkSession, cities: Sequence[str]) -> DataFrame:
    """``POSITION, CITY`` rows of a given list, made in the JVM."""
    listed = spark.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cities])).alias("POS", "CITY"))
    return listed.select((F.col("POS") + 1).alias("POSITION"), "CITY")


def benchmark_matches(benchmark: DataFrame, ranking: DataFrame, depth: int = 20) -> DataFrame:
    """Benchmark cities that are in our first ``depth``, keeping their benchmark position."""
    return benchmark.join(head(ranking, depth).select("CITY"), "CITY", "left_semi").select("POSITION", "CITY")


def benchmark_agreement(benchmark: DataFrame, ranking: DataFrame, depth: int = 20) -> DataFrame:
    """One row: matches, benchmark size, share, and the matched names in benchmark order."""
    ours = head(ranking, depth).select("CITY").distinct().withColumn("MATCHED", F.lit(True))
    # The benchmark is a short given list, so one sorted array of its names stays small.
    names = F.array_sort(F.collect_list(F.when(F.col("MATCHED"), F.struct("POSITION", "CITY"))))
    return (
        benchmark.join(ours, "CITY", "left")
        .agg(F.count("MATCHED").alias("MATCHES"), F.count(F.lit(1)).alias("BENCHMARK_SIZE"), names.alias("N"))
        .select(
            "MATCHES",
            "BENCHMARK_SIZE",
            ratio(F.col("MATCHES"), F.col("BENCHMARK_SIZE")).alias("MATCH_SHARE"),
            F.array_join("N.CITY", ", ").alias("MATCHED_CITIES"),
        )
    )


def lookup(names: DataFrame, ranking: DataFrame) -> DataFrame:
    """Rank and score of each named city, or the note that it is not in the dataset."""
    found = ranking.select("CITY", "RANK", "OVERALL_SCORE", F.lit("ranked").alias("FOUND"))
    return names.join(found, "CITY", "left").select(
        "POSITION", "CITY", "RANK", "OVERALL_SCORE", F.coalesce("FOUND", F.lit("not in dataset")).alias("STATUS")
    )


def find_city(sources: dict[str, DataFrame], needle: str) -> DataFrame:
    """City names that contain ``needle`` in any letter case, per source."""
    hits = [
        df.filter(contains_ignoring_case(F.col("CITY"), needle)).select(F.lit(name).alias("SOURCE"), "CITY")
        for name, df in sources.items()
    ]
    out = hits[0]
    for other in hits[1:]:
        out = out.unionByName(other)
    return out
