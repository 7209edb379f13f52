"""Registered queries: each takes ``(spark, sf_dir)`` and reads the whole of the tables it needs.

Doubles that depend on summation order or on the power function are rounded here, at the
edge, so that two engines can be compared; the library itself returns them unrounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homespan.catalogue import star_tables as star
from homespan.config import FEED_FILES, WEIGHTS_A, MarketSettings
from homespan.operators import audit, labour, layers, profile, ranking, scoring
from homespan.plans import reports
from homespan.sources.landings import PLACE_KEYS, POINT_KEYS, latest, records
from homespan.sources.payloads import labour_table, open_series, open_tables, series_payloads, table_payloads
from homespan.sources.tables import materialize, materialize_by, preview

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = MarketSettings(
    state_code="ASIA",
    metro_word="BUILD",
    all_types="ECONOMY",
    home_type="ECONOMY",
    current_year=2000,
    base_year=1995,
    ranking_year=2000,
    labour_year=2024,
    labour_metro="error",
    list_floor=1400,
    deal_floor=1400,
    score_floor=1400,
    price_cap=53_000.0,
    trend_city="NATION_3",
    trend_first_year=1996,
    panel_first_year=1997,
    change_first_year=1996,
    focus_cities=None,
    panel_cities=("NATION_1", "NATION_4", "NATION_9", "NATION_16", "NATION_23"),
    benchmark_cities=(
        "NATION_2", "NATION_5", "NATION_7", "NATION_8", "NATION_11", "NATION_13", "NATION_17", "NATION_18",
        "NATION_21", "NATION_24",
    ),
    benchmark_checks=("NATION_2", "NATION_7", "NATION_24"),
    benchmark_depth=12,
    exact_scale=2,
)
SEARCH_WORD = "nation_1"
S = SETTINGS
METRO_PLACE = ("CITY", "PARENT_METRO_REGION")


def rounded(df: DataFrame, places: int, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def gold_of(spark: SparkSession, sf_dir: str, years: star.Years | None = None) -> DataFrame:
    return layers.summarize(star.market_silver(spark, sf_dir, years), exact_scale=S.exact_scale)


def gold_year(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    return gold_of(spark, sf_dir, (year, year))


def gold_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_of(spark, sf_dir, (S.base_year, S.current_year))


# ---- sources and layers -------------------------------------------------------------


def source_row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.row_counts({name: star.table(spark, sf_dir, name) for name in star.FEED_TABLES})


def cleaning_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.cleaning_counts(star.market_feed(spark, sf_dir))


def json_payload_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.from_json("props", "k bigint")
    return star.table(spark, sf_dir, "events").select("event_id", body["k"].alias("k"))


def labour_payload_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = series_payloads(star.labour_payloads(spark, sf_dir), keep=["event_id"]).rows
    return points.select("event_id", "seriesID", "year", "period", "periodName", "value")


def labour_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = series_payloads(star.labour_payloads(spark, sf_dir)).rows
    typed = labour_table(points, {"error": "Dallas-Fort Worth"})
    return typed.groupBy("METRO_AREA", "YEAR", "MONTH").agg(
        F.count(F.lit(1)).alias("POINTS"),
        F.min("UNEMPLOYMENT_RATE").alias("LOWEST_RATE"),
        F.max("UNEMPLOYMENT_RATE").alias("HIGHEST_RATE"),
    )


def place_payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_payloads(star.place_payloads(spark, sf_dir), ["NAME", "B19013_001E", "place"]).rows


PLACE_CELLS = ("NAME", "B19013_001E", "state", "place")


def place_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of every place over responses that landed repeatedly, beside unusable ones."""
    landed = records(open_tables(star.place_landings(spark, sf_dir), PLACE_CELLS)).filter("NOT REJECTED")
    return latest(landed.drop("REJECTED", "REASON", "PAYLOAD"), PLACE_KEYS)


def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads and rows by the reason for which they were set aside, usable ones among them."""
    told = records(open_tables(star.place_landings(spark, sf_dir), PLACE_CELLS))
    payloads = F.count_if(F.col("REJECTED") | (F.col("POSITION") == 0)).alias("PAYLOADS")
    by_reason = told.groupBy(F.coalesce("REASON", F.lit("usable")).alias("REASON"))
    return by_reason.agg(payloads, F.count("POSITION").alias("ROW_COUNT"))


def labour_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest point of every series and period over responses of many points, some of which were corrected later."""
    landed = records(open_series(star.labour_landings(spark, sf_dir))).filter("NOT REJECTED")
    points = latest(landed.drop("REJECTED", "REASON", "PAYLOAD"), POINT_KEYS)
    return points.withColumn("value", F.col("value").cast("double"))


def feed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.feed_counts(spark, {"city": star.damaged_feed(spark, sf_dir)}, list(FEED_FILES))


def bronze_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One state of the damaged feed through all three layers; rows whose date cannot be read have no year."""
    bronze = layers.state_slice(star.damaged_feed(spark, sf_dir), S.state_code)
    return layers.summarize(layers.clean(bronze), exact_scale=S.exact_scale)


def bronze_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.state_slice(star.market_feed(spark, sf_dir), S.state_code)


def metro_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = layers.metro_slice(star.market_feed(spark, sf_dir), S.metro_word)
    return rows.select("CITY", "STATE", "PARENT_METRO_REGION", "MEDIAN_SALE_PRICE", "PERIOD_END")


def metro_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.metro_cities(star.market_silver(spark, sf_dir), S.metro_word)


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.clean(star.market_feed(spark, sf_dir))


def gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_of(spark, sf_dir)


def gold_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(gold_of(spark, sf_dir), layers.GOLD_KEYS)


# ---- reports ------------------------------------------------------------------------


def price_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.price_ranges(gold_of(spark, sf_dir)), 4, ["OverallAvgPrice"])


def price_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.price_extremes(gold_of(spark, sf_dir))


def top_cities_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_cities(gold_year(spark, sf_dir, S.ranking_year), S.all_types, S.ranking_year)


def city_yearly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_of(spark, sf_dir, (S.trend_first_year, None))
    return reports.yearly_trend(gold, S.trend_city, S.all_types, S.trend_first_year)


def city_year_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_of(spark, sf_dir, (S.panel_first_year, None))
    return reports.city_year_panel(gold, S.panel_cities, S.all_types, S.panel_first_year)


def yoy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_of(spark, sf_dir, (S.change_first_year, None))
    return reports.yearly_change(gold, S.panel_cities, S.all_types, S.change_first_year)


def top_cities_latest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over gold stored by year, as the pipeline stores it, so that only the latest year's files are read again."""
    return reports.top_cities_latest_year(materialize_by(gold_of(spark, sf_dir), "YEAR"), S.home_type)


def top_cities_min_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_year(spark, sf_dir, S.current_year)
    return reports.top_cities_min_volume(gold, S.home_type, S.current_year, S.list_floor)


def deal_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_year(spark, sf_dir, S.current_year)
    return reports.best_deals(gold, S.home_type, S.current_year, S.deal_floor)


def appreciation(spark: SparkSession, sf_dir: str) -> DataFrame:
    gained = reports.appreciation(gold_pair(spark, sf_dir), S.home_type, S.current_year, S.base_year, S.score_floor)
    return rounded(gained, 6, ["Appreciation_Pct", "Annualized_Return_Pct"])


def _metro_gold(spark: SparkSession, sf_dir: str, years: star.Years) -> DataFrame:
    silver = star.market_silver(spark, sf_dir, years)
    return layers.summarize(silver, (*METRO_PLACE, "YEAR", "PROPERTY_TYPE"), S.exact_scale)


def appreciation_by_metro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities of one name in several metros stay apart."""
    gold = _metro_gold(spark, sf_dir, (S.base_year, S.current_year))
    gained = reports.appreciation(gold, S.home_type, S.current_year, S.base_year, place=METRO_PLACE)
    return rounded(gained, 6, ["Appreciation_Pct", "Annualized_Return_Pct"])


def yoy_change_by_metro(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _metro_gold(spark, sf_dir, (S.change_first_year, None))
    return reports.yearly_change(gold, S.panel_cities, S.all_types, S.change_first_year, place=METRO_PLACE)


def unemployment_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labour.yearly_rate(star.labour_rates(spark, sf_dir), S.labour_metro, S.labour_year, S.exact_scale)


def investment_score(
    spark: SparkSession, sf_dir: str, min_sold: int = S.score_floor, price_cap: float = S.price_cap, n: int = 20
) -> DataFrame:
    scored = reports.investment_score(
        gold_pair(spark, sf_dir),
        star.labour_rates(spark, sf_dir),
        S.home_type,
        S.current_year,
        S.base_year,
        S.labour_year,
        min_sold,
        price_cap,
        S.focus_cities,
        n,
        exact_scale=S.exact_scale,
        metro=S.labour_metro,
    )
    return rounded(scored, 6, ["Appreciation_Pct", "Annualized_Return_Pct", "Investment_Score"])


def _ultimate(spark: SparkSession, sf_dir: str, integer_volume_ratio: bool) -> DataFrame:
    scored = reports.ultimate_score(
        gold_pair(spark, sf_dir),
        star.labour_rates(spark, sf_dir),
        S.home_type,
        S.current_year,
        S.base_year,
        S.labour_year,
        S.score_floor,
        S.focus_cities,
        integer_volume_ratio,
        exact_scale=S.exact_scale,
        metro=S.labour_metro,
    )
    return rounded(scored, 6, ["Ultimate_Score"])


def ultimate_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ultimate(spark, sf_dir, integer_volume_ratio=False)


def ultimate_score_intdiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ultimate(spark, sf_dir, integer_volume_ratio=True)


# ---- places and ranking -------------------------------------------------------------


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.place_profile(star.place_rows(spark, sf_dir), suffixes=S.place_suffixes)


def city_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir)


def largest_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.largest_places(_profile(spark, sf_dir))


def city_semi_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = layers.metro_slice(star.market_silver(spark, sf_dir), S.metro_word)
    return profile.match_cities(_profile(spark, sf_dir), cities)


def city_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = ranking.market_of_year(gold_year(spark, sf_dir, S.ranking_year), S.ranking_year, S.all_types)
    return ranking.find_city({"census": _profile(spark, sf_dir), "market": market}, SEARCH_WORD)


def city_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.combine(
        _profile(spark, sf_dir),
        gold_year(spark, sf_dir, S.ranking_year),
        star.labour_rates(spark, sf_dir),
        S.ranking_year,
        S.all_types,
        S.labour_year,
        exact_scale=S.exact_scale,
        metro=S.labour_metro,
    )


def city_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.composite_ranking(materialize(city_combined(spark, sf_dir)), S.weights)


def city_scores_profile_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    combined = materialize(city_combined(spark, sf_dir))
    return scoring.composite_ranking(combined, WEIGHTS_A, drop_bad_income=False)


def customer_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer ranked by its balance in tens, which many share; balances below zero are unscored."""
    balance = F.col("c_acctbal")
    score = F.when(balance >= 0, F.floor(balance / 10).cast("double")).alias("OVERALL_SCORE")
    return scoring.average_rank(star.table(spark, sf_dir, "customer").select("c_custkey", score))


def _listing(ranked: DataFrame) -> DataFrame:
    return ranked.select("RANK", "CITY", "OVERALL_SCORE", "MEDIAN_INCOME", "AVG_SALE_PRICE", "BACHELORS_PCT")


def ranking_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.head(_listing(city_scores(spark, sf_dir)), 10)


def ranking_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.tail(_listing(city_scores(spark, sf_dir)), 10)


def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = ranking.benchmark_list(spark, S.benchmark_cities)
    return ranking.benchmark_matches(benchmark, city_scores(spark, sf_dir), S.benchmark_depth)


def benchmark_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = ranking.benchmark_list(spark, S.benchmark_cities)
    return ranking.benchmark_agreement(benchmark, city_scores(spark, sf_dir), S.benchmark_depth)


def benchmark_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.lookup(ranking.benchmark_list(spark, S.benchmark_checks), city_scores(spark, sf_dir))


# ---- dashboard datasets -------------------------------------------------------------


def price_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = (S.base_year, S.current_year)
    return rounded(reports.price_trend(gold_of(spark, sf_dir, years), *years), 4, ["AVG_PRICE"])


def property_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows carry the same types as gold, and need no grouping first."""
    return reports.property_types(star.market_silver(spark, sf_dir))


def city_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.city_metrics(gold_of(spark, sf_dir), S.home_type)


def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.kpi_cards(gold_of(spark, sf_dir)), 4, ["AVG_PRICE"])


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        source_row_audit, cleaning_audit, json_payload_extract, labour_payload_points, labour_typed,
        place_payload_rows, place_landings, payload_rejects, labour_landings, feed_audit, bronze_to_gold, bronze_state, metro_slice, metro_cities, silver_clean, gold_summary, gold_preview,
        price_ranges, price_extremes, top_cities_report, city_yearly_trend, city_year_panel, yoy_change,
        top_cities_latest_year, top_cities_min_volume, deal_score, appreciation, appreciation_by_metro,
        yoy_change_by_metro, unemployment_year,
        investment_score, ultimate_score, ultimate_score_intdiv, city_profile, largest_places, city_semi_match,
        city_search, city_combined, customer_ranks, city_scores, city_scores_profile_a, ranking_head, ranking_tail,
        benchmark_overlap, benchmark_agreement, benchmark_lookup, price_trend, property_types, city_metrics,
        kpi_cards,
    )
}
