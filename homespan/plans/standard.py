"""Every report under its usual parameters, by name, over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from homespan.config import MarketSettings
from homespan.operators import ranking
from homespan.operators.profile import largest_places
from homespan.plans import reports
from homespan.sources.tables import preview

# How the rows of each report are ordered, and of its stored table; a minus is descending. Reports of one row have no order.
REPORT_ORDERS: dict[str, tuple[str, ...]] = {
    "gold_preview": ("CITY", "YEAR", "PROPERTY_TYPE"),
    "price_ranges": ("-HighestAvgPrice", "PROPERTY_TYPE"),
    "price_extremes": ("-PriceCategory", "PROPERTY_TYPE"),
    "top_cities_latest_year": ("-AVG_SALE_PRICE", "CITY"),
    "top_cities_min_volume": ("-AVG_SALE_PRICE", "CITY"),
    "best_deals": ("DealScore", "CITY"),
    "investment_score": ("Investment_Score", "CITY"),
    "ultimate_score": ("Ultimate_Score", "CITY"),
    "top_cities": ("-AVG_PRICE", "CITY"),
    "yearly_trend": ("YEAR",),
    "city_year_panel": ("CITY", "YEAR"),
    "yearly_change": ("CITY", "YEAR"),
    "price_trend": ("YEAR", "PROPERTY_TYPE"),
    "property_types": ("PROPERTY_TYPE",),
    "city_metrics": ("CITY", "YEAR", "PROPERTY_TYPE"),
    "largest_places": ("-POPULATION", "CITY"),
    "ranking_head": ("RANK", "CITY"),
    "ranking_tail": ("RANK", "CITY"),
    "benchmark_overlap": ("POSITION",),
    "benchmark_lookup": ("POSITION",),
}


def market_reports(gold: DataFrame, labour: DataFrame, settings: MarketSettings) -> dict[str, DataFrame]:
    """Reports over gold; nothing runs until one of them is asked for rows."""
    s = settings
    return {
        "gold_preview": preview(gold, ["CITY", "YEAR", "PROPERTY_TYPE"]),
        "price_ranges": reports.price_ranges(gold),
        "price_extremes": reports.price_extremes(gold),
        "top_cities_latest_year": reports.top_cities_latest_year(gold, s.home_type),
        "top_cities_min_volume": reports.top_cities_min_volume(gold, s.home_type, s.current_year, s.list_floor),
        "best_deals": reports.best_deals(gold, s.home_type, s.current_year, s.deal_floor),
        "investment_score": reports.investment_score(
            gold, labour, s.home_type, s.current_year, s.base_year, s.labour_year, s.score_floor, s.price_cap,
            s.focus_cities, exact_scale=s.exact_scale, metro=s.labour_metro,
        ),
        "ultimate_score": reports.ultimate_score(
            gold, labour, s.home_type, s.current_year, s.base_year, s.labour_year, s.score_floor,
            s.focus_cities, exact_scale=s.exact_scale, metro=s.labour_metro,
        ),
        "top_cities": reports.top_cities(gold, s.all_types, s.ranking_year),
        "yearly_trend": reports.yearly_trend(gold, s.trend_city, s.all_types, s.trend_first_year),
        "city_year_panel": reports.city_year_panel(gold, s.panel_cities, s.all_types, s.panel_first_year),
        "yearly_change": reports.yearly_change(gold, s.panel_cities, s.all_types, s.change_first_year),
        "price_trend": reports.price_trend(gold, s.trend_first_year, s.current_year),
        "property_types": reports.property_types(gold),
        "city_metrics": reports.city_metrics(gold),
        "kpi_cards": reports.kpi_cards(gold),
    }


def place_reports(places: DataFrame, ranked: DataFrame, settings: MarketSettings) -> dict[str, DataFrame]:
    """Reports over the stored places and their stored ranking."""
    spark = ranked.sparkSession
    benchmark = ranking.benchmark_list(spark, settings.benchmark_cities)
    return {
        "largest_places": largest_places(places),
        "ranking_head": ranking.head(ranked, settings.benchmark_depth),
        "ranking_tail": ranking.tail(ranked),
        "benchmark_overlap": ranking.benchmark_matches(benchmark, ranked, settings.benchmark_depth),
        "benchmark_agreement": ranking.benchmark_agreement(benchmark, ranked, settings.benchmark_depth),
        "benchmark_lookup": ranking.lookup(ranking.benchmark_list(spark, settings.benchmark_checks), ranked),
    }
