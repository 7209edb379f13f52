"""Every year, threshold, list, weight and file name that the reports take, as parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# ---- fixed values -------------------------------------------------------------------
# Names, codes, lists, thresholds and weights that results depend on.

FEED_FILES = {
    "national": "us_national_market_tracker.tsv000",
    "state": "state_market_tracker.tsv000.gz",
    "metro": "redfin_metro_market_tracker.tsv000.gz",
    "county": "county_market_tracker.tsv000.gz",
    "city": "city_market_tracker.tsv000.gz",
    "zip": "zip_code_market_tracker.tsv000.gz",
    "neighborhood": "neighborhood_market_tracker.tsv000.gz",
}

CENSUS_VARIABLES = {
    "NAME": "CITY_NAME",
    "B19013_001E": "MEDIAN_INCOME",
    "B25077_001E": "MEDIAN_HOME_VALUE",
    "B01003_001E": "POPULATION",
    "B15003_022E": "BACHELORS_DEGREE",
    "B15003_001E": "POPULATION_25PLUS",
    "B03002_001E": "TOTAL_POP_RACE",
    "B03002_003E": "WHITE_NON_HISPANIC",
    "state": "STATE_CODE",
    "place": "PLACE_CODE",
}

PLACE_SUFFIXES = (" city, Texas", " town, Texas", " CDP, Texas")

LABOUR_SERIES = {"LAUMT481910000000003": "Dallas-Fort Worth"}

FOCUS_CITIES = (
    "Dallas", "Fort Worth", "Plano", "Irving", "Arlington", "Frisco", "McKinney", "Allen", "Garland",
    "Richardson", "Carrollton", "Grand Prairie", "Mesquite", "Lewisville", "Flower Mound", "Denton",
    "The Colony", "Coppell", "Southlake", "Grapevine", "Cedar Hill", "DeSoto", "Duncanville",
    "Farmers Branch", "Rowlett", "Wylie",
)

PANEL_CITIES = ("Coppell", "Grapevine", "Plano", "Euless", "Irving")

BENCHMARK_CITIES = (
    "Southlake", "Coppell", "Flower Mound", "Frisco", "Allen", "Plano", "McKinney", "Richardson",
    "Highland Village", "Prosper",
)

BENCHMARK_CHECKS = ("Southlake", "McKinney", "Richardson")

WEIGHTS_A = {
    "INCOME_SCORE": 0.25,
    "EDUCATION_SCORE": 0.20,
    "DIVERSITY_SCORE": 0.15,
    "AFFORDABILITY_SCORE": 0.25,
    "MARKET_SPEED_SCORE": 0.15,
}

WEIGHTS_B = {
    "INCOME_SCORE": 0.30,
    "EDUCATION_SCORE": 0.25,
    "DIVERSITY_SCORE": 0.15,
    "AFFORDABILITY_SCORE": 0.15,
    "MARKET_SPEED_SCORE": 0.15,
}

HIGHER_IS_BETTER = {
    "INCOME_SCORE": "MEDIAN_INCOME",
    "EDUCATION_SCORE": "BACHELORS_PCT",
    "DIVERSITY_SCORE": "DIVERSITY_PCT",
}

LOWER_IS_BETTER = {
    "AFFORDABILITY_SCORE": "AVG_SALE_PRICE",
    "MARKET_SPEED_SCORE": "AVG_DAYS_ON_MARKET",
}

# ---- end of fixed values ------------------------------------------------------------


@dataclass(frozen=True)
class MarketSettings:
    """Parameters of the layers and reports. The defaults are the ones the reports were written for."""

    state_code: str = "TX"
    metro_word: str = "Dallas"
    all_types: str = "All Residential"
    home_type: str = "Single Family Residential"
    current_year: int = 2025
    base_year: int = 2020
    ranking_year: int = 2024
    labour_year: int = 2024
    labour_metro: str = "Dallas-Fort Worth"
    list_floor: int = 10
    deal_floor: int = 20
    score_floor: int = 50
    price_cap: float = 600_000.0
    trend_city: str = "Dallas"
    trend_first_year: int = 2018
    panel_first_year: int = 2022
    change_first_year: int = 2020
    focus_cities: tuple[str, ...] | None = FOCUS_CITIES
    panel_cities: tuple[str, ...] = PANEL_CITIES
    benchmark_cities: tuple[str, ...] = BENCHMARK_CITIES
    benchmark_checks: tuple[str, ...] = BENCHMARK_CHECKS
    benchmark_depth: int = 20
    place_suffixes: tuple[str, ...] = PLACE_SUFFIXES
    weights: Mapping[str, float] = field(default_factory=lambda: dict(WEIGHTS_B))
    exact_scale: int | None = None
    allowed_rejects: int | None = None
    gold_view: str | None = None


@dataclass(frozen=True)
class PipelinePaths:
    """Where inputs lie and where each layer goes, all under folders that every executor can reach."""

    feeds: str
    census_payloads: str
    labour_payloads: str
    warehouse: str
    fmt: str = "parquet"

    @property
    def bronze(self) -> str:
        return f"{self.warehouse}/bronze/cities"

    @property
    def silver(self) -> str:
        return f"{self.warehouse}/silver/cities"

    @property
    def gold(self) -> str:
        return f"{self.warehouse}/gold/market_summary"

    @property
    def census(self) -> str:
        return f"{self.warehouse}/census/metro_places"

    @property
    def labour(self) -> str:
        return f"{self.warehouse}/labour/unemployment"

    @property
    def combined(self) -> str:
        return f"{self.warehouse}/rankings/combined"

    @property
    def ranking(self) -> str:
        return f"{self.warehouse}/rankings/best_places"

    @property
    def census_landing(self) -> str:
        return f"{self.warehouse}/landing/places"

    @property
    def labour_landing(self) -> str:
        return f"{self.warehouse}/landing/unemployment"

    @property
    def feed_audit(self) -> str:
        return f"{self.warehouse}/audits/feeds"

    @property
    def cleaning_audit(self) -> str:
        return f"{self.warehouse}/audits/cleaning"

    @property
    def manifest(self) -> str:
        return f"{self.warehouse}/_run.json"
