"""The whole run: feed audit, market layers, places, labour, then the combined ranking.

Each stage starts once the ones it reads from have been written, read back and published. The feed audit, the market layers
and labour depend on nothing and run side by side; places are matched with the silver table, so they come after the
market, beside whatever else still runs; the ranking comes last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from homespan.config import CENSUS_VARIABLES, FEED_FILES, LABOUR_SERIES, MarketSettings, PipelinePaths
from homespan.operators import audit, layers
from homespan.operators.profile import match_cities, place_profile
from homespan.operators.ranking import combine
from homespan.operators.scoring import composite_ranking
from homespan.plans.stages import Manifest, Stage, Step, Tables, run_steps
from homespan.schemas import CENSUS, GOLD, LABOUR, MARKET, SILVER, require_schema
from homespan.sources.delimited import read_feed, read_feeds
from homespan.sources.files import listing
from homespan.sources.landings import PLACE_KEYS, POINT_KEYS, land, latest
from homespan.sources.payloads import labour_table, open_series, open_tables, read_payloads
from homespan.sources.tables import publish_view
from homespan.sources.versions import published, replace_table


def _store(
    spark: SparkSession, df: DataFrame, path: str, fmt: str, partition_by: tuple[str, ...] = (), rebalance: bool = True
) -> Stage:
    written = replace_table(df, path, fmt, partition_by, rebalance=rebalance)
    return Stage(written, published(spark, written))


def run_feed_audit(spark: SparkSession, paths: PipelinePaths) -> Tables:
    """Rows, missing and unreadable cells of all seven feeds; those that have not landed are listed as such."""
    here = [grain for grain, name in FEED_FILES.items() if listing(spark, f"{paths.feeds}/{name}")]
    feeds = read_feeds(spark, paths.feeds, grains=here)
    return {"feed_audit": _store(spark, audit.feed_counts(spark, feeds, list(FEED_FILES)), paths.feed_audit, paths.fmt)}


def run_market(spark: SparkSession, settings: MarketSettings, paths: PipelinePaths) -> Tables:
    """Feed to bronze, silver and gold. Gold is stored by year, which every yearly report prunes by.

    Cells are counted by the job that cleans them and writes silver.
    """
    feed = require_schema(read_feed(spark, f"{paths.feeds}/{FEED_FILES['city']}", MARKET), MARKET)
    bronze = _store(spark, layers.state_slice(feed, settings.state_code), paths.bronze, paths.fmt)
    rows, counts = audit.watched(bronze.table, f"bronze {settings.state_code}")
    silver = _store(spark, require_schema(layers.clean(rows), SILVER), paths.silver, paths.fmt, rebalance=False)
    gold = layers.summarize(silver.table, exact_scale=settings.exact_scale)
    done = {
        "bronze": bronze,
        "silver": silver,
        "cleaning_audit": _store(spark, counts(), paths.cleaning_audit, paths.fmt),
        "gold": _store(spark, require_schema(gold, GOLD), paths.gold, paths.fmt, ("YEAR",)),
    }
    if settings.gold_view:
        publish_view(spark, paths.gold, settings.gold_view, paths.fmt)
    return done


def run_places(spark: SparkSession, settings: MarketSettings, paths: PipelinePaths, silver: DataFrame) -> Tables:
    """The newest row of every place, from all landed responses; unusable ones are set aside in the landing table."""
    opened = open_tables(read_payloads(spark, paths.census_payloads), CENSUS_VARIABLES)
    landed = land(opened, paths.census_landing, paths.fmt, settings.allowed_rejects)
    rows = latest(landed.rows, PLACE_KEYS)
    profile = require_schema(place_profile(rows, suffixes=settings.place_suffixes), CENSUS)
    matched = match_cities(profile, layers.metro_cities(silver, settings.metro_word))
    stored = _store(spark, matched.select(*CENSUS.names), paths.census, paths.fmt)
    return {"census_landing": Stage(landed.written, published(spark, landed.written)), "census": stored}


def run_labour(spark: SparkSession, settings: MarketSettings, paths: PipelinePaths) -> Tables:
    """The newest point of every series and month."""
    landed = land(open_series(read_payloads(spark, paths.labour_payloads)), paths.labour_landing, paths.fmt, settings.allowed_rejects)
    points = latest(landed.rows, POINT_KEYS)
    stored = _store(spark, require_schema(labour_table(points, LABOUR_SERIES), LABOUR), paths.labour, paths.fmt)
    return {"labour_landing": Stage(landed.written, published(spark, landed.written)), "labour": stored}


def run_ranking(
    spark: SparkSession,
    settings: MarketSettings,
    paths: PipelinePaths,
    gold: DataFrame,
    places: DataFrame,
    labour: DataFrame,
) -> Tables:
    """The combined table is stored first, since scoring reads it several times."""
    combined = combine(
        places,
        gold,
        labour,
        settings.ranking_year,
        settings.all_types,
        settings.labour_year,
        exact_scale=settings.exact_scale,
        metro=settings.labour_metro,
    )
    stored = _store(spark, combined, paths.combined, paths.fmt)
    ranking = composite_ranking(stored.table, settings.weights)
    return {"combined": stored, "ranking": _store(spark, ranking, paths.ranking, paths.fmt)}


def steps_of(spark: SparkSession, settings: MarketSettings, paths: PipelinePaths) -> dict[str, Step]:
    """The steps, what each reads from, and what its result depends on besides."""
    files = {name: listing(spark, f"{paths.feeds}/{name}") for name in FEED_FILES.values()}
    census, labour = listing(spark, paths.census_payloads), listing(spark, paths.labour_payloads)
    return {
        "feed_audit": Step((), files, lambda t: run_feed_audit(spark, paths)),
        "market": Step((), (settings, files[FEED_FILES["city"]]), lambda t: run_market(spark, settings, paths)),
        "places": Step(("market",), (settings, census), lambda t: run_places(spark, settings, paths, t["silver"].table)),
        "labour": Step((), (settings, labour), lambda t: run_labour(spark, settings, paths)),
        "ranking": Step(
            ("market", "places", "labour"),
            settings,
            lambda t: run_ranking(spark, settings, paths, t["gold"].table, t["census"].table, t["labour"].table),
        ),
    }


def run_pipeline(spark: SparkSession, settings: MarketSettings, paths: PipelinePaths, resume: bool = False) -> Tables:
    """All tables by name. An error in one stage stops those that need it, and is raised when the others are done.

    ``resume`` takes over the stages of an earlier run whose settings, input files and earlier stages are the same.
    """
    return run_steps(spark, steps_of(spark, settings, paths), Manifest(spark, paths.manifest, resume))
