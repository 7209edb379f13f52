"""Tiny hand-made inputs."""

from homespan.schemas import GOLD, LABOUR, MARKET, MARKET_COLUMNS

PRICED = {
    "CITY": "Alpha", "STATE": "Texas", "STATE_CODE": "TX", "PARENT_METRO_REGION": "Dallas, TX",
    "PERIOD_END": "2020-06-30", "PROPERTY_TYPE": "All Residential", "MEDIAN_SALE_PRICE": "100000",
    "MEDIAN_LIST_PRICE": "101000", "MEDIAN_PPSF": "120.5", "HOMES_SOLD": "10", "INVENTORY": "5", "MEDIAN_DOM": "30",
}


def market(spark, *changes):
    rows = [tuple({**PRICED, **change}[c] for c in MARKET_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, MARKET)


def gold(spark, *rows):
    """Rows of (city, year, type, price, sold, days)."""
    full = [(c, y, t, p, None if p is None else p / 1000, s, d, 1.0) for c, y, t, p, s, d in rows]
    return spark.createDataFrame(full, GOLD)


def labour(spark, *rows):
    return spark.createDataFrame([("Metro", y, "January", r) for y, r in rows], LABOUR)


def values(df, *columns):
    """Rows as plain tuples, in the order Spark gives them."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
