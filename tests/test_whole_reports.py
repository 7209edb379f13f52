"""Registered score reports hold the reference's twenty cities, in the query and in its SQL."""

import pytest

from homespan.catalogue import queries as q
from homespan.catalogue.oracle import ORACLE_SQL
from homespan.schemas import LABOUR
from tests.frames import gold

CITIES = [f"C{i:02d}" for i in range(25)]


@pytest.fixture
def market(spark, monkeypatch):
    s = q.SETTINGS
    rows = [(c, y, s.home_type, price + i, s.score_floor, 10.0) for i, c in enumerate(CITIES)
            for y, price in ((s.base_year, 10_000.0), (s.current_year, 20_000.0))]
    stored = gold(spark, *rows)
    rates = spark.createDataFrame([(s.labour_metro, s.labour_year, "January", 4.0)], LABOUR)
    for name in ("gold_year", "gold_pair"):
        monkeypatch.setattr(q, name, lambda *_: stored)
    monkeypatch.setattr(q.star, "labour_rates", lambda *_: rates)


NAMES = ["deal_score", "investment_score", "ultimate_score", "ultimate_score_intdiv"]


@pytest.mark.parametrize("name", NAMES)
def test_score_reports_hold_twenty_cities(spark, market, name):
    assert len({r["CITY"] for r in q.QUERIES[name](spark, "").collect()}) == 20
    assert ORACLE_SQL[name].endswith("LIMIT 20")
