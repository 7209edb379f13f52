import pytest
from pyspark.sql import functions as F

from homespan.operators import growth, labour
from homespan.plans import reports
from tests.frames import gold, values
from tests.frames import labour as rates

T = "All Residential"


def test_q7_a_gap_year_is_bridged_unless_told_otherwise(spark):
    rows = gold(spark, ("A", 2020, T, 100.0, 1, 1.0), ("A", 2022, T, 150.0, 1, 1.0), ("A", 2023, T, 120.0, 1, 1.0))
    bridged = growth.with_previous(rows, "AVG_SALE_PRICE")
    assert sorted(values(bridged, "YEAR", "PREVIOUS")) == [(2020, None), (2022, 100.0), (2023, 150.0)]
    strict = growth.with_previous(rows, "AVG_SALE_PRICE", require_consecutive=True)
    assert sorted(values(strict, "YEAR", "PREVIOUS")) == [(2020, None), (2022, None), (2023, 150.0)]


def test_period_pair_equals_the_self_join(spark):
    rows = gold(
        spark,
        ("A", 2025, T, 300.0, 60, 10.0), ("A", 2020, T, 200.0, 1, 99.0),
        ("B", 2025, T, 500.0, 40, 10.0), ("B", 2020, T, 400.0, 90, 10.0),
        ("C", 2025, T, 700.0, 80, 20.0),
        ("D", 2020, T, 900.0, 80, 20.0),
        ("E", 2025, "Condo", 1.0, 80, 20.0),
        ("F", 2025, T, 1.0, None, 20.0), ("F", 2020, T, 1.0, 5, 20.0),
        (None, 2025, T, 1.0, 80, 20.0), (None, 2020, T, 1.0, 80, 20.0),
    )
    pair = growth.period_pair(rows, T, 2025, 2020, min_sold=50)
    now = rows.filter((F.col("YEAR") == 2025) & (F.col("PROPERTY_TYPE") == T) & (F.col("TOTAL_HOMES_SOLD") >= 50))
    then = rows.filter((F.col("YEAR") == 2020) & (F.col("PROPERTY_TYPE") == T))
    joined = now.alias("n").join(then.alias("t"), F.expr("n.CITY = t.CITY"), "left").filter("n.CITY IS NOT NULL")
    want = joined.selectExpr(
        "n.CITY", "n.AVG_SALE_PRICE", "n.AVG_DAYS_ON_MARKET", "n.TOTAL_HOMES_SOLD", "t.AVG_SALE_PRICE"
    )
    assert sorted(values(pair)) == sorted(values(want)) == [("A", 300.0, 10.0, 60, 200.0), ("C", 700.0, 20.0, 80, None)]
    assert values(growth.period_pair(rows, T, 2025, 2020, 50, ["A", "Z"]), "CITY") == [("A",)]


@pytest.mark.parametrize(("base", "total"), [(200.0, 50.0), (0.0, None), (-1.0, None), (None, None)])
def test_guarded_appreciation(spark, base, total):
    df = spark.createDataFrame([(300.0, base)], "now double, base double")
    got = df.select(growth.total_appreciation(F.col("now"), F.col("base"))).first()[0]
    yearly = df.select(growth.annualized_return(F.col("now"), F.col("base"), 5)).first()[0]
    assert got == total
    if total is None:
        assert yearly is None
    else:
        assert (1 + yearly / 100) ** 5 == pytest.approx(1 + total / 100)


def test_q11_absent_year_gives_no_group_but_one_overall_row(spark):
    points = rates(spark, (2024, 4.0), (2024, 5.0), (2022, 1.0), (2024, None))
    assert values(labour.yearly_rate(points, "Metro", 2024)) == [(2024, 4.5)]
    assert values(labour.yearly_rate(points, "Metro", 2023)) == []
    assert values(labour.overall_rate(points, "Metro", 2023)) == [(None,)]
    assert values(labour.overall_rate(points, "Metro", 2024, exact_scale=2)) == [(4.5,)]


def test_other_metros_do_not_blend_into_the_rate(spark):
    from homespan.schemas import LABOUR

    points = spark.createDataFrame([("A", 2024, "January", 4.0), ("B", 2024, "January", 10.0)], LABOUR)
    assert values(labour.yearly_rate(points, "A", 2024)) == [(2024, 4.0)]
    assert values(labour.overall_rate(points, "A", 2024)) == [(4.0,)]
    assert values(labour.yearly_rate(points, "C", 2024)) == []


def two_troys(spark):
    """Gold of a city name that two metros share, beside one that is alone."""
    rows = [("Troy", "Detroit", 2020, 100.0), ("Troy", "Detroit", 2025, 150.0), ("Troy", "Albany", 2020, 200.0),
            ("Troy", "Albany", 2025, 220.0), ("Reno", "Reno", 2020, 50.0), ("Reno", "Reno", 2025, 100.0)]
    return spark.createDataFrame(
        [(c, m, y, "T", p, p, 100, 10.0, 1.0) for c, m, y, p in rows],
        "CITY string, METRO string, YEAR int, PROPERTY_TYPE string, AVG_SALE_PRICE double, AVG_PRICE_PER_SQFT double, "
        "TOTAL_HOMES_SOLD long, AVG_DAYS_ON_MARKET double, AVG_INVENTORY double",
    )


PLACE = ("CITY", "METRO")


def test_places_of_one_name_stay_apart(spark):
    gold = two_troys(spark)  # noqa: F811
    gained = reports.appreciation(gold, "T", 2025, 2020, place=PLACE)
    assert sorted(values(gained, *PLACE, "Appreciation_Pct")) == [
        ("Reno", "Reno", 100.0), ("Troy", "Albany", 10.0), ("Troy", "Detroit", 50.0)]
    unemployment = rates(spark, (2024, 4.0))
    for report in (
        reports.investment_score(gold, unemployment, "T", 2025, 2020, 2024, 1, 1e9, place=PLACE, metro="Metro"),
        reports.ultimate_score(gold, unemployment, "T", 2025, 2020, 2024, 1, place=PLACE, metro="Metro"),
        reports.top_cities(gold, "T", 2025, place=PLACE), reports.best_deals(gold, "T", 2025, 1, place=PLACE),
        reports.top_cities_min_volume(gold, "T", 2025, 1, place=PLACE), reports.top_cities_latest_year(gold, "T", place=PLACE),
    ):
        assert sorted(values(report, *PLACE)) == [("Reno", "Reno"), ("Troy", "Albany"), ("Troy", "Detroit")]
    changed = reports.yearly_change(gold, ["Troy"], "T", 2020, place=PLACE)
    assert values(changed, *PLACE, "YEAR", "PRICE_CHANGE") == [
        ("Troy", "Albany", 2020, None), ("Troy", "Albany", 2025, 20.0), ("Troy", "Detroit", 2020, None), ("Troy", "Detroit", 2025, 50.0)]
    assert values(reports.city_year_panel(gold, ["Troy"], "T", 2025, PLACE), *PLACE, "AVG_PRICE") == [
        ("Troy", "Albany", 220.0), ("Troy", "Detroit", 150.0)]
    assert values(reports.price_extremes(gold, PLACE), "PriceCategory", *PLACE) == [("LOWEST", "Reno", "Reno"), ("HIGHEST", "Troy", "Albany")]
    assert values(reports.city_metrics(gold, "T", PLACE), *PLACE)[2:] == [("Troy", "Albany")] * 2 + [("Troy", "Detroit")] * 2


def test_a_key_that_blends_places_fails(spark):
    gold = two_troys(spark)
    for report in (
        reports.appreciation(gold, "T", 2025, 2020), reports.yearly_change(gold, ["Troy"], "T", 2020),
    ):
        with pytest.raises(Exception, match="name all key columns"):
            report.collect()
    assert values(reports.appreciation(gold.filter("CITY = 'Reno'"), "T", 2025, 2020), "CITY") == [("Reno",)]
