import pytest

from homespan.plans import reports
from tests.frames import gold, labour, values

T = "Single Family Residential"


def test_extremes_break_ties_by_city_and_year(spark):
    rows = gold(
        spark, ("B", 2020, "x", 5.0, 1, 1.0), ("A", 2021, "x", 5.0, 2, 1.0), ("A", 2020, "x", 5.0, 3, 1.0),
        ("C", 2020, "x", 1.0, 4, 1.0), ("Z", 2020, "x", None, 5, 1.0), ("D", 2020, "y", 9.0, None, 1.0),
    )
    assert values(reports.price_extremes(rows)) == [
        ("LOWEST", "x", "C", 2020, 1.0, 4), ("LOWEST", "y", "D", 2020, 9.0, None),
        ("HIGHEST", "x", "A", 2020, 5.0, 3), ("HIGHEST", "y", "D", 2020, 9.0, None),
    ]


def test_price_ranges_ignore_unpriced_rows(spark):
    rows = gold(spark, ("A", 1, "x", 1.0, 1, 1.0), ("B", 1, "x", 3.0, 1, 1.0), ("C", 1, "x", None, 1, 1.0), ("C", 1, "y", 7.0, 1, 1.0))
    assert values(reports.price_ranges(rows)) == [("y", 7.0, 7.0, 7.0, 1), ("x", 3.0, 1.0, 2.0, 2)]


def test_q20_latest_year_is_over_all_types(spark):
    rows = gold(spark, ("A", 2024, T, 1.0, 1, 1.0), ("B", 2025, "Condo", 2.0, 1, 1.0))
    assert values(reports.top_cities_latest_year(rows, T)) == []
    assert values(reports.top_cities_latest_year(rows, "Condo"), "CITY") == [("B",)]


def test_q8_ties_at_the_cut_go_by_city(spark):
    rows = gold(spark, *[(c, 2025, T, 5.0, 20, 1.0) for c in "DCBA"], ("E", 2025, T, 9.0, 9, 1.0), ("F", 2025, T, 9.0, None, 1.0))
    assert values(reports.top_cities_min_volume(rows, T, 2025, 10, 2), "CITY") == [("A",), ("B",)]


def test_top_cities_round_and_sum(spark):
    rows = gold(spark, ("A", 2024, T, 2.5, 3, 0.5), ("B", 2024, T, 10.0, None, None), ("B", 2023, T, 99.0, 1, 1.0))
    assert values(reports.top_cities(rows, T, 2024)) == [("B", 10.0, None, None), ("A", 3.0, 1.0, 3)]


def test_trend_and_panel_filters(spark):
    rows = gold(spark, ("A", 2017, T, 1.0, 1, 1.0), ("A", 2018, T, 2.0, 2, 1.4), ("A", 2019, "c", 9.0, 9, 1.0), ("B", 2018, T, 8.0, 8, 1.5))
    assert values(reports.yearly_trend(rows, "A", T, 2018)) == [(2018, 2.0, 2)]
    assert values(reports.city_year_panel(rows, ["A", "B"], T, 2018)) == [("A", 2018, 2.0, 1.0), ("B", 2018, 8.0, 2.0)]


def test_yearly_change_starts_null_in_the_first_kept_year(spark):
    rows = gold(spark, ("A", 2019, T, 50.0, 1, 1.0), ("A", 2020, T, 100.0, 1, 1.0), ("A", 2022, T, 150.0, 1, 1.0),
                ("B", 2020, T, 0.0, 1, 1.0), ("B", 2021, T, 10.0, 1, 1.0))
    assert values(reports.yearly_change(rows, ["A", "B"], T, 2020)) == [
        ("A", 2020, 100.0, None, None), ("A", 2022, 150.0, 50.0, 50.0),
        ("B", 2020, 0.0, None, None), ("B", 2021, 10.0, 10.0, None),
    ]
    gap = reports.yearly_change(rows, ["A"], T, 2020, require_consecutive=True)
    assert values(gap, "PRICE_CHANGE") == [(None,), (None,)]


PAIRS = (
    ("A", 2025, T, 400_000.0, 100, 40.0), ("A", 2020, T, 200_000.0, 1, 1.0),
    ("B", 2025, T, 300_000.0, 50, 20.0), ("B", 2020, T, 300_000.0, 1, 1.0),
    ("C", 2025, T, 700_000.0, 60, 10.0), ("C", 2020, T, 100_000.0, 1, 1.0),
    ("D", 2025, T, 100_000.0, 200, 80.0),
    ("E", 2025, T, 100_000.0, 49, 10.0), ("E", 2020, T, 100_000.0, 1, 1.0),
    ("F", 2025, T, 500_000.0, 70, 30.0), ("F", 2020, T, 0.0, 1, 1.0),
)


def test_investment_score(spark):
    rates = labour(spark, (2024, 4.0))
    got = values(reports.investment_score(gold(spark, *PAIRS), rates, T, 2025, 2020, 2024, 50, 600_000.0, metro="Metro"))
    assert [r[0] for r in got] == ["A", "B", "F"]
    yearly = (2 ** 0.2 - 1) * 100
    assert got[0][-3:] == pytest.approx((100.0, yearly, 4 * 0.3 + (100 - yearly) * 0.5 + 0.8))
    assert got[2][-3:-1] == (None, None) and got[2][-1] == pytest.approx(1.5 + 50 + 0.8)


def test_q11_absent_labour_year_empties_one_report_and_nulls_the_other(spark):
    market, rates = gold(spark, *PAIRS), labour(spark, (2022, 4.0))
    assert values(reports.investment_score(market, rates, T, 2025, 2020, 2024, 50, 600_000.0, metro="Metro")) == []
    rows = values(reports.ultimate_score(market, rates, T, 2025, 2020, 2024, 50, metro="Metro"), "CITY", "Unemployment_Rate", "Ultimate_Score")
    assert sorted(rows) == [(c, None, None) for c in "ABCF"]


def test_year_with_only_null_rates_keeps_rows(spark):
    rates = labour(spark, (2024, None))
    got = values(reports.investment_score(gold(spark, *PAIRS), rates, T, 2025, 2020, 2024, 50, 600_000.0, metro="Metro"), "Investment_Score")
    assert got == [(None,)] * 3


def test_q1_ultimate_score_with_true_and_whole_volume_ratio(spark):
    market, rates = gold(spark, *PAIRS), labour(spark, (2024, 4.0))

    def scores(whole):
        df = reports.ultimate_score(market, rates, T, 2025, 2020, 2024, 50, integer_volume_ratio=whole, metro="Metro")
        return dict(values(df, "CITY", "Ultimate_Score"))

    def expected(price, days, share, gain):
        return price / 700_000 * 25 + days / 80 * 20 + (1 - share) * 15 + gain + 0.4 * 15

    assert scores(False) == pytest.approx({  # maxima include D, which has no base year
        "A": expected(400_000, 40, 0.5, 0), "B": expected(300_000, 20, 0.25, 25),
        "C": expected(700_000, 10, 0.3, -125), "F": expected(500_000, 30, 0.35, 25),
    })
    assert scores(True)["A"] == pytest.approx(expected(400_000, 40, 0, 0))


def test_focus_list_limits_rows_and_maxima(spark):
    df = reports.ultimate_score(gold(spark, *PAIRS), labour(spark, (2024, 0.0)), T, 2025, 2020, 2024, 50, ["B"], metro="Metro")
    assert values(df, "CITY", "Ultimate_Score") == [("B", 25.0 + 20.0 + 0.0 + 25.0 + 0.0)]


def test_dashboard_datasets(spark):
    rows = gold(spark, ("A", 2018, "x", 1.0, 1, 1.0), ("B", 2018, "x", 3.0, None, 1.0), ("A", 2017, "y", 5.0, 4, 1.0))
    assert values(reports.price_trend(rows, 2018, 2025)) == [(2018, "x", 2.0)]
    assert values(reports.property_types(rows)) == [("x",), ("y",)]
    assert values(reports.kpi_cards(rows)) == [(5, 3.0)]
    assert values(reports.kpi_cards(rows, "y")) == [(4, 5.0)]
    assert values(reports.city_metrics(rows), "CITY", "YEAR") == [("A", 2017), ("A", 2018), ("B", 2018)]
    assert reports.city_metrics(rows, "y").count() == 1
