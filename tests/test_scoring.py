import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from homespan.config import WEIGHTS_A, WEIGHTS_B
from homespan.operators import scoring
from homespan.plans import reports
from tests.frames import gold, values

PLACES = "CITY string, MEDIAN_INCOME double, BACHELORS_PCT double, DIVERSITY_PCT double, AVG_SALE_PRICE double, " \
         "AVG_DAYS_ON_MARKET double"


def places(spark, *rows):
    return spark.createDataFrame(list(rows), PLACES)


def pandas_rank(scores):
    ranks = pd.Series(scores, dtype="float64").rank(ascending=False)
    return [None if pd.isna(r) else int(r) for r in ranks]


def ranks_of(spark, scores, **options):
    df = spark.createDataFrame(list(enumerate(scores)), "id int, OVERALL_SCORE double")
    return [r["RANK"] for r in scoring.average_rank(df, **options).orderBy("id").collect()]


def test_q3_ties_share_a_cut_mean_position(spark):
    scores = [9.0, 7.0, 7.0, 5.0, 5.0, 5.0, 1.0, None]
    assert ranks_of(spark, scores) == [1, 2, 2, 5, 5, 5, 7, None] == pandas_rank(scores)
    assert ranks_of(spark, [3.0, 2.0, 2.0, 2.0, 1.0]) == [1, 3, 3, 3, 5]


def test_zero_has_one_rank_whatever_its_sign(spark):
    assert ranks_of(spark, [0.0, -0.0, 1.0]) == [2, 2, 1]


BY_RANGE = {"ranges": 7}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 40).map(lambda i: i / 4), st.floats(0, 100)), max_size=120))
def test_ranges_rank_like_one_window(spark, scores):
    scores = scores + [50.0] * 40
    want = pandas_rank(scores)
    assert ranks_of(spark, scores) == want
    assert ranks_of(spark, scores, **BY_RANGE) == want


def test_many_scores_in_a_narrow_band_still_cut_evenly(spark):
    """Value-sized bins would put all of these into one; quantile ranges do not."""
    df = spark.range(20_000).select("id", (50 + F.col("id") / 1e9).alias("OVERALL_SCORE"))
    ranked = scoring.average_rank(df, ranges=20)
    assert ranked.filter(F.col("RANK") != 20_000 - F.col("id")).count() == 0



def test_one_score_for_all(spark):
    assert ranks_of(spark, [5.0] * 10, **BY_RANGE) == pandas_rank([5.0] * 10) == [5] * 10
    assert ranks_of(spark, [None] * 3) == [None] * 3


def test_a_score_shared_by_a_third_of_the_rows(spark):
    scores = [80.0] * 400 + [float(i) / 10 for i in range(800)]
    assert ranks_of(spark, scores, **BY_RANGE) == pandas_rank(scores)


def test_scores_span_0_to_100_and_directions_mirror(spark):
    df = places(spark, ("A", 10.0, 1.0, 5.0, 100.0, 9.0), ("B", 20.0, 2.0, 7.0, 300.0, 3.0), ("C", 15.0, 4.0, 6.0, 150.0, 6.0))
    metrics = ("MEDIAN_INCOME", "AVG_SALE_PRICE")
    up = scoring.min_max_scores(df, {f"up_{m}": m for m in metrics}, {f"down_{m}": m for m in metrics})
    for row in up.collect():
        for m in metrics:
            assert row[f"down_{m}"] == pytest.approx(100 - row[f"up_{m}"])
    scored = values(scoring.min_max_scores(df), "CITY", "INCOME_SCORE", "AFFORDABILITY_SCORE", "MARKET_SPEED_SCORE")
    assert sorted(scored) == [("A", 0.0, 100.0, 0.0), ("B", 100.0, 0.0, 100.0), ("C", 50.0, 75.0, 50.0)]


def test_q10_constant_metric_scores_null_and_is_unranked(spark):
    df = places(spark, ("A", 10.0, 1.0, 5.0, 100.0, 9.0), ("B", 10.0, 2.0, 7.0, 300.0, 3.0))
    ranked = scoring.composite_ranking(df)
    assert values(ranked, "INCOME_SCORE", "OVERALL_SCORE", "RANK") == [(None, None, None)] * 2


def test_q4_missing_metric_is_left_out_of_extremes_only(spark):
    df = places(spark, ("A", 10.0, 1.0, 5.0, 100.0, 9.0), ("B", 20.0, None, 7.0, 300.0, 3.0), ("C", 15.0, 4.0, 6.0, 150.0, 6.0))
    ranked = {r[0]: r[1:] for r in values(scoring.composite_ranking(df), "CITY", "EDUCATION_SCORE", "RANK")}
    assert ranked["A"][0] == 0.0 and ranked["C"][0] == 100.0 and ranked["B"] == (None, None)
    assert {ranked["A"][1], ranked["C"][1]} == {1, 2}


def test_q13_bad_income_is_excluded_before_scaling(spark):
    rows = (("A", 10.0, 1.0, 5.0, 100.0, 9.0), ("B", 20.0, 2.0, 7.0, 300.0, 3.0), ("X", -666666666.0, 3.0, 6.0, 200.0, 5.0),
            ("Y", None, 3.0, 6.0, 200.0, 5.0))
    df = places(spark, *rows)
    kept = scoring.composite_ranking(df, WEIGHTS_B)
    assert sorted(values(kept, "CITY", "INCOME_SCORE")) == [("A", 0.0), ("B", 100.0)]
    all_in = scoring.composite_ranking(df, WEIGHTS_A, drop_bad_income=False)
    assert {r[0] for r in values(all_in, "CITY")} == {"A", "B", "X", "Y"}


def test_weights_must_add_up(spark):
    with pytest.raises(ValueError, match="not 1"):
        scoring.weighted_score({"A": 0.5, "B": 0.4})


def test_composite_matches_pandas(spark):
    rows = [(f"C{i}", 100.0 + 37 * i % 91, (i * 7) % 23 / 2, (i * 5) % 17 / 4, 1000.0 + (i * 131) % 777, (i * 3) % 29 + 0.5)
            for i in range(40)]
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in PLACES.split(", ")])

    def unit(name):
        return (frame[name] - frame[name].min()) / (frame[name].max() - frame[name].min())

    total = (
        unit("MEDIAN_INCOME") * 100 * 0.30 + unit("BACHELORS_PCT") * 100 * 0.25 + unit("DIVERSITY_PCT") * 100 * 0.15
        + (1 - unit("AVG_SALE_PRICE")) * 100 * 0.15 + (1 - unit("AVG_DAYS_ON_MARKET")) * 100 * 0.15
    )
    want = dict(zip(frame["CITY"], zip(total, total.rank(ascending=False).astype(int), strict=True), strict=True))
    got = {r[0]: tuple(r[1:]) for r in values(scoring.composite_ranking(places(spark, *rows)), "CITY", "OVERALL_SCORE", "RANK")}
    assert {c: r[1] for c, r in got.items()} == {c: int(r[1]) for c, r in want.items()}
    for city, (score, _) in got.items():
        assert score == pytest.approx(want[city][0], abs=1e-9)


def test_deal_score_is_low_for_cheap_fast_busy_cities(spark):
    rows = gold(spark, ("A", 2025, "T", 500_000.0, 100, 30.0), ("B", 2025, "T", 500_000.0, 300, 30.0),
                ("C", 2025, "T", 500_000.0, 19, 1.0), ("D", 2025, "T", 500_000.0, 300, None))
    got = values(reports.best_deals(rows, "T", 2025, 20), "CITY", "DealScore")
    assert [c for c, _ in got] == ["B", "A"] and got[1][1] == pytest.approx(0.5 + 0.3 - 1.0)


def test_one_path_ranks_odd_inputs(spark):
    assert ranks_of(spark, [None, None]) == [None, None]
    assert ranks_of(spark, [float("nan"), 2.0, None, float("inf"), 1.0]) == [None, 2, None, 1, 3]
    assert ranks_of(spark, [5.0] * 9) == [5] * 9
    empty = spark.createDataFrame([], "id int, OVERALL_SCORE double")
    assert scoring.average_rank(empty).count() == 0


def test_a_hundred_thousand_scores_with_ties(spark):
    df = spark.range(100_000).select("id", F.floor(F.pmod(F.xxhash64("id"), F.lit(40_000))).cast("double").alias("OVERALL_SCORE"))
    got = scoring.average_rank(df).toPandas().sort_values("id")
    assert got["RANK"].tolist() == pandas_rank(got["OVERALL_SCORE"])
