import pytest
from pyspark.sql import functions as F

from homespan.functions import numeric, text
from tests.frames import values


def column(spark, cells, kind="string"):
    return spark.createDataFrame([(c,) for c in cells], f"x {kind}")


def apply(spark, cells, fn, kind="string"):
    return [r[0] for r in values(column(spark, cells, kind).select(fn(F.col("x"))))]


def test_sentinel_becomes_null(spark):
    assert apply(spark, ["NA", "na", "1", None], text.blank_sentinel) == [None, "na", "1", None]


def test_q9_fraction_text_is_cut_to_int(spark):
    assert apply(spark, ["NA", "", "30.5", "12", "abc", "-2.9", "99999999999"], text.to_int) == [
        None, None, 30, 12, None, -2, None,
    ]


def test_text_to_double(spark):
    assert apply(spark, ["", "30.5", "12", "abc", "NaN", " 7 "], text.to_double) == [None, 30.5, 12.0, None, None, 7.0]


def test_text_to_long(spark):
    assert apply(spark, ["9007199254740993", "-666666666.0", "x"], text.to_long) == [9007199254740993, -666666666, None]


def test_bad_date_is_null_not_an_error(spark):
    days = apply(spark, ["2020-02-29", "2021-02-29", "soon", None], text.to_day)
    assert [d and d.isoformat() for d in days] == ["2020-02-29", None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_number_fails_on_bad_text(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert apply(spark, ["3.5", None], text.strict_double) == [3.5, None]
        with pytest.raises(Exception, match="not a number: -"):
            apply(spark, ["3.5", "-"], text.strict_double)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_q12_suffixes_only_at_the_end(spark):
    names = ["A city, Texas", "B town, Texas", "C CDP, Texas", "D village, Texas", "E city, Texas Park", "F"]
    strip = lambda c: text.strip_suffixes(c, (" city, Texas", " town, Texas", " CDP, Texas"))
    assert apply(spark, names, strip) == ["A", "B", "C", "D village, Texas", "E city, Texas Park", "F"]


def test_search_ignores_case_and_takes_text_literally(spark):
    cells = ["Southlake", "SOUTHLAKE hills", "North", "a_b", "aXb", "50%", None]
    hit = lambda needle: apply(spark, cells, lambda c: text.contains_ignoring_case(c, needle))
    assert hit("southLAKE") == [True, True, False, False, False, False, None]
    assert hit("A_B") == [False, False, False, True, False, False, None]
    assert hit("%") == [False, False, False, False, False, True, None]


def test_two_rounding_rules(spark):
    halves = [2.5, -2.5, 3.5]
    assert apply(spark, halves, lambda c: F.round(c, 0), "double") == [3.0, -3.0, 4.0]
    assert apply(spark, halves, numeric.round_half_even, "double") == [2.0, -2.0, 4.0]
    assert apply(spark, [0.25], lambda c: numeric.round_half_even(c, 1), "double") == [0.2]


def test_q10_zero_divisor_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (None, 2)], "a bigint, b bigint")
    assert values(df.select(numeric.ratio(F.col("a"), F.col("b")))) == [(None,), (0.5,), (None,)]
    assert values(df.select(numeric.whole_ratio(F.col("a"), F.col("b")))) == [(None,), (0,), (None,)]


def test_exact_mean_does_not_depend_on_order(spark):
    cents = [0.1, 0.2, 0.3, 1e9, -1e9, 0.07] * 50
    both = {
        spark.createDataFrame([(c,) for c in order], "x double").repartition(n)
        .agg(numeric.mean(F.col("x"), 2)).first()[0]
        for order, n in ((cents, 1), (cents[::-1], 7))
    }
    assert both == {33.5 / 300}
    assert values(column(spark, [None], "double").agg(numeric.mean(F.col("x"), 2), numeric.mean(F.col("x")))) == [
        (None, None)
    ]
