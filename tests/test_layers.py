import pytest

from homespan.operators import audit, layers
from homespan.schemas import GOLD, SILVER, SchemaMismatch, require_schema, schema_differences
from tests.frames import market, values


def test_bronze_keeps_one_state_and_every_column(spark):
    raw = market(spark, {}, {"STATE_CODE": "OK"}, {"STATE_CODE": None})
    kept = layers.state_slice(raw, "TX")
    assert kept.columns == raw.columns and kept.count() == 1


def test_metro_word_is_case_sensitive_and_cities_are_distinct(spark):
    raw = market(
        spark, {}, {"CITY": "Alpha"}, {"CITY": "Beta", "PARENT_METRO_REGION": "dallas, TX"},
        {"CITY": "Gamma", "PARENT_METRO_REGION": "Fort Worth-Dallas, TX"}, {"PARENT_METRO_REGION": None},
    )
    assert sorted(values(layers.metro_cities(raw, "Dallas"))) == [("Alpha",), ("Gamma",)]


def test_silver_types_and_drops_unpriced(spark):
    raw = market(
        spark,
        {"HOMES_SOLD": "30.5", "INVENTORY": "NA", "MEDIAN_DOM": "abc"},
        {"MEDIAN_SALE_PRICE": "NA"},
        {"MEDIAN_SALE_PRICE": ""},
        {"PERIOD_END": "not a day", "MEDIAN_PPSF": "x"},
    )
    silver = layers.clean(raw)
    assert schema_differences(silver, SILVER) == []
    got = values(silver, "MEDIAN_SALE_PRICE", "MEDIAN_PPSF", "HOMES_SOLD", "INVENTORY", "MEDIAN_DOM", "PERIOD_END_DATE")
    assert [r[:5] for r in got] == [(100000.0, 120.5, 30, None, None), (100000.0, None, 10, 5, 30)]
    assert str(got[0][5]) == "2020-06-30" and got[1][5] is None


def test_unknown_columns_pass_through_silver(spark):
    from pyspark.sql import functions as F

    silver = layers.clean(market(spark, {}).withColumn("REGION_ID", F.lit("77")))
    assert values(silver, "REGION_ID") == [("77",)]


def test_cleaning_is_idempotent(spark):
    raw = market(spark, {"HOMES_SOLD": "30.5"}, {"MEDIAN_PPSF": "NA"}, {"MEDIAN_DOM": None})
    once = layers.clean(raw)
    again = layers.clean(once.select(*[once[c].cast("string").alias(c) for c in raw.columns]))
    assert values(once) == values(again)


def test_cleaning_counts(spark):
    raw = market(spark, {"HOMES_SOLD": "NA", "MEDIAN_DOM": "abc"}, {"HOMES_SOLD": None}, {"MEDIAN_SALE_PRICE": ""})
    counts = {r[0]: tuple(r[1:]) for r in values(audit.cleaning_counts(raw))}
    assert counts["HOMES_SOLD"] == (2, 1, 0)
    assert counts["MEDIAN_DOM"] == (3, 0, 1)
    assert counts["MEDIAN_SALE_PRICE"] == (3, 0, 1)
    assert list(counts) == list(layers.MEASURES)


def test_gold_averages_rows_and_sums_volume(spark):
    raw = market(
        spark, {"MEDIAN_SALE_PRICE": "100", "HOMES_SOLD": "1", "MEDIAN_DOM": "NA"},
        {"MEDIAN_SALE_PRICE": "300", "HOMES_SOLD": "5", "PERIOD_END": "2020-01-31"},
        {"MEDIAN_SALE_PRICE": "900", "PERIOD_END": "2021-01-31"},
    )
    gold = layers.summarize(layers.clean(raw))
    assert schema_differences(gold, GOLD) == []
    assert sorted(values(gold, "YEAR", "AVG_SALE_PRICE", "TOTAL_HOMES_SOLD", "AVG_DAYS_ON_MARKET")) == [
        (2020, 200.0, 6, 30.0), (2021, 900.0, 10, 30.0),
    ]


def test_gold_sum_of_nulls_is_null(spark):
    gold = layers.summarize(layers.clean(market(spark, {"HOMES_SOLD": "NA"})))
    assert values(gold, "TOTAL_HOMES_SOLD") == [(None,)]


def test_q18_missing_period_makes_a_null_year(spark):
    gold = layers.summarize(layers.clean(market(spark, {"PERIOD_END": None}, {})))
    assert {r[0] for r in values(gold, "YEAR")} == {None, 2020}


def test_q6_same_name_in_two_states_blends_unless_keys_say_otherwise(spark):
    raw = market(spark, {"MEDIAN_SALE_PRICE": "100"}, {"MEDIAN_SALE_PRICE": "300", "STATE_CODE": "OK"})
    silver = layers.clean(raw)
    assert values(layers.summarize(silver), "AVG_SALE_PRICE") == [(200.0,)]
    assert layers.summarize(silver, ("STATE_CODE", *layers.GOLD_KEYS)).count() == 2


def test_between_years_is_a_plain_range(spark):
    raw = market(spark, {"PERIOD_END": "2019-12-31"}, {"PERIOD_END": "2020-01-01"}, {"PERIOD_END": "2021-12-31"},
                 {"PERIOD_END": "2022-01-01"}, {"PERIOD_END": None})
    kept = layers.between_years(layers.clean(raw), 2020, 2021)
    assert sorted(values(kept, "PERIOD_END")) == [("2020-01-01",), ("2021-12-31",)]


def test_row_counts_per_source(spark):
    counts = audit.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(values(counts)) == [("a", 3), ("b", 0)]


def test_schema_check_names_what_differs(spark):
    df = spark.createDataFrame([("x", "1")], "CITY string, YEAR string")
    with pytest.raises(SchemaMismatch, match="YEAR: string instead of int; PROPERTY_TYPE: missing"):
        require_schema(df, GOLD)
