"""The shape of the plans: what is pushed down, read once, cut early, and never done."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entrypoint
from homespan.catalogue import queries as q
from homespan.operators import layers, scoring
from homespan.plans import reports
from homespan.sources.tables import read_table, write_table
from tests.conftest import TESTDATA
from tests.plans import files_read, final_plan_text, plan_text

FOLDER = str(TESTDATA / "sf0.001")


@pytest.mark.parametrize("broadcasts", ["-1", "10m"])
def test_the_five_factor_score_groups_gold_once(spark, monkeypatch, broadcasts):
    """The pair is stored once, from one grouping of the feed; what is left reads city-level rows alone."""
    plans = []
    plain = reports.materialize
    monkeypatch.setattr(reports, "materialize", lambda df: plans.append(final_plan_text(df)) or plain(df))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    try:
        rest = final_plan_text(q.ultimate_score(spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 1
    assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plans[0])) == 1 and "lineitem" not in rest
    assert len(re.findall(r"HashAggregate\(keys=\[n_name", plans[0])) <= 2 and "n_name" not in rest


def test_the_latest_year_is_pruned_at_run_time(spark, tmp_path):
    gold = q.gold_of(spark, FOLDER)
    written = write_table(gold, str(tmp_path / "gold"), partition_by=["YEAR"])
    stored = read_table(spark, written.path, schema=written.schema)
    found = reports.top_cities_latest_year(stored, "ECONOMY")
    text = final_plan_text(found)
    assert re.search(r"PartitionFilters: \[[^\]]*YEAR#\d+ = Subquery", text)
    scans = files_read(found)
    years = {r[0] for r in gold.select("YEAR").distinct().collect()}
    assert len(years) > 2 and min(scans) == len(list((tmp_path / "gold" / f"YEAR={max(years)}").glob("part-*")))


def test_type_and_year_reach_the_scans(spark):
    text = plan_text(q.investment_score(spark, FOLDER))
    assert "EqualTo(p_type,ECONOMY)" in text
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)" in text
    assert "EqualTo(event_type,error)" in text


def test_scans_read_only_the_columns_they_need(spark):
    text = plan_text(q.property_types(spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = {c.split(":")[0] for s in schemas for c in s.split(",") if c}
    assert not columns & {"l_quantity", "l_tax", "l_discount", "o_orderdate", "c_acctbal", "p_size", "n_name"}
    assert "l_partkey" in columns


@pytest.mark.parametrize(
    "name",
    ["top_cities_report", "top_cities_min_volume", "deal_score", "investment_score", "ultimate_score",
     "largest_places", "ranking_head", "gold_preview"],
)
def test_top_lists_keep_only_n_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in plan_text(entrypoint.queries()[name](spark, FOLDER))


def test_gold_folds_before_its_only_own_shuffle(spark):
    gold = layers.summarize(q.star.market_silver(spark, FOLDER), exact_scale=2)
    text = plan_text(gold)
    assert text.count("HashAggregate") == 2 and "partial_sum" in text
    assert "Sort [CITY" not in text


def test_changes_use_one_window(spark):
    text = plan_text(q.yoy_change(spark, FOLDER))
    assert len(re.findall(r"\bWindow \[", text)) == 1


def test_semi_match_folds_cities_before_the_join(spark):
    text = plan_text(q.city_semi_match(spark, FOLDER))
    assert "LeftSemi" in text and re.search(r"HashAggregate\(keys=\[CITY", text)


def test_ranges_never_order_all_rows_in_one_task(spark):
    df = spark.range(3000).select("id", (F.col("id") / 30).alias("OVERALL_SCORE"))
    text = plan_text(scoring.average_rank(df, ranges=30))
    into_one_task = re.findall(r"Exchange SinglePartition.*\n\W*(\w+)\(keys=\[(\w+)#", text)
    assert into_one_task == [("HashAggregate", "RANGE")]
    # The others merge the partial quantiles of the scores into one row.
    assert text.count("SinglePartition") - 1 == text.count("partial_percentile_approx")


def test_stored_gold_is_pruned_by_year(spark, tmp_path):
    path = str(tmp_path / "gold")
    write_table(q.gold_of(spark, FOLDER), path, partition_by=["YEAR"])
    text = plan_text(q.reports.top_cities_min_volume(spark.read.parquet(path), "ECONOMY", 2000, 10))
    assert re.search(r"PartitionFilters: \[[^\]]*YEAR#\d+ = 2000", text)
    assert "EqualTo(PROPERTY_TYPE,ECONOMY)" in text


def test_stored_silver_years_are_pushed_as_a_range(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_table(q.star.market_silver(spark, FOLDER), path)
    text = plan_text(layers.between_years(spark.read.parquet(path), 1996, 1997))
    assert "GreaterThanOrEqual(PERIOD_END_DATE,1996-01-01)" in text and "LessThan(PERIOD_END_DATE,1998-01-01)" in text
