"""Hot keys, as on a cluster where no side is small: a third of the rows share a key."""

import duckdb
import pytest

import __spark_entry__ as entrypoint
from tests.conftest import TESTDATA
from tests.plans import final_plan_text
from tests.test_oracle import TABLES, rows_by_column

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.shuffle.partitions": "16",
    # A skewed partition is split between map outputs, so the scans need several tasks.
    "spark.sql.files.maxPartitionBytes": "128k",
    "spark.sql.files.openCostInBytes": "0",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    source = TESTDATA / "sf0.01"
    hot = {
        "lineitem": "SELECT * EXCLUDE (rowid_) REPLACE (CASE WHEN rowid_ % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey, "
        "CASE WHEN rowid_ % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey) FROM (SELECT *, row_number() OVER () AS rowid_ FROM '{}')",
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey) FROM '{}'",
    }
    for name in TABLES:
        query = hot.get(name, "SELECT * FROM '{}'").format(source / f"{name}.parquet")
        con.execute(f"COPY ({query}) TO '{folder / name}.parquet' (ROW_GROUP_SIZE 5000)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder / name}.parquet'")
    yield str(folder), con
    con.close()


@pytest.fixture
def cluster_like(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["gold_summary", "price_extremes", "ultimate_score", "city_scores", "city_semi_match"])
def test_hot_keys_are_split_and_results_stay_whole(cluster_like, skewed, name):
    folder, con = skewed
    ours = entrypoint.queries()[name](cluster_like, folder)
    got = rows_by_column(ours.columns, [tuple(r) for r in ours.collect()])
    cursor = con.execute(entrypoint.oracle_sql()[name])
    assert got == rows_by_column([c[0] for c in cursor.description], cursor.fetchall())


def test_gold_splits_its_skewed_joins(cluster_like, skewed):
    text = final_plan_text(entrypoint.queries()["gold_summary"](cluster_like, skewed[0]))
    assert "BroadcastHashJoin" not in text
    assert text.count("SortMergeJoin(skew=true)") >= 2
