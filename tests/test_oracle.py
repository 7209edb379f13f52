"""Every registered query against another engine running its SQL over the same tables."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entrypoint
from homespan.catalogue.oracle import ORACLE_SQL
from homespan.catalogue.queries import QUERIES
from tests.conftest import TESTDATA
from tests.plans import ran_plan_text

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
NAMES = sorted(QUERIES)
NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF")


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_by_column(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


SCALES = os.environ.get("ORACLE_SCALES", "sf0.01").split(",")


@pytest.fixture(scope="module", params=SCALES)
def scale(request):
    folder = TESTDATA / request.param
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    yield str(folder), con
    con.close()


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert ORACLE_SQL.items() <= entrypoint.oracle_sql().items()
    assert QUERIES.items() <= entrypoint.queries().items()


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, scale, name):
    folder, con = scale
    ours = entrypoint.queries()[name](spark, folder)
    got = rows_by_column(ours.columns, [tuple(r) for r in ours.collect()])
    cursor = con.execute(entrypoint.oracle_sql()[name])
    want = rows_by_column([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    if not folder.endswith("sf0.001"):
        assert got[1], "empty results prove nothing"
    plan = ran_plan_text(ours)
    assert [word for word in NEVER if word in plan] == []
    assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plan)) <= 1, "line items are scanned once"


def test_entry_has_rows(spark):
    assert entrypoint.entry(spark).count() > 0
