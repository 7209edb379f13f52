"""Registered queries of the operators against SQL in another engine over the same tables."""

import pytest

from homespan.llm.oracle import ORACLE_SQL
from homespan.llm.queries import QUERIES
from tests.test_oracle import rows_by_column, scale  # noqa: F401


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, scale, name):  # noqa: F811
    folder, con = scale
    ours = QUERIES[name](spark, folder)
    got = rows_by_column(ours.columns, [tuple(r) for r in ours.collect()])
    cursor = con.execute(ORACLE_SQL[name])
    want = rows_by_column([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1]
