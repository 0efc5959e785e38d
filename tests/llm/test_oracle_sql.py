"""Queries of the package against their SQL."""

from __future__ import annotations

import pytest

from compare import connect, difference
from tallybrook.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, name):
    df = queries.queries()[name](spark, SF)
    result = connect(SF).execute(oracle.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert difference(df.columns, [tuple(r) for r in df.collect()], names, result.fetchall()) is None
