"""Every text query that SQL can state, against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences
from orderloom.llm.oracles import ORACLES
from orderloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, name):
    pytest.importorskip("duckdb")
    with connect(folder) as con:
        assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) == []


def test_operators_and_their_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
