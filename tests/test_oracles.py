"""Registered queries against their SQL on the smallest tables.

``python tests/oracle_check.py FOLDER`` compares all of them at any scale.
"""

from __future__ import annotations

import __spark_entry__ as registered
import pytest
from oracle_check import connect, differences

from orderloom.plans.queries import REGISTRY

ORACLES = registered.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    pytest.importorskip("duckdb")
    with connect(folder) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(set(ORACLES) & set(REGISTRY)))
def test_query_equals_sql(spark, folder, con, name):
    assert differences(registered.queries()[name](spark, folder), con, ORACLES[name]) == []


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(registered.queries())


def test_entry_is_the_base_table(spark, folder):
    df = registered.entry(spark)
    assert df.count() > 0 and {"order_id", "label", "total_amount", "payment_type"} <= set(df.columns)
