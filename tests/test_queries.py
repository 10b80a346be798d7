"""Every registered query against its SQL in another engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from almoner.plans.oracle import ORACLE
from almoner.plans.queries import QUERIES
from tests.compare import connect, differences



@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, folder, con):
    assert differences(QUERIES[name](spark, folder), con, ORACLE[name]) == []


def test_entry_has_the_final_columns(spark):
    from almoner.fixed.columns import FINAL_COLUMNS

    out = entry.entry(spark)
    assert out.columns == FINAL_COLUMNS
    assert out.count() > 0
