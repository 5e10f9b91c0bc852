"""Every query of the library against its SQL oracle, at the smallest scale."""

from __future__ import annotations

import pytest
from conftest import SF

import __spark_entry__ as entry
from tools import check_oracle
from varloom.plans.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return check_oracle.duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = check_oracle.check(spark, con, SF, name)
    assert ok, note


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["tsa", "n_rows", "n_annotated"]
    assert df.count() == 6
