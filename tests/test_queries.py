"""Every registered query against its SQL check."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from tests.compare import difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_matches_sql(spark, name):
    fn = entry_point.queries()[name]
    assert difference(spark, name, fn, entry_point.oracle_sql()[name], SF_DIR) is None


@pytest.mark.parametrize(
    "name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql()))
)
def test_gives_rows(spark, name):
    assert entry_point.queries()[name](spark, SF_DIR).collect()


def test_every_check_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    flagship = entry_point.entry(spark)
    assert flagship.columns == ["id", "name", "amount"]
    assert [t for _, t in flagship.dtypes] == ["int", "string", "double"]
    assert flagship.count() > 0
