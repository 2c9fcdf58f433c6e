"""Every registered query against its DuckDB oracle."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from comparing import duck_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The corpus operators have tests of their own; few of them have a SQL form.
CORPUS = {*(driver.corpus.queries() if driver.corpus else ()), "pipeline"}
OWN = {*driver.queries()} - CORPUS


def test_every_query_has_an_oracle():
    assert OWN == {*driver.oracle_sql()} - CORPUS


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, name):
    names, rows = spark_rows(driver.queries()[name](spark, SF_DIR))
    expected_names, expected = duck_rows(SF_DIR, driver.oracle_sql()[name])
    assert names == expected_names
    assert rows
    assert rows == expected
