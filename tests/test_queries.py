"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from workload.compare import canonical, sql_rows

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    df = entry.queries()[name](spark, SMALL)
    columns, expected, _ = sql_rows(SMALL, entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(expected, columns)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
