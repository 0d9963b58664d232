"""Every query with SQL gives the same rows as the SQL on the smallest tables."""

from collections import Counter

import pytest

import __spark_entry__ as entry
from panelloom.plans import data_queries, panel_queries
from tests.conftest import plain

CORE = {**panel_queries.QUERIES, **data_queries.QUERIES}
SQL = {**panel_queries.ORACLES, **data_queries.ORACLES}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, folder, oracle, name):
    df = CORE[name](spark, folder)
    names = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    rel = oracle.execute(SQL[name])
    columns = [c[0] for c in rel.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(CORE) - set(SQL)))
def test_runs_without_sql(spark, folder, name):
    assert CORE[name](spark, folder).count() > 0


def test_entry(spark, folder):
    wide = entry.entry(spark)
    assert wide.columns[:2] == ["UNITID", "year"] and wide.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
