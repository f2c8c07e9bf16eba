"""Differential: every registered query against its DuckDB oracle at sf0.001."""

import pytest
from oracle_check import duck, norm

import __spark_entry__ as entry
from paysift.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    sql = entry.oracle_sql().get(name)
    assert sql is not None, "every query has an oracle"
    sdf = entry.queries()[name](spark, sf_dir)
    rel = con.sql(sql)
    assert sorted(c.lower() for c in sdf.columns) == sorted(c.lower() for c in rel.columns)
    idx = [[c.lower() for c in rel.columns].index(c.lower()) for c in sdf.columns]
    s = sorted(tuple(norm(v) for v in r) for r in sdf.collect())
    d = sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert len(s) == len(d)
    assert s == d


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["Industry", "happy_counts"]
    assert 0 < df.count() <= 5
