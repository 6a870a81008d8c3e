"""Queries with a DuckDB oracle: equal rows on two table sizes."""

import pytest
from conftest import SF_ORACLE, SF_SMALL

import __spark_entry__ as entry
from logwise.llm.queries import ORACLES, QUERIES


def test_registered_once_each():
    names = list(entry.queries())
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    cur = duck(sf_dir).execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
