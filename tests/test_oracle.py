"""Every registered query against its DuckDB oracle (values, names, counts)."""

import datetime as dt
import decimal

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE, SF_SMALL

from logwise.plans import catalog

# the library's own keys; other packages test the keys that they add
QUERIES = {k: fn for k, fn in entry.queries().items() if k in catalog.QUERIES}
ORACLES = {k: sql for k, sql in entry.oracle_sql().items() if k in catalog.QUERIES}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = duck(sf_dir).execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "n"]
    assert df.count() > 0


def test_registered_queries_read_whole_tables():
    """No id subsets, modulo filters, samples or row caps in any registered
    query or its oracle (format strings such as '%Y%m' are not modulo)."""
    import inspect
    import re

    modulo = re.compile(r"(\w|\))\s*%\s*\d")
    for name in QUERIES:
        sql = ORACLES[name]
        assert not modulo.search(sql), name
        assert " limit " not in sql.lower() and "sample" not in sql.lower(), name
    src = inspect.getsource(catalog)
    assert ".limit(" not in src and ".sample(" not in src and "% 2" not in src
