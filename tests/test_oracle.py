"""Every registered query against its DuckDB oracle (strict, at sf0.001)."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))  # queries of optional subpackages as well
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    assert len(set(cols)) == len(cols) and not any("(" in c or " " in c for c in cols), cols
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = Counter(tuple(norm(r[cols.index(c)]) for c in order) for r in rows)
    b = Counter(tuple(norm(r[ocols.index(c)]) for c in order) for r in orows)
    assert a == b


def test_every_query_of_the_reference_has_an_oracle():
    from fiscalflow.plans.catalog import CATALOG

    assert not [name for name, (_fn, sql) in CATALOG.items() if sql is None]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "VALOR_MES_Z" in df.columns
