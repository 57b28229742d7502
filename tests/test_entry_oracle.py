"""The driver contract, and every registered query against its DuckDB oracle."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["order_year", "band", "orders"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)


def test_entry_survives_a_missing_library():
    """Without the tokenizer package all other queries are still registered."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = ("import sys; sys.modules['public_tokenizers'] = None; sys.path.insert(0, %r); import warnings; "
              "warnings.simplefilter('ignore'); import __spark_entry__ as E; print(len(E.queries()), 'scan_parquet' in E.queries(), 'pipeline' in E.queries())" % root)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[1:] == ["True", "False"], out.stderr[-1000:]
