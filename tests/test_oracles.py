"""Every registered query against its DuckDB oracle (small data), or, where
no oracle exists, a non-failing run with a stable schema."""

import math

import duckdb
import pytest

from chronopanel.plans.registry import load_all, runner
from chronopanel.session import TABLES

from .conftest import SMALL

REG = load_all()
SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


@pytest.mark.parametrize("name", sorted(REG))
def test_query(spark, con, name):
    q = REG[name]
    df = runner(q)(spark, SMALL)
    rows = df.collect()
    cols = df.columns
    assert len(cols) == len(set(cols))
    if q.sql is None:
        return
    rel = con.sql(q.sql)
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    drows = rel.fetchall()
    dcols = list(rel.columns)
    assert sorted(cols) == sorted(dcols)
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == dtypes
    order = sorted(cols)
    a = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows), key=repr)
    assert a == b


def test_contract_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
