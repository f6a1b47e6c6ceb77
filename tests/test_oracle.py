"""Every registered query against its DuckDB oracle (row count, columns, order-insensitive values)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplens.plans.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return repr(v)
    return str(v)


def _rows(pdf, cols):
    return sorted("|".join(_norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    pdf = E.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    cols = sorted(pdf.columns)
    assert cols == sorted(odf.columns)
    assert len(pdf) == len(odf)
    assert _rows(pdf, cols) == _rows(odf, cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["logdate", "loghour", "dau"]
    assert df.count() > 0
