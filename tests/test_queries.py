"""Every registered query runs at sf0.001 and, where it has SQL, matches
DuckDB on the same parquet tables (the driver's correctness gate)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from tidemark import plans  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

from conftest import SF  # noqa: E402

QUERIES = plans.queries()
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "resolved" in df.columns


def test_entry_lists_every_query():
    assert plans.queries().keys() <= E.queries().keys() and plans.oracle_sql().keys() <= E.oracle_sql().keys()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    pdf = sdf.toPandas()
    if name not in SQL:
        assert len(pdf.columns) > 0
        return
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({SQL[name]})").fetchall()}
    assert {c: TYPES.get(t, t) for c, t in sdf.dtypes} == described
    odf = con.execute(SQL[name]).df()
    assert sorted(pdf.columns) == sorted(odf.columns)
    assert len(pdf) == len(odf)
    s = [tuple(r) for r in pdf.itertuples(index=False, name=None)]
    o = [tuple(r) for r in odf.itertuples(index=False, name=None)]
    assert digest(s, list(pdf.columns), 6) == digest(o, list(odf.columns), 6)
