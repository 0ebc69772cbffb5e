"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from wortlab.sources.tables import TABLES

from paths import SF001

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in data)


def test_every_query_is_registered_with_sql_or_is_stateful():
    missing = {q for q in QUERIES if not q.startswith("op") and q != "pipeline"} - set(SQL) - {"sentiment_learned", "compound_parts"}  # tests/test_learned.py, tests/test_lexicon.py
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    want = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows(df.columns, got) == rows(dcols, want)
