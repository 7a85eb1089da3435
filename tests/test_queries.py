"""Every core query with SQL against DuckDB; the others run."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tamiz.plans import catalog

def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck(data):
    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for f in os.listdir(data):
        db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return db


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, data, duck, name):
    df = catalog.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(map(norm, r)) for r in df.select(*columns).collect())
    result = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(norm(r[names.index(c)]) for c in columns) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, data, name):
    assert len(catalog.queries()[name](spark, data).collect()) > 0 or name == "duplicate_documents"


def test_entry_contract(spark, data):
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    splits = entry.entry(spark).collect()
    assert {r["split"] for r in splits} <= {"train", "validation", "test"} and splits
