"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

from rivulet.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([float(r[i]) if isinstance(r[i], (int, float)) and not isinstance(r[i], bool) else r[i] for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, duck, name):
    got = catalog.queries()[name](spark, sf)
    rows = got.collect()
    if name not in catalog.oracle_sql():
        assert got.columns
        return
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(rows, got.columns) == canonical(want.fetchall(), want.columns)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(catalog.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
