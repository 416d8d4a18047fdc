from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


def rows_of(columns, rows):
    return sorted(repr([r[c] for c in columns]) for r in rows)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def catalogue():
    from vellumflow.plans import catalogue as found

    return found


@pytest.mark.parametrize("name", sorted(catalogue().QUERIES))
def test_same_as_sql(spark, db, name):
    found = catalogue().QUERIES[name](spark, str(SF))
    columns = sorted(found.columns)
    told = db.sql(catalogue().ORACLE_SQL[name])
    assert sorted(told.columns) == columns
    expected = [dict(zip(told.columns, r)) for r in told.fetchall()]
    assert rows_of(columns, [r.asDict() for r in found.collect()]) == rows_of(columns, expected)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
