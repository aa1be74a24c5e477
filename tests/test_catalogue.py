"""Every catalogue query against its SQL on the same tables."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import duckdb
import pytest

from catalogue import ALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def text_of(value):
    if isinstance(value, datetime):
        return value.isoformat()
    return "NULL" if value is None else repr(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(text_of(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ALL))
def test_matches_sql(name, spark, sf_dir, duck):
    query = ALL[name]
    frame = query(spark, sf_dir)
    expected = duck.execute(query.sql)
    names = [d[0] for d in expected.description]
    assert sorted(frame.columns) == sorted(names)
    assert sorted_rows(frame.columns, frame.collect()) == sorted_rows(names, expected.fetchall())


def test_entry_has_all_queries(spark):
    import __spark_entry__ as entry

    assert set(entry.queries()) >= set(ALL)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 14
