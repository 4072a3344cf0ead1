"""Every registered query with SQL gives what DuckDB gives on the same tables."""

import os

import duckdb
import pytest

from quillspark.catalog import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in data], key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    frame = QUERIES[name](spark, SF)
    ours = rows(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in ORACLE_SQL:
        assert ours
        return
    result = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    theirs = rows(columns, result.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
