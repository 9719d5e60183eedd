"""Every registered query against its SQL, on the smallest tables."""

import datetime
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", entry_points.SMOKE_DIR)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_points.ORACLES))
def test_query_matches_sql(spark, oracle, name):
    got = entry_points.queries()[name](spark, SF_DIR)
    result = oracle.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(names)
    found = sorted_rows(got.columns, got.collect())
    assert found == sorted_rows(names, result.fetchall())
    assert found


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_entry_without_a_tokenizer_library():
    """The library's own queries do not depend on what the queries for training data need."""
    code = "import sys; sys.modules['tiktoken'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.QUERIES))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=os.path.dirname(entry_points.__file__), capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(entry_points.QUERIES))] * 2
