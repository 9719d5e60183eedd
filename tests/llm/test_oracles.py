import duckdb
import pytest

from siteledger.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    names, rows = [d[0] for d in result.description], sorted(result.fetchall())
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == rows and rows
