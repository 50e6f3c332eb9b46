"""Queries with SQL, compared with DuckDB row by row on the driver's smallest tables."""

import os

import pytest

from starloom.llm.registry import ORACLE, QUERIES

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not there")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    expected = con.sql(ORACLE[name])
    columns = sorted(got.columns)
    assert sorted(expected.columns) == columns
    line = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    mine = sorted((line([r[c] for c in columns]) for r in got.collect()), key=str)
    assert mine == sorted(map(line, expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()), key=str)
