"""Registered queries against their SQL, and that all eleven are registered."""

import pytest

import __spark_entry__
from larder.llm.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    frame = QUERIES[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in names) for r in frame.collect()) == sorted(result.fetchall())
