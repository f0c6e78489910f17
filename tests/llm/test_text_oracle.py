"""Registered queries and their SQL give the same rows."""

import compare
import duckdb
import pytest

from loomcast.llm.queries import ORACLE, QUERIES

TABLES = "documents embeddings benchmark labels".split()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = compare.spark_rows(QUERIES[name](spark, sf_dir))
    assert not compare.differences(found, compare.duck_rows(con, ORACLE[name]))
