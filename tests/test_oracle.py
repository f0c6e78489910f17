"""Every registered query with SQL gives the same rows in DuckDB."""

import compare
import pytest

import __spark_entry__ as registered
from loomcast.plans.oracle import ORACLE
from loomcast.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, sf_dir, name):
    ours = compare.spark_rows(registered.queries()[name](spark, sf_dir))
    theirs = compare.duck_rows(duck, registered.oracle_sql()[name])
    assert compare.differences(ours, theirs) == []


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    df = registered.queries()[name](spark, sf_dir)
    assert df.where("y_pred is null" if "y_pred" in df.columns else "status != 'ok'").isEmpty()
    assert not df.isEmpty()


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["group_id", "model_name", "ds", "y_pred"]
    assert df.count() > 0
