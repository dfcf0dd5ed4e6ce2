"""Every query with a SQL counterpart gives the same rows; the others give rows."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry_module
from quillstream.registry.oracle import ORACLE
from quillstream.registry.queries import QUERIES

SQL = ORACLE
ROWS_ONLY = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, sf_dir, name):
    got = entry_module.queries()[name](spark, sf_dir).toPandas()
    assert differences(got, con.execute(SQL[name]).df()) is None


def test_rows_only_list():
    assert ROWS_ONLY == ["grid_search"]


def test_entry_is_lazy_and_scored(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["id", "tweet", "tweet_wo_hashtag", "time_stamp", "prediction",
                          "confidence_score"]
    assert {r.prediction for r in df.select("prediction").distinct().collect()} <= {
        "hate", "not_hate"}
    assert df.filter("confidence_score < 0.5 OR confidence_score > 1").count() == 0
