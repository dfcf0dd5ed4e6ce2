"""The queries that return what a fitted model gives still equal the SQL of their ``_check`` in all it states."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry_module


@pytest.mark.parametrize("name", ["score", "score_refit", "format_predictions"])
def test_own_rows_equal_the_sql_of_their_check(spark, sf_dir, name):
    wanted = connect(sf_dir).execute(entry_module.oracle_sql()[f"{name}_check"]).df()
    got = entry_module.queries()[name](spark, sf_dir)
    assert len(got.columns) == len(wanted.columns) + 2
    assert differences(got.select(*wanted.columns).toPandas(), wanted) is None
