"""Every registered query against its SQL."""

import pytest
from compare import differences

from __spark_entry__ import entry
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.oracle import ORACLE as SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), sf_dir, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"forest_scores", "logistic_scores", "stream_scores"}


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "avg_tx_amount_terminal" in df.columns
