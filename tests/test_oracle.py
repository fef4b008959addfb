import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from wiretide.workload.oracle import ORACLE_SQL
from wiretide.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""


def test_only_sampling_and_learning_have_no_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == {"train_and_score", "train_and_evaluate", "score_stream"}
