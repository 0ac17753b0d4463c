"""Every registered query gives the answer of its SQL counterpart."""

import pytest

from workload.compare import compare, connect
from workload.oracles import oracle_sql
from workload.queries import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_query_has_a_counterpart():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", queries())
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR).startswith("ok")


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["repo_name", "count"]
