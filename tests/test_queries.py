import pytest

import __spark_entry__
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, connection, sf, name):
    assert compare(spark, connection, sf, name) == ""


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["name", "sequence", "quality", "umi", "umi_qual", "x", "y"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
