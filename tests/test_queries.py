"""Every query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck
from repotide.plans.oracles import ORACLES
from repotide.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    found, _, problem = compare(spark, connection, SF, name, QUERIES[name], ORACLES.get(name))
    assert problem is None
    assert found > 0 or name == "min_docs_gate"


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())


def test_flagship(spark):
    assert entry(spark).count() == 40
