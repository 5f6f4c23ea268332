"""Every registered query against its DuckDB SQL on the smallest tables; those without SQL at least run."""

import os

import oracle
import pytest

from spoor import plans, registry  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    assert oracle.rows_of_spark(registry.QUERIES[name](spark, SF)) == oracle.rows_of_sql(duck, registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    found = registry.QUERIES[name](spark, SF)
    assert len(found.collect()) == found.count()


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
