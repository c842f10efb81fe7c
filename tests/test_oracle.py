"""Every registered query against its oracle SQL, and the driver contract."""

import pytest

from compare import difference, oracle_connection
from workloads.catalog import CATALOG

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_oracle(spark, oracle, name):
    entry = CATALOG[name]
    assert difference(spark, oracle, entry.run, entry.sql, SF_DIR) is None


def test_driver_contract(spark):
    import __spark_entry__ as contract

    assert set(CATALOG) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
