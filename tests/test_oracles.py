"""Every registered query with an oracle, on the smallest tables, and the contract of the entry module."""

import pytest
from oracle import connect, differences

import __spark_entry__
from voxlake import registry


@pytest.fixture()
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, con, sf_dir, name):
    assert differences(spark, con, name, registry.QUERIES[name], registry.ORACLES[name], sf_dir) is None


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "total_spines" in df.columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
