"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry_module
from tests.compare import difference, views
from tidemark.plans import PLANS

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return views(SF_DIR)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_matches_sql(spark, connection, name):
    assert difference(PLANS[name].run(spark, SF_DIR), connection, PLANS[name].sql) is None


@pytest.mark.parametrize("name", ["asof_join", "asof_join_multi", "asof_join_full_ts", "asof_join_orders", "synthetic_clock", "price_levels"])
def test_matches_sql_with_every_key_split(spark, split_keys, connection, name):
    assert difference(PLANS[name].run(spark, SF_DIR), connection, PLANS[name].sql) is None


@pytest.mark.parametrize("partitions", ["1", "17"])
@pytest.mark.parametrize("name", ["asof_join_multi", "sample_last_not_null", "latest_on", "page_assignment", "upsert_keep_last"])
def test_any_partitioning_gives_the_same(spark, connection, name, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert difference(PLANS[name].run(spark, SF_DIR), connection, PLANS[name].sql) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
