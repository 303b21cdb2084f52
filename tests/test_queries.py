"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest
from oracle import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql_tables():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, sql_tables, name):
    assert difference(queries()[name](spark, SF_DIR), sql_tables, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_returns_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", ["q_fact", "q_gold_customer_activity", "q_training_v1", "q_training_direct"])
def test_matches_sql_without_broadcast(spark, no_broadcast, sql_tables, name):
    assert difference(queries()[name](spark, SF_DIR), sql_tables, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["q_silver_transactions", "q_recency", "q_gold_daily", "q_stream_incremental"])
def test_independent_of_the_session_time_zone(spark, sql_tables, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert difference(queries()[name](spark, SF_DIR), sql_tables, oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
