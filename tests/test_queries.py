"""Every registered query against DuckDB, in two session time zones."""

from __future__ import annotations

import pytest
from oracle_check import actual, connect, expected

from __spark_entry__ import entry, oracle_sql
from keytide.plans.oracle import ORACLE
from keytide.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    assert entry(spark).count() == 961


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert actual(QUERIES[name](spark, sf_dir)) == expected(duck, oracle_sql()[name])


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("event_", "record_"))])
def test_query_in_another_zone(spark, sf_dir, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert actual(QUERIES[name](spark, sf_dir)) == expected(duck, oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
