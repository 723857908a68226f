"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001 here)."""

import pytest

import __spark_entry__ as E
from tidemark.plans import catalog

from .conftest import SF_SMOKE
from .oracle_check import compare, duck

KEYS = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    status, ns, nd, diffs = compare(spark, SF_SMOKE, key, E.queries()[key], E.oracle_sql()[key], con)
    assert status == "OK", (status, ns, nd, diffs)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "observation_month" and len(df.columns) == 27


@pytest.mark.parametrize("key", ["economic_dashboard", "dq_freshness", "load_log", "dedup_latest_observation"])
def test_results_do_not_depend_on_session_time_zone(spark, key):
    fn = E.queries()[key]
    tz = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = sorted(map(repr, fn(spark, SF_SMOKE).collect()))
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        la = sorted(map(repr, fn(spark, SF_SMOKE).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
    assert utc == la
