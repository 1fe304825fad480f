"""Every registered query against its DuckDB oracle (row count, column names and types, values)."""
import pytest

from conftest import SF001
from ferrule.checks.compare import compare, duck

import __spark_entry__ as E

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    r = compare(df, con, ORACLE[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 5


@pytest.mark.parametrize("name", ["bonus_status", "hoa_flags", "slow_movers_month", "period_bounds",
                                  "last_year_values", "daily_mean", "latest_valid_document"])
def test_results_do_not_depend_on_session_settings(spark, con, name):
    conf = {"spark.sql.session.timeZone": "America/Los_Angeles", "spark.sql.ansi.enabled": "false",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        r = compare(QUERIES[name](spark, SF001), con, ORACLE[name])
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["values_match"], r
