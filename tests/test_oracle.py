"""Every registered query vs its DuckDB oracle (row count, columns, values).

Runs on sf0.001 by default; CARELAKE_ORACLE_SF=/root/testdata/sf0.01 for the
driver's scale.
"""

import pytest

from tests.conftest import SF_ORACLE
from tests.harness import compare, duck

import __spark_entry__ as E
from carelake.queries import REGISTRY

ORACLE = {k: v for k, v in E.oracle_sql().items() if k in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    r = compare(df, con, ORACLE[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "patient_responsibility" in df.columns


@pytest.mark.parametrize("name", ["billing_batch", "gap_batch", "recent_activity", "sla_report"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(E.queries()[name](spark, SF_ORACLE), con, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ok"], r
