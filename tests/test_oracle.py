"""Every driver query vs its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import os

import pytest

from tests.oracle_compare import compare

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("OK") or "TYPES" in v}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["skill", "job_count", "avg_salary", "median_salary", "senior_count", "demand_rank"]
    assert df.count() >= 0
    from hirelens.plans.registry import QUERIES
    assert set(QUERIES) <= set(e.oracle_sql()) and set(QUERIES) <= set(e.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_timestamp_queries_independent_of_session_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        names = ["stg_all_postings", "stg_job_postings", "mart_hiring_trends", "mart_remote_trend", "kpi_remote",
                 "report_freshness", "flatten_feed1", "stg_union"]
        res = compare(spark, SF, names, verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    bad = {k: v for k, v in res.items() if not v.startswith("OK") or "TYPES" in v}
    assert not bad, bad
