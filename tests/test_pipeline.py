"""Golden mini-pipeline: hand-made raw feed rows → staging → marts, hand-checked."""

import os

import pytest
from pyspark.sql import functions as F

from hirelens.plans import marts, staging
from hirelens.plans.pipeline import run_pipeline
from hirelens.sources.schemas import ADZUNA, COMPANIES, JOB_POSTINGS, JOB_SKILLS, JSEARCH, PORTAL

DESC = "We need python and sql and spark skills for this data role; airflow and dbt are a plus. " * 2


def adz(spark):
    rows = [
        # JOB_ID, TITLE, COMPANY, DESCRIPTION, LOCATION, STATE, CITY, MIN, MAX, EST, REMOTE, CAT, URL, POSTED, QUERY, FETCHED, SOURCE
        ("a1", "Senior Data Engineer", "Google", DESC + " fully remote", "Remote", "California", "SF", 150000.0,
         170000.0, 160000.0, None, "IT", "u", "2026-01-05T10:00:00Z", "q", "2026-01-06T06:00:00Z", "adzuna"),
        ("a2", "Data Analyst", "Acme", DESC + " contract c2c", "Austin, TX", "Texas", "Austin", None, None, None,
         None, "IT", "u", "2026-01-05T11:00:00Z", "q", "2026-01-06T06:00:00Z", "adzuna"),
        ("a3", "Data Scientist", " Acme ", DESC, "NYC", "New York", None, 120000.0, 140000.0, 130000.0, None, None,
         "u", "2026-02-01T00:00:00Z", "q", "2026-02-02T06:00:00Z", "adzuna"),
        (None, "No id", "X", DESC, "", None, None, None, None, None, None, None, None, None, "q", None, "adzuna"),
    ]
    return spark.createDataFrame(rows, ADZUNA)


def jse(spark):
    rows = [
        # same company/title/day as a2 but with pay → wins the dedup
        ("j1", "data analyst ", "acme", DESC, "Austin, TX", "TX", "Austin", 80000.0, 100000.0, 90000.0, "0", "12",
         "u", "2026-01-05T15:00:00Z", "q", "2026-01-06T06:00:00Z", "jsearch"),
        ("j2", "Machine Learning Engineer", "Stripe", DESC + " llm rag ", "NYC", "NY", "NYC", 200000.0, 220000.0,
         210000.0, "1", None, "u", "2026-02-10T00:00:00Z", "q", "2026-02-11T06:00:00Z", "jsearch"),
    ]
    return spark.createDataFrame(rows, JSEARCH)


def por(spark):
    rows = [("gh_1", "Analytics Engineer", "Notion", None, "Remote, US", "US", None, None, None, "0", "u",
             "2026-01-20T00:00:00Z", "greenhouse", "2026-01-21T06:00:00Z", None)]
    return spark.createDataFrame(rows, PORTAL)


@pytest.fixture(scope="module")
def postings(spark):
    return staging.stg_all(adz(spark), jse(spark), por(spark)).cache()


def test_staging_and_dedup(postings):
    rows = {r.job_id: r for r in postings.collect()}
    assert set(rows) == {"a1", "a3", "j1", "j2", "gh_1"}  # a2 loses to pay-bearing j1; null id dropped
    assert rows["a1"].remote_allowed == "1" and rows["a1"].experience_level == "SE"
    assert rows["a1"].work_type == "FULL_TIME" and rows["a3"].company_name == "Acme"
    assert rows["j2"].remote_allowed == "1" and rows["gh_1"].remote_allowed == "1"
    assert rows["gh_1"].annual_salary_est is None and rows["gh_1"].source == "greenhouse"
    assert len(postings.columns) == 21


def test_dedup_tie_and_idempotent(spark, postings):
    from hirelens.operators.dedupe import dedupe_postings
    twice = dedupe_postings(postings)
    assert sorted(r.job_id for r in twice.collect()) == sorted(r.job_id for r in postings.collect())
    tie = spark.createDataFrame([("b", "X", "T", None, "s"), ("a", "x ", "t", None, "s")],
                                "job_id string, company_name string, job_title string, listed_at timestamp, source string"
                                ).withColumn("annual_salary_est", F.lit(None).cast("double"))
    assert [r.job_id for r in dedupe_postings(tie).collect()] == ["a"]


def test_marts_golden(postings):
    role = {r.role_cluster: r for r in marts.salary_by_role(postings).collect()}
    assert set(role) == {"Data Engineer", "Data Analyst", "Data Scientist", "ML Engineer"}
    assert role["Data Engineer"].median_salary == 160000.0 and role["Data Engineer"].posting_count == 1
    sk = {r.skill: r for r in marts.tech_skills(postings, min_count=0).collect()}
    assert sk["python"].job_count == 4 and sk["python"].demand_rank == 1
    assert "java" not in sk
    geo = {r.state_code: r for r in marts.jobs_by_location(postings, min_count=1).collect()}
    assert set(geo) == {"CA", "NY", "TX"}  # 'US' is excluded; 'New York' maps to NY
    assert geo["NY"].job_count == 2 and geo["NY"].ds_count == 1 and geo["NY"].ml_count == 1
    trend = {(str(r.month), r.role_cluster): r.posting_count for r in marts.hiring_trends(postings).collect()}
    assert trend[("2026-01-01", "Data Engineer")] == 1 and trend[("2026-02-01", "ML Engineer")] == 1
    rt = {str(r.month): r for r in marts.remote_trend(postings).collect()}
    assert rt["2026-01-01"].total == 3 and rt["2026-01-01"].remote_count == 2 and rt["2026-01-01"].remote_pct == 66.7
    tiers = {r.company_tier: r.sort_order for r in marts.salary_by_company_tier(postings).collect()}
    assert tiers == {"FAANG+": 1, "Scale-up": 2, "Startup / Other": 4}
    cooc = {r.skill: r for r in marts.topic_skill_cooccurrence(postings, min_count=1).collect()}
    assert cooc["python"].ai_job_count == 1 and cooc["python"].pct_of_ai_jobs == 100.0


def test_full_pipeline_with_checks(spark, tmp_dir):
    posts = spark.createDataFrame([
        ("10", "Acme", "Data Engineer", "d", "Austin", "10", "20", "25", "hourly ", "Full-time", "true", "3.0", "1",
         "Entry level", "1713397508000", "2024-05-01"),
        ("11", "Beta", "Analyst", None, None, None, None, "5000", "MONTHLY", None, None, None, None, None, "junk", None),
    ], JOB_POSTINGS)
    skills = spark.createDataFrame([("10", " SQL "), ("11", "PY"), (None, "x")], JOB_SKILLS)
    comps = spark.createDataFrame([("1", " Acme ", None, None, None, None, None, None)], COMPANIES)
    stg = staging.stg_job_postings(posts, loaded_at="2026-01-01 00:00:00").collect()
    assert stg[0].annual_salary_est == 52000.0 and stg[0].pay_period == "HOURLY" and stg[0].views == 3
    assert str(stg[0].listed_at) == "2024-04-17 23:45:08" and stg[1].listed_at is None
    assert stg[1].annual_salary_est == 60000.0
    raw = {"ADZUNA_POSTINGS": adz(spark), "JSEARCH_POSTINGS": jse(spark), "PORTAL_POSTINGS": por(spark),
           "JOB_POSTINGS": posts, "JOB_SKILLS": skills, "COMPANIES": comps}
    res = {(r.table_name, r.column_name, r.check_name): r.failures
           for r in run_pipeline(spark, raw, os.path.join(tmp_dir, "wh"), loaded_at="2026-01-01").collect()}
    assert res[("stg_job_postings", "job_id", "unique")] == 0
    assert res[("mart_skill_demand", "skill_id", "unique")] == 0
    assert all(v == 0 for v in res.values())
    assert spark.read.parquet(os.path.join(tmp_dir, "wh", "mart_tech_skills")).count() >= 0
    bucketed = {(r.table_name, r.column_name, r.check_name): r.failures for r in
                run_pipeline(spark, raw, os.path.join(tmp_dir, "wh_b"), loaded_at="2026-01-01", buckets=2).collect()}
    assert bucketed == res
    a = spark.read.parquet(os.path.join(tmp_dir, "wh", "mart_skill_demand")).collect()
    b = spark.read.parquet(os.path.join(tmp_dir, "wh_b", "mart_skill_demand")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_bucketed_tables_join_without_shuffle(spark, tmp_dir):
    from hirelens.operators.tags import tag_demand
    from hirelens.sources.sinks import write_bucketed
    facts = spark.range(2000).select(F.col("id").cast("string").alias("job_id"),
                                     F.lit(None).cast("timestamp").alias("listed_at"),
                                     F.col("id").cast("double").alias("annual_salary_est"),
                                     F.lit("FULL_TIME").alias("work_type"), F.lit("EN").alias("experience_level"))
    tags = spark.range(6000).select((F.col("id") % 2000).cast("string").alias("job_id"),
                                    F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("skill_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = write_bucketed(facts, "b_facts", os.path.join(tmp_dir, "b_facts"), "job_id", 4)
        t = write_bucketed(tags, "b_tags", os.path.join(tmp_dir, "b_tags"), "job_id", 4)
        j = t.join(f, "job_id", "left")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert tag_demand(t, f).count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lexicon_marts_from_hits_equal_those_from_texts(spark, postings):
    hits = marts.posting_hits(postings)
    for fn in (marts.tech_skills, marts.tech_skills_by_role, marts.topic_skill_cooccurrence):
        low = {"min_count": 0} if fn is not marts.topic_skill_cooccurrence else {"min_count": 1}
        a, b = fn(postings, **low), fn(postings, hits=hits, **low)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
