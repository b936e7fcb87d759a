"""Flatteners, readers and sinks over small landed files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from hirelens.sources import flatten as fl
from hirelens.sources.readers import load_manifest, normalize_columns, read_csv, read_optional
from hirelens.sources.schemas import JOB_SKILLS
from hirelens.sources.sinks import load_seen, replace_day, save_seen


def write_json(d, name, obj):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        json.dump(obj, f, indent=1)
    return p


def test_flatten_adzuna(spark, tmp_dir):
    payload = {"results": [
        {"id": "1", "title": "Data Engineer", "company": {"display_name": "Acme"}, "description": "d",
         "location": {"display_name": "Austin, Texas", "area": ["US", "Texas", "Travis County", "Austin"]},
         "salary_min": 100000, "salary_max": 140000, "category": {"label": "IT"}, "redirect_url": "u1",
         "created": "2026-01-02T03:04:05Z"},
        {"id": "2", "title": "Analyst", "location": {"display_name": "US", "area": ["US"]}, "salary_min": 100000},
        {"id": "3", "title": "Analyst", "location": {"display_name": "x"}, "salary_min": None, "salary_max": None},
    ]}
    write_json(tmp_dir, "q1.json", payload)
    df = fl.read_payloads(spark, tmp_dir, "adzuna").withColumn("query", F.lit("data engineer")).withColumn("query_order", F.lit(1))
    rows = {r.JOB_ID: r for r in fl.flatten_adzuna(df, fetched_at="2026-01-02T06:00:00Z").collect()}
    assert rows["1"].STATE == "Texas" and rows["1"].CITY == "Austin" and rows["1"].COMPANY == "Acme"
    assert rows["1"].SALARY_EST == 120000.0 and rows["1"].SOURCE == "adzuna" and rows["1"].QUERY == "data engineer"
    assert rows["2"].STATE is None and rows["2"].CITY is None and rows["2"].SALARY_EST == 50000.0
    assert rows["3"].SALARY_EST is None and rows["3"].REMOTE is None


def test_flatten_jsearch(spark, tmp_dir):
    payload = {"data": [
        {"job_id": "a", "job_title": "DE", "employer_name": "X", "job_city": "Austin", "job_state": "TX",
         "job_min_salary": 50, "job_max_salary": 70, "job_salary_period": "hour", "job_is_remote": True,
         "job_required_experience": {"required_experience_in_months": 36}, "job_apply_link": "",
         "job_google_link": "g"},
        {"job_id": "b", "job_title": "DA", "job_city": None, "job_state": "TX", "job_min_salary": 90000,
         "job_salary_period": "YEAR"},
        {"job_id": "c", "job_title": "DS", "job_min_salary": 0, "job_max_salary": 120000},
    ]}
    write_json(tmp_dir, "p.json", payload)
    rows = {r.JOB_ID: r for r in fl.flatten_jsearch(fl.read_payloads(spark, tmp_dir, "jsearch").withColumn("query_order", F.lit(1))).collect()}
    a = rows["a"]
    assert (a.SALARY_MIN, a.SALARY_MAX, a.SALARY_EST) == (104000.0, 145600.0, 124800.0)
    assert a.LOCATION == "Austin, TX" and a.REMOTE == "1" and a.URL == "g" and a.CATEGORY == "36"
    assert rows["b"].LOCATION == "TX" and rows["b"].SALARY_EST == 90000.0 and rows["b"].REMOTE == "0"
    assert rows["c"].LOCATION == "" and rows["c"].SALARY_EST == 120000.0


def test_flatten_boards(spark, tmp_dir):
    gh = {"jobs": [{"id": 11, "title": "Data Analyst", "location": {"name": "Remote, US"}, "absolute_url": "u"},
                   {"id": 12, "title": "Senior Data Analyst", "location": {"name": "NYC"}},
                   {"id": 13, "title": "Data Engineer", "location": {"name": "San Francisco, CA"}}]}
    os.makedirs(os.path.join(tmp_dir, "gh"))
    write_json(os.path.join(tmp_dir, "gh"), "acme.json", gh)
    df = fl.read_payloads(spark, os.path.join(tmp_dir, "gh"), "greenhouse").withColumn("company", F.lit("Acme")).withColumn("company_order", F.lit(1))
    rows = {r.JOB_ID: r for r in fl.flatten_greenhouse(df).collect()}
    assert set(rows) == {"gh_11", "gh_13"}
    assert rows["gh_11"].REMOTE == "1" and rows["gh_11"].STATE == "US" and rows["gh_11"].DESCRIPTION is None
    assert rows["gh_13"].STATE == "CA" and rows["gh_13"].REMOTE == "0" and rows["gh_13"].SOURCE == "greenhouse"

    ash = {"jobPostings": [{"id": "z1", "title": "Data Scientist", "descriptionPlain": "x" * 2500,
                            "location": "Denver, CO", "isRemote": False},
                           {"id": "z2", "title": "Analytics Engineer", "descriptionPlain": "", "isRemote": True}]}
    os.makedirs(os.path.join(tmp_dir, "ash"))
    write_json(os.path.join(tmp_dir, "ash"), "b.json", ash)
    df = fl.read_payloads(spark, os.path.join(tmp_dir, "ash"), "ashby").withColumn("company", F.lit("B")).withColumn("company_order", F.lit(1))
    rows = {r.JOB_ID: r for r in fl.flatten_ashby(df).collect()}
    assert len(rows["ashby_z1"].DESCRIPTION) == 2500 and rows["ashby_z1"].STATE == "CO" and rows["ashby_z1"].QUERY == "portal_scan"
    assert {len(r.DESCRIPTION or "") for r in fl.flatten_ashby(df, max_desc=2000).collect()} == {2000, 0}
    assert rows["ashby_z2"].DESCRIPTION is None and rows["ashby_z2"].REMOTE == "1" and rows["ashby_z2"].LOCATION == ""


def test_distinct_jobs_keeps_first(spark):
    """Queries come before pages, pages before positions; a payload without an order is refused."""
    df = spark.createDataFrame([("1", "a", 0, 1, 1, "f"), ("1", "b", 0, 2, 0, "f"), ("1", "later", 5, 1, 1, "f"), ("2", "c", 1, 1, 0, "f"), (None, "n", 1, 1, 0, "g")],
                               "JOB_ID string, TITLE string, _pos int, _qo int, _page int, _file string")
    assert sorted((r.JOB_ID or "", r.TITLE) for r in fl.distinct_jobs(df).collect()) == [("", "n"), ("1", "a"), ("2", "c")]
    with pytest.raises(ValueError, match="query_order"):
        fl.flatten_adzuna(spark.createDataFrame([], "results array<struct<id:string>>"))


def test_search_results_and_targets(spark, tmp_dir):
    write_json(tmp_dir, "s.json", {"organic": [{"title": "Data Analyst - LA | Acme", "link": " https://x/1 "},
                                               {"title": "No link"}]})
    df = fl.read_payloads(spark, tmp_dir + "/s.json", "search").withColumn("company", F.lit("Acme"))
    rows = fl.flatten_search_results(df).orderBy("position").collect()
    assert (rows[0].url, rows[0].title) == ("https://x/1", "Data Analyst - LA") and rows[1].url == ""
    text = ("companies:\n- name: Acme\n  careers: x\n  api: https://boards-api.greenhouse.io/v1/boards/acme/jobs\n"
            "- name: Beta\n  api: https://api.ashbyhq.com/posting-api/job-board/beta/\n"
            "- name: Gamma\n  api: https://example.com/gamma\n")
    t = spark.createDataFrame([(text,)], "value string")
    got = [(r.company, r.kind, r.slug) for r in fl.extract_targets(t).orderBy("target_order").collect()]
    assert got == [("Acme", "greenhouse", "acme"), ("Beta", "ashby", "beta")]
    fallback = fl.load_targets(spark, os.path.join(tmp_dir, "missing.yml")).count()
    assert fallback == 11


def test_csv_manifest_and_optional(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "raw", "jobs"))
    with open(os.path.join(tmp_dir, "raw", "jobs", "job_skills.csv"), "w") as f:
        f.write('job_id,skill abr\n1,"SQL"\n2,"Py\nthon"\n')
    df = normalize_columns(read_csv(spark, os.path.join(tmp_dir, "raw", "jobs", "job_skills.csv"), multi_line=True))
    assert df.columns == ["JOB_ID", "SKILL_ABR"] and df.count() == 2
    done = load_manifest(spark, os.path.join(tmp_dir, "raw"), {"jobs/job_skills.csv": "JOB_SKILLS",
                                                               "postings.csv": "JOB_POSTINGS"},
                         os.path.join(tmp_dir, "out"), multi_line=True)
    assert done == {"JOB_SKILLS": 1, "JOB_POSTINGS": 0}
    assert spark.read.parquet(os.path.join(tmp_dir, "out", "JOB_SKILLS")).count() == 2
    empty = read_optional(spark, os.path.join(tmp_dir, "nope.csv"), JOB_SKILLS)
    assert empty.count() == 0 and empty.columns == ["JOB_ID", "SKILL_ABR"]


def test_replace_day_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "feed")
    d1 = spark.createDataFrame([("1", "2026-01-01T06:00:00Z"), ("2", "2026-01-01T06:00:00Z")], "JOB_ID string, FETCHED_AT string")
    d2 = spark.createDataFrame([("3", "2026-01-02T06:00:00Z")], "JOB_ID string, FETCHED_AT string")
    replace_day(d1, path)
    replace_day(d2, path)
    replace_day(d2, path)
    got = spark.read.parquet(path)
    assert got.count() == 3
    assert got.where(F.col("fetch_date") == "2026-01-01").count() == 2
    assert replace_day(d1.limit(0), path) is False and spark.read.parquet(path).count() == 3


def test_seen_store(spark, tmp_dir):
    s0 = load_seen(spark, os.path.join(tmp_dir, "seen_v0"))
    assert s0.count() == 0
    new = spark.createDataFrame([(" u1 ",), ("",), ("u2",)], "url string")
    store = os.path.join(tmp_dir, "seen_v0")
    save_seen(new, store)
    save_seen(new, store)
    save_seen(spark.createDataFrame([("u2",), ("u3",)], "url string"), store)
    assert sorted(r.url for r in load_seen(spark, store).collect()) == ["u1", "u2", "u3"]
    assert spark.read.parquet(store).count() == 3
