"""Bindings of the library operators to the driver's test tables.

The test tables hold no job postings, so each operator is bound to columns of
the same role (see SURVEY §7.3): documents play descriptions, orders carry
pay, dates and levels, part names play titles. Every query calls the library
function; none re-implements it. Each takes ``(spark, sf_dir)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import taxonomy as tx
from ..plans import marts

# --- binding configuration ---------------------------------------------------

# Frequent words of the documents (the lexicon of the lexicon marts).
WORDS = ["the", "and", "that", "with", "this", "der", "que", "und", "die", "les", "des", "para", "por",
         "mit", "license", "apache", "token", "llm", "data", "released", "version", "under"]
# Part-name nouns as "roles" (anvil is left out → catch-all).
NOUN_ROLES = [(["widget"], "Widget"), (["gear"], "Gear"), (["bolt"], "Bolt"), (["ring"], "Ring"),
              (["rod"], "Rod"), (["plate"], "Plate"), (["gizmo"], "Gizmo")]
NOUN_ROLES_SHORT = NOUN_ROLES[:5]
# Order priority → experience code.
PRIORITY_LEVEL = {"1-URGENT": "DI", "2-HIGH": "EX", "3-MEDIUM": "SE", "4-NOT SPECIFIED": "MI", "5-LOW": "EN"}
SENIOR_PRIORITIES = ["1-URGENT", "2-HIGH"]
# Market segment tiers.
SEGMENT_TIERS = [("Heavy", "machinery|building"), ("Motor", "automobile"), ("Home", "household")]
SEGMENT_FALLBACK = "Other Segment"
# Nation names → region codes: the first 19 state codes (sorted), then the excluded 'US'.
NATION_CODES = {f"NATION_{i}": code for i, code in enumerate(sorted(tx.US_STATES.values())[:19])}
NATION_CODES["NATION_19"] = "US"
STATUS_PIVOTS = [("F", "f_count"), ("O", "o_count"), ("P", "p_count")]
TOPIC_TEXT = "license|apache|token"
TOPIC_TITLE = "widget"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as the text table of postings: job_id, description, lang."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("job_id"), F.col("text").alias("description"), "lang")


def doc_attrs(spark: SparkSession, sf_dir: str, with_title: bool = False) -> DataFrame:
    """Posting attributes keyed like the documents: orders (o_orderkey = doc_id)
    for pay and level [⋈ part (p_partkey = doc_id) for the title]."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("job_id"), F.col("o_totalprice").alias("annual_salary_est"),
        F.col("o_orderpriority").alias("experience_level"))
    if with_title:
        p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("job_id"), F.col("p_name").alias("job_title"))
        o = o.join(p, "job_id")
    return o


def line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return li.join(p, li.l_partkey == p.p_partkey)


def level_of_priority() -> F.Column:
    from ..functions.expr import label_map
    return label_map("o_orderpriority", PRIORITY_LEVEL)


# --- marts ----------------------------------------------------------------------

def q_mart_tech_skills(spark, sf_dir):
    return marts.tech_skills(doc_texts(spark, sf_dir), lexicon=WORDS, senior_values=SENIOR_PRIORITIES,
                             attrs=doc_attrs(spark, sf_dir))


def q_mart_tech_skills_by_role(spark, sf_dir):
    return marts.tech_skills_by_role(doc_texts(spark, sf_dir), lexicon=WORDS, role_col="lang",
                                     attrs=doc_attrs(spark, sf_dir).drop("experience_level"))


def q_mart_topic_cooccurrence(spark, sf_dir):
    return marts.topic_skill_cooccurrence(doc_texts(spark, sf_dir), lexicon=WORDS, text_regex=TOPIC_TEXT,
                                          title_regex=TOPIC_TITLE,
                                          attrs=doc_attrs(spark, sf_dir, with_title=True).drop("experience_level"))


def q_mart_salary_by_role(spark, sf_dir):
    return marts.salary_by_role(line_parts(spark, sf_dir), title="p_name", value="l_extendedprice",
                                roles=NOUN_ROLES)


def q_mart_salary_by_role_seniority(spark, sf_dir):
    lp = line_parts(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    j = lp.join(o, lp.l_orderkey == o.o_orderkey).withColumn("level", level_of_priority())
    return marts.salary_by_role_seniority(j, title="p_name", level="level", value="l_extendedprice",
                                          roles=NOUN_ROLES_SHORT)


def q_mart_salary_by_seniority(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("level", level_of_priority())
    return marts.salary_by_seniority(o, level="level", value="o_totalprice")


def q_mart_salary_by_company_tier(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return marts.salary_by_company_tier(j, company="c_mktsegment", value="o_totalprice",
                                        tiers=SEGMENT_TIERS, fallback=SEGMENT_FALLBACK)


def geo_input(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))


def q_mart_jobs_by_location(spark, sf_dir):
    return marts.jobs_by_location(geo_input(spark, sf_dir), state="n_name", id_col="o_orderkey",
                                  value="o_totalprice", role_col="o_orderstatus", pivots=STATUS_PIVOTS,
                                  names=NATION_CODES)


def q_mart_hiring_trends(spark, sf_dir):
    return marts.hiring_trends(line_parts(spark, sf_dir), title="p_name", ts="l_shipdate", id_col="l_orderkey",
                               roles=NOUN_ROLES)


def q_mart_remote_trend(spark, sf_dir):
    return marts.remote_trend(table(spark, sf_dir, "orders"), ts="o_orderdate", flag="o_orderstatus",
                              remote=["F"], onsite=["O"], hybrid=["P"])


def q_mart_skill_demand(spark, sf_dir):
    lp = line_parts(spark, sf_dir)
    # the sum runs past the last order, so some tags have no facts
    tags = lp.select((F.col("l_orderkey") + F.col("l_suppkey")).alias("job_id"), F.lower(F.trim(F.col("p_brand"))).alias("skill_id"))
    o = table(spark, sf_dir, "orders")
    facts = o.select(F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("listed_at"),
                     F.col("o_totalprice").alias("annual_salary_est"), F.col("o_orderstatus").alias("work_type"),
                     F.col("o_orderpriority").alias("experience_level"))
    return marts.skill_demand(tags, facts, fulltime_value="F", senior_values=SENIOR_PRIORITIES)


MART_QUERIES = {
    "mart_tech_skills": q_mart_tech_skills,
    "mart_tech_skills_by_role": q_mart_tech_skills_by_role,
    "mart_topic_cooccurrence": q_mart_topic_cooccurrence,
    "mart_salary_by_role": q_mart_salary_by_role,
    "mart_salary_by_role_seniority": q_mart_salary_by_role_seniority,
    "mart_salary_by_seniority": q_mart_salary_by_seniority,
    "mart_salary_by_company_tier": q_mart_salary_by_company_tier,
    "mart_jobs_by_location": q_mart_jobs_by_location,
    "mart_hiring_trends": q_mart_hiring_trends,
    "mart_remote_trend": q_mart_remote_trend,
    "mart_skill_demand": q_mart_skill_demand,
}
