"""Driver bindings that run the shipped rules: job titles, employers and states dealt over rows of the test tables, so
that the default role clusters, tiers, state names, title filters, lexicons and topic patterns decide the rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions import taxonomy as tx
from ..functions.classify import (clean_title, classify, company_tier, experience_level, is_region_code, keyword_filter,
                                  normalize_state, tier_order)
from . import bindings as B
from . import marts
from .oracle import _q, first_rule, hits, lookup, str_list

TITLES = ["Data Engineer", "Senior Data Scientist", "Machine Learning Engineer", "Lead Analytics Engineer", "AI Engineer | Acme",
          "Software Engineer - Platform", "Data Analyst, Intern", "Principal LLM Engineer", "Business Intelligence Analyst at Acme", "Office Manager",
          "Staff Software Engineer", "Junior Data Analyst", "Research Scientist, Gen AI", "Product Data Scientist @ X", "Nurse"]
COMPANIES = ["Google", "Stripe", "Oracle Corp", "Tiny Studio", "X", "OpenAI", "Databricks", "Intel", "", "Corner Shop"]
STATES = ["Texas", "California ", "New York", "tx", "US", "CA", "Ontario", "Washington", "new york", "Florida"]
WORDS_IN_TEXTS = ["sql", "license", "spark", "apache", "aws"]


def dealt(values: list[str], key: str) -> Column:
    """A value by the remainder of a key."""
    return F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values) + 1).cast("int"))


def _dealt_sql(values: list[str], key: str) -> str:
    return f"{str_list(values)}[({key} % {len(values)} + 1)::int]"


def q_default_titles(spark, d):
    """C3, C6a-e, C10, C11 and the topic title pattern with their default rules."""
    p = B.table(spark, d, "part").select("p_partkey", dealt(TITLES, "p_partkey").alias("title"))
    return p.select(
        "p_partkey", "title", experience_level("title").alias("level"),
        classify("title", tx.ROLES_TRENDS, "Other").alias("role_trends"), classify("title", tx.ROLES_LOCATION, None).alias("role_location"),
        classify("title", tx.ROLES_SALARY, "Other").alias("role_salary"), classify("title", tx.ROLES_SENIORITY, None).alias("role_seniority"),
        classify("title", tx.ROLES_SKILLS, "Other").alias("role_skills"), keyword_filter("title").alias("wanted"),
        clean_title("title").alias("cleaned"), F.lower("title").rlike(tx.TOPIC_TITLE_REGEX).alias("topic"))


def q_default_places(spark, d):
    """C8 and C9 with their default rules."""
    c = B.table(spark, d, "customer").select("c_custkey", dealt(COMPANIES, "c_custkey").alias("company"), dealt(STATES, "c_custkey").alias("state"))
    code = normalize_state("state")
    return c.select("c_custkey", company_tier("company").alias("tier"), F.coalesce(tier_order(company_tier("company")), F.lit(0)).cast("int").alias("tier_order"),
                    code.alias("state_code"), is_region_code(code).alias("is_region"))


def q_default_jobs_by_location(spark, d):
    """M2 with the title rules (C6b), state names and pivots as shipped."""
    o = B.table(spark, d, "orders").select("o_orderkey", "o_totalprice", dealt(TITLES, "o_orderkey").alias("job_title"),
                                           dealt(STATES, "o_custkey").alias("state_code"))
    return marts.jobs_by_location(o, id_col="o_orderkey", value="o_totalprice")


def q_default_skills_by_role(spark, d):
    """M10 with the title rules as shipped (C6e)."""
    attrs = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_totalprice").alias("annual_salary_est"),
                                               dealt(TITLES, "o_orderkey").alias("job_title"))
    return marts.tech_skills_by_role(B.doc_texts(spark, d).drop("lang"), lexicon=tx.LEXICON_BY_ROLE + WORDS_IN_TEXTS, attrs=attrs)


QUERIES = {
    "default_titles": q_default_titles,
    "default_places": q_default_places,
    "default_jobs_by_location": q_default_jobs_by_location,
    "default_skills_by_role": q_default_skills_by_role,
}

_TITLE = _dealt_sql(TITLES, "p_partkey")


def _any(expr: str, words) -> str:
    return f"(len(list_filter({str_list(words)}, lambda w: contains({expr}, w))) > 0)"


_SEPARATOR = f"list_filter({str_list(tx.TITLE_SEPARATORS)}, lambda s: contains(title, s))[1]"
_EXPERIENCE = first_rule("lower(title)", tx.EXPERIENCE_RULES, tx.EXPERIENCE_DEFAULT, "regexp_matches")
_TIER = first_rule("lower(company)", [(p, label) for label, p in tx.COMPANY_TIERS], None, "regexp_matches")
_STATE = lookup("trim(state)", tx.US_STATES, "upper(trim(state))")
_TIER_ORDER = {label: i + 1 for i, label in enumerate([label for label, _ in tx.COMPANY_TIERS] + [tx.TIER_FALLBACK])}
_LOCATION_COUNTS = ", ".join(f"count(*) filter (role = {_q(label)}) as {name}" for label, name in tx.LOCATION_PIVOTS)

SQL = {
    "default_titles": f"""
from (select p_partkey, {_TITLE} as title from part)
select p_partkey, title, {_EXPERIENCE} as level, {first_rule('lower(title)', tx.ROLES_TRENDS, 'Other')} as role_trends,
       {first_rule('lower(title)', tx.ROLES_LOCATION, None)} as role_location, {first_rule('lower(title)', tx.ROLES_SALARY, 'Other')} as role_salary,
       {first_rule('lower(title)', tx.ROLES_SENIORITY, None)} as role_seniority, {first_rule('lower(title)', tx.ROLES_SKILLS, 'Other')} as role_skills,
       {_any('lower(title)', tx.TITLE_INCLUDE)} and not {_any('lower(title)', tx.TITLE_EXCLUDE)} as wanted,
       trim(if({_SEPARATOR} is null, title, split_part(title, {_SEPARATOR}, 1))) as cleaned,
       regexp_matches(lower(title), {_q(tx.TOPIC_TITLE_REGEX)}) as topic
""",
    "default_places": f"""
from (select *, coalesce({_TIER}, if(length(company) > 2, {_q(tx.TIER_FALLBACK)}, {_q(tx.TIER_UNKNOWN)})) as tier
      from (select c_custkey, {_dealt_sql(COMPANIES, 'c_custkey')} as company, {_dealt_sql(STATES, 'c_custkey')} as state from customer))
select c_custkey, tier, ({lookup("tier", _TIER_ORDER, "0")})::int as tier_order, {_STATE} as state_code,
       regexp_full_match({_STATE}, '[A-Z][A-Z]') and {_STATE} <> 'US' as is_region
""",
    "default_jobs_by_location": f"""
from (select o_orderkey, o_totalprice, {_STATE} as state_code, {first_rule('lower(title)', tx.ROLES_LOCATION, None)} as role
      from (select *, {_dealt_sql(TITLES, 'o_orderkey')} as title, {_dealt_sql(STATES, 'o_custkey')} as state from orders))
select state_code, count(distinct o_orderkey) as job_count, round(median(o_totalprice), 0) as median_salary,
       round(avg(o_totalprice), 0) as avg_salary, {_LOCATION_COUNTS}
where regexp_full_match(state_code, '[A-Z][A-Z]') and state_code <> 'US' group by state_code having job_count >= 3
""",
    "default_skills_by_role": f"""
from (select unnest({hits('text', list(dict.fromkeys(tx.LEXICON_BY_ROLE + WORDS_IN_TEXTS)))}) as skill, o_orderkey, o_totalprice,
             {first_rule('lower(title)', tx.ROLES_SKILLS, 'Other')} as role_cluster
      from (select text, o_orderkey, o_totalprice, {_dealt_sql(TITLES, 'o_orderkey')} as title from documents, orders
            where o_orderkey = doc_id and length(text) > 100))
select role_cluster, skill, count(distinct o_orderkey) as job_count, round(median(o_totalprice), 0) as median_salary,
       rank() over (partition by role_cluster order by count(distinct o_orderkey) desc)::bigint as role_rank
where role_cluster <> 'Other' group by role_cluster, skill having job_count >= 5
""",
}
