"""DuckDB SQL of the mart queries, stated from the operators' definitions (the correctness oracle).

Word hits are list functions over the lexicon, label rules are lists of which the first match counts, codes are looked
up in small tables, and conditional counts are FILTER aggregates. Only the binding constants are shared with the Spark
side.
"""

from __future__ import annotations

from . import bindings as b


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(values) -> str:
    return "[" + ", ".join(map(_q, values)) + "]"


def lookup(expr: str, mapping, default: str = "null") -> str:
    """Value of a dictionary for ``expr``; ``default`` is SQL."""
    keys, values = zip(*mapping.items())
    value = lambda v: _q(v) if isinstance(v, str) else str(v)
    return f"coalesce(map([{', '.join(map(value, keys))}], [{', '.join(map(value, values))}])[{expr}], {default})"


def first_rule(expr: str, rules, default: str | None, test: str = "contains") -> str:
    """Label of the first rule with a needle (or pattern) that ``expr`` has; a null ``expr`` has none."""
    listed = ", ".join(f"{{'needles': {str_list([n] if isinstance(n, str) else n)}, 'label': {_q(label)}}}" for n, label in rules)
    hit = f"list_filter([{listed}], lambda r: len(list_filter(r.needles, lambda n: {test}(coalesce({expr}, ''), n))) > 0)[1].label"
    return f"coalesce({hit}, {'null' if default is None else _q(default)})"


def hits(text: str, words) -> str:
    """The words that occur in a text."""
    return f"list_filter({str_list(words)}, lambda w: contains(lower({text}), w))"


SENIOR = f"experience_level = any({str_list(b.SENIOR_PRIORITIES)})"

DOC_PAY = """
    select doc_id as job_id, text as description, lang, o_totalprice as pay, o_orderpriority as experience_level
    from documents, orders where o_orderkey = doc_id"""

SQL: dict[str, str] = {}

SQL["mart_tech_skills"] = f"""
from (select unnest({hits('description', b.WORDS)}) as skill, * exclude (description) from ({DOC_PAY}) where length(description) > 100)
select skill, count(distinct job_id) as job_count, round(avg(pay), 0) as avg_salary, round(median(pay), 0) as median_salary,
       count(*) filter ({SENIOR}) as senior_count,
       rank() over (order by count(distinct job_id) desc)::bigint as demand_rank
group by all having job_count > 10
"""

SQL["mart_tech_skills_by_role"] = f"""
from (select unnest({hits('description', b.WORDS)}) as skill, lang as role_cluster, job_id, pay
      from ({DOC_PAY}) where length(description) > 100 and lang <> 'Other')
select role_cluster, skill, count(distinct job_id) as job_count, round(median(pay), 0) as median_salary,
       rank() over (partition by role_cluster order by count(distinct job_id) desc)::bigint as role_rank
group by role_cluster, skill having job_count >= 5
"""

SQL["mart_topic_cooccurrence"] = f"""
with gated as (
    select doc_id, o_totalprice as pay, {hits('text', b.WORDS)} as found
    from documents, orders, part
    where o_orderkey = doc_id and p_partkey = doc_id and length(text) > 100
      and (regexp_matches(lower(text), {_q(b.TOPIC_TEXT)}) or coalesce(regexp_matches(lower(p_name), {_q(b.TOPIC_TITLE)}), false)))
from (from gated select unnest(found) as skill, doc_id, pay)
select skill, count(distinct doc_id) as ai_job_count, round(median(pay), 0) as median_salary,
       round(100.0 * count(distinct doc_id) / (select count(distinct doc_id) from gated), 1) as pct_of_ai_jobs,
       rank() over (order by count(distinct doc_id) desc)::bigint as skill_rank
group by skill having ai_job_count >= 3
"""

SQL["mart_salary_by_role"] = f"""
from (select l_extendedprice as pay, {first_rule('lower(p_name)', b.NOUN_ROLES, 'Other')} as role_cluster
      from lineitem, part where p_partkey = l_partkey)
select role_cluster, count(*) as posting_count, round(avg(pay), 0) as avg_salary, round(median(pay), 0) as median_salary,
       round(min(pay), 0) as p10_salary, round(max(pay), 0) as p90_salary,
       round(quantile_cont(pay, 0.25), 0) as p25_salary, round(quantile_cont(pay, 0.75), 0) as p75_salary
where role_cluster <> 'Other' and pay > 10000 and pay < 1000000
group by role_cluster
"""

# code, label, place: the levels of the seniority marts
_LEVELS = "(values ('EN', 'Entry Level', 1), ('MI', 'Mid Level', 2), ('SE', 'Senior', 3), ('EX', 'Staff/Lead', 4), ('DI', 'Principal', 5)) levels(code, seniority, sort_order)"

SQL["mart_salary_by_role_seniority"] = f"""
from (select l_extendedprice as pay, {lookup('o_orderpriority', b.PRIORITY_LEVEL)} as code,
             {first_rule('lower(p_name)', b.NOUN_ROLES_SHORT, None)} as role_cluster
      from lineitem, part, orders where p_partkey = l_partkey and o_orderkey = l_orderkey) join {_LEVELS} using (code)
select role_cluster, seniority, sort_order, count(*) as posting_count, round(median(pay), 0) as median_salary,
       round(quantile_cont(pay, 0.1), 0) as p10_salary, round(quantile_cont(pay, 0.9), 0) as p90_salary
where pay > 20000 and pay < 800000 and role_cluster is not null
group by role_cluster, seniority, sort_order
"""

SQL["mart_salary_by_seniority"] = f"""
from orders join {_LEVELS} on code = {lookup('o_orderpriority', b.PRIORITY_LEVEL)}
select seniority, sort_order, count(*) as posting_count, round(avg(o_totalprice), 0) as avg_salary,
       round(median(o_totalprice), 0) as median_salary,
       round(quantile_cont(o_totalprice, 0.1), 0) as p10_salary, round(quantile_cont(o_totalprice, 0.9), 0) as p90_salary
where o_totalprice > 20000 and o_totalprice < 800000
group by seniority, sort_order
"""

_TIER = first_rule("lower(c_mktsegment)", [(p, label) for label, p in b.SEGMENT_TIERS], b.SEGMENT_FALLBACK, "regexp_matches")
_TIER_ORDER = {label: i + 1 for i, label in enumerate([label for label, _ in b.SEGMENT_TIERS] + [b.SEGMENT_FALLBACK])}
SQL["mart_salary_by_company_tier"] = f"""
from (select o_totalprice as pay, {_TIER} as company_tier
      from orders, customer where c_custkey = o_custkey and length(c_mktsegment) > 2)
select company_tier, count(*) as job_count, round(median(pay), 0) as median_salary, round(avg(pay), 0) as avg_salary,
       round(quantile_cont(pay, 0.25), 0) as p25_salary, round(quantile_cont(pay, 0.75), 0) as p75_salary,
       {lookup('company_tier', _TIER_ORDER)} as sort_order
where pay >= 30000 and pay <= 500000
group by company_tier
"""

_STATUS = ", ".join(f"count(*) filter (o_orderstatus = {_q(v)}) as {name}" for v, name in b.STATUS_PIVOTS)
SQL["mart_jobs_by_location"] = f"""
from (select *, {lookup('trim(n_name)', b.NATION_CODES, 'upper(trim(n_name))')} as state_code
      from orders, customer, nation where c_custkey = o_custkey and n_nationkey = c_nationkey)
select state_code, count(distinct o_orderkey) as job_count, round(median(o_totalprice), 0) as median_salary,
       round(avg(o_totalprice), 0) as avg_salary, {_STATUS}
where regexp_full_match(state_code, '[A-Z][A-Z]') and state_code <> 'US'
group by state_code having job_count >= 3
"""

SQL["mart_hiring_trends"] = f"""
from (select date_trunc('month', l_shipdate)::date as month, {first_rule('lower(p_name)', b.NOUN_ROLES, 'Other')} as role_cluster, l_orderkey
      from lineitem, part where p_partkey = l_partkey)
select month, role_cluster, count(l_orderkey) as posting_count
where month is not null and role_cluster <> 'Other'
group by month, role_cluster
"""

_FLAGS = {"remote": "F", "onsite": "O", "hybrid": "P"}
SQL["mart_remote_trend"] = f"""
from orders select date_trunc('month', o_orderdate)::date as month, count(*) as total,
       {', '.join(f"count(*) filter (o_orderstatus = '{v}') as {k}_count" for k, v in _FLAGS.items())},
       {', '.join(f"round(100.0 * count(*) filter (o_orderstatus = '{v}') / count(*), 1) as {k}_pct" for k, v in _FLAGS.items())}
where o_orderdate is not null
group by month
"""

SQL["mart_skill_demand"] = f"""
from (select l_orderkey + l_suppkey as job_id, lower(trim(p_brand)) as skill_id from lineitem, part where p_partkey = l_partkey) tags
     left join orders on o_orderkey = job_id
select skill_id, count(distinct job_id) as job_count, round(avg(o_totalprice), 0) as avg_salary,
       round(median(o_totalprice), 0) as median_salary, count(*) filter (o_orderstatus = 'F') as fulltime_count,
       count(*) filter (o_orderpriority = any({str_list(b.SENIOR_PRIORITIES)})) as senior_count,
       round(100.0 * count(*) filter (o_orderpriority = any({str_list(b.SENIOR_PRIORITIES)})) / count(distinct job_id), 1) as senior_pct,
       date_trunc('month', min(o_orderdate))::date as first_seen_month,
       rank() over (order by count(distinct job_id) desc)::bigint as demand_rank
group by skill_id
"""
