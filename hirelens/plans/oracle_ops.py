"""DuckDB oracle SQL for the operator, report, quality and matching bindings."""

from __future__ import annotations

from . import bindings as B
from . import bindings_ops as O
from .oracle import SQL as MART_SQL
from ..functions import taxonomy as tx
from .oracle import _q, hits


def case_regex(expr: str, rules, default) -> str:
    parts = [f"when regexp_matches({expr}, {_q(p)}) then {_q(label)}" for p, label in rules]
    d = "null" if default is None else _q(default)
    return "case " + " ".join(parts) + f" else {d} end"


def case_map(expr: str, mapping, default=None) -> str:
    parts = [f"when {_q(k)} then {_q(v) if isinstance(v, str) else v}" for k, v in mapping.items()]
    d = "null" if default is None else (_q(default) if isinstance(default, str) else str(default))
    return f"case {expr} " + " ".join(parts) + f" else {d} end"


def lexicon_values(words) -> str:
    return "select unnest([" + ", ".join(_q(w) for w in words) + "]) as skill"


def in_list(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _contains_any(expr: str, words) -> str:
    return "(" + " or ".join(f"contains({expr}, {_q(w)})" for w in words) + ")"


_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def _strip(expr: str) -> str:
    return f"trim({expr}, {_WS})"


def _clean_title(expr: str) -> str:
    from ..functions.taxonomy import TITLE_SEPARATORS
    parts = [f"when contains({expr}, {_q(s)}) then {_strip(f'split_part({expr}, {_q(s)}, 1)')}" for s in TITLE_SEPARATORS]
    return "case " + " ".join(parts) + f" else {_strip(expr)} end"


def _money_k(expr: str, empty: str = "—") -> str:
    return (f"case when {expr} is null or {expr} <= 0 then {_q(empty)} "
            f"else '$' || cast(cast(trunc({expr}) as bigint) // 1000 as varchar) || 'k' end")


def _money_full(expr: str) -> str:
    return f"case when {expr} is null or {expr} <= 0 then '—' else '$' || format('{{:,}}', cast(trunc({expr}) as bigint)) end"


def _count_label(expr: str) -> str:
    return f"format('{{:,}}', cast(trunc({expr}) as bigint))"


def _title(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split({expr}, ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")


def _m(name: str) -> str:
    return "(" + MART_SQL[name] + ")"


PAGE_TITLES = f"""
    select page_id, url, {_clean_title("regexp_extract(html, '<title>(.*?)</title>', 1)")} as title from pages
"""

NEW_PAGES = f"""
    with cands as (
        select split_part(url, '/', 3) as company, split_part(url, '/', 3) as company_order,
               page_id as position, {_strip('url')} as url, title
        from ({PAGE_TITLES}) p
    ),
    ok as (
        select * from cands
        where not {_contains_any('lower(title)', O.PAGE_EXCLUDE)} and {_contains_any('lower(title)', O.PAGE_INCLUDE)}
    ),
    seen as (select {_strip('url')} as url from pages where contains(url, {_q(O.SEEN_LANG_PATH)})),
    fresh as (
        select * from ok
        where url is not null and url != '' and url not in (select url from seen where url is not null)
    ),
    ranked as (select *, row_number() over (partition by url order by company_order, position) as rn from fresh)
    select company, url, title, position from ranked where rn = 1
"""

ACTIVE = f"""
    select role_cluster, skill, job_count, median_salary, role_rank as demand_rank
    from {_m('mart_tech_skills_by_role')} r where role_cluster = {_q(O.FOCUS_LANG)}
"""

HAVE = f"""
    select conv_id, list_sort(list_distinct(flatten(list(hits)))) as have
    from (select conv_id, {hits('text', B.WORDS)} as hits from conversations) group by conv_id
"""

# every document with its words and those of the conversation it is compared with
GAP = f"""
    select doc_id, lang, coalesce(have, []) as have,
           list_sort(coalesce({hits('text', O.REQUIRED_WORDS)}, [])) as required,
           list_sort(coalesce({hits('text', O.PREFERRED_WORDS)}, [])) as preferred
    from documents left join ({HAVE}) profiles on conv_id = doc_id // {O.DOCS_PER_PROFILE}
"""


def _without(a: str, b: str) -> str:
    return f"list_filter({a}, lambda w: not list_contains({b}, w))"


def _within(a: str, b: str) -> str:
    return f"list_filter({a}, lambda w: list_contains({b}, w))"


SQL: dict[str, str] = {}

SQL["stg_dedupe"] = """
select doc_id, lang, source, n_chars, quality from (
    select d.doc_id, d.lang, d.source, d.n_chars, l.quality,
           row_number() over (partition by lower(trim(d.lang)), lower(trim(d.text))
                              order by case when l.quality is not null then 0 else 1 end, d.source, d.doc_id) as rn
    from documents d left join labels l on l.doc_id = d.doc_id
) t where rn = 1
"""

SQL["distinct_first"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate from (
    select *, row_number() over (partition by l_orderkey
                                 order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as rn
    from lineitem
) t where rn = 1
"""

SQL["stg_union"] = """
select event_id, ts, user_id, event_type, value, cast(null as varchar) as props
from events where event_type in ('click', 'view')
union all
select event_id, ts, user_id, event_type, value, props from events where event_type = 'purchase'
union all
select event_id, ts, cast(null as bigint) as user_id, event_type, cast(null as double) as value,
       cast(null as varchar) as props
from events where event_type not in ('click', 'view', 'purchase')
"""

SQL["classify_first_match"] = f"""
select doc_id, {case_regex('lower(text)', O.DOC_RULES, 'plain')} as label from documents
"""

SQL["work_type"] = f"""
select doc_id, {case_regex('lower(text)', tx.WORK_TYPE_RULES, 'FULL_TIME')} as work_type
from documents
"""

SQL["experience_level"] = f"""
select p_partkey, {case_regex('lower(p_name)', O.PART_LEVEL_RULES, 'MI')} as experience_level from part
"""

SQL["remote_flag"] = f"""
select doc_id,
       case when contains(lower(source), 'src1') then '1'
            {' '.join(f"when regexp_matches(lower(text), {_q(p)}) then {_q(v)}" for p, v in O.REMOTE_TEXT_RULES)}
            else '0' end as remote_allowed
from documents
"""

SQL["annualize"] = f"""
select event_id,
       case upper(event_type)
            {' '.join(f"when {_q(k)} then round_even(value * {float(v)}, 0)" for k, v in O.EVENT_FACTORS.items())}
            else value end as annual_value
from events
"""

SQL["salary_estimate"] = """
with b as (
    select event_id, value * 1000 as lo, cast(cast(json_extract_string(props, '$.k') as integer) * 1000 as double) as hi
    from events
)
select event_id,
       nullif((coalesce(lo, 0) + coalesce(hi, 0)) / 2, 0) as est_mid,
       case when lo is not null and lo != 0 and hi is not null and hi != 0 then round_even((lo + hi) / 2, 0)
            when lo is not null and lo != 0 then lo
            else hi end as est_either
from b
"""

SQL["json_flatten"] = """
select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events
"""

SQL["keyword_filter"] = f"""
select p_partkey, p_name from part
where not {_contains_any('lower(p_name)', O.PART_EXCLUDE)} and {_contains_any('lower(p_name)', O.PART_INCLUDE)}
"""

SQL["clean_title"] = f"select page_id, title from ({PAGE_TITLES}) p"

_STATE = case_map('trim(n.n_name)', B.NATION_CODES).replace(' else null end', ' else upper(trim(n.n_name)) end')
SQL["state_normalize"] = f"""
with s as (
    select c.c_custkey, {_STATE} as state_code
    from customer c join nation n on n.n_nationkey = c.c_nationkey
)
select c_custkey, state_code,
       coalesce(length(state_code) = 2 and regexp_matches(state_code, '^[A-Z]{{2}}$') and state_code != 'US', false)
           as is_region
from s
"""

SQL["unseen_items"] = NEW_PAGES

_DIGEST_ITEMS = f"select case when not ends_with(company, '.org') then company end as company, url, title, position from ({NEW_PAGES})"

SQL["digest_new_items"] = f"""
select *, count(*) over (partition by company) as company_items from ({_DIGEST_ITEMS})
"""

SQL["digest_totals"] = f"""
select count(*) as total_items, count(distinct company) + max(if(company is null, 1, 0)) as total_companies from ({_DIGEST_ITEMS})
"""

SQL["kpi_remote"] = """
select cast(count_if(event_type in ('click', 'view')) as bigint) as remote_count,
       count(*) as total_count,
       round(count_if(event_type in ('click', 'view')) * 100.0 / nullif(count(*), 0), 1) as remote_pct,
       cast(count_if(event_type = 'click') as bigint) as hybrid_count,
       round(count_if(event_type = 'click') * 100.0 / nullif(count(*), 0), 1) as hybrid_pct,
       max(try_cast(left(cast(ts as varchar), 10) as date)) as last_fetch_date
from events
"""

SQL["kpi_coverage"] = """
select cast(count_if(l.quality is not null) as bigint) as with_salary,
       count(*) as total,
       round(count_if(l.quality is not null) * 100.0 / nullif(count(*), 0), 0) as salary_coverage_pct
from documents d left join labels l on l.doc_id = d.doc_id
"""

SQL["kpi_headline"] = f"""
with roles as {_m('mart_salary_by_role')}
select cast(sum(posting_count) as bigint) as total_postings,
       cast(trunc(median(median_salary)) as bigint) as median_of_medians,
       (select role_cluster from roles order by posting_count desc, role_cluster limit 1) as top_role,
       (select role_cluster from roles order by median_salary desc, role_cluster limit 1) as top_pay_role,
       cast(trunc(max(median_salary)) as bigint) as top_pay_salary
from roles
"""

SQL["report_role_filtered"] = f"select * from {_m('mart_salary_by_role')} r where role_cluster = {_q(O.FOCUS_ROLE)}"

SQL["report_role_options"] = f"""
select distinct role_cluster from {_m('mart_salary_by_role')} r where role_cluster is not null
"""

SQL["report_active_skills"] = ACTIVE

SQL["report_top_states"] = f"""
select state_code, f_count as jobs, median_salary, {_count_label('f_count')} as jobs_label,
       {_money_k('median_salary')} as salary_label
from {_m('mart_jobs_by_location')} g
order by f_count desc, state_code limit 10
"""

SQL["report_state_pay"] = f"""
select state_code, median_salary, job_count from {_m('mart_jobs_by_location')} g
where median_salary > 0 order by median_salary desc, state_code limit 20
"""

SQL["report_seniority"] = f"""
select seniority, sort_order, posting_count, median_salary, {_money_k('median_salary', '')} as salary_label
from {_m('mart_salary_by_role_seniority')} r where role_cluster = {_q(O.FOCUS_SENIORITY_ROLE)}
"""

SQL["report_pay_range"] = f"""
with r as (
    select role_cluster, coalesce(p10_salary, 0) as lower_fence, coalesce(p25_salary, 0) as q1,
           coalesce(median_salary, 0) as median, coalesce(p75_salary, 0) as q3, coalesce(p90_salary, 0) as upper_fence
    from {_m('mart_salary_by_role')} m
)
select *, upper_fence - lower_fence as range_width from r where upper_fence - lower_fence > 0
"""

SQL["report_tier_labels"] = f"""
select company_tier, sort_order, job_count, median_salary,
       {_money_k('median_salary')} as salary_fmt,
       'P25 ' || {_money_k('p25_salary')} || ' — P75 ' || {_money_k('p75_salary')} as range_fmt,
       {_money_full('median_salary')} as median_fmt,
       {_count_label('job_count')} as jobs_fmt
from {_m('mart_salary_by_company_tier')} t
"""

SQL["report_skill_chips"] = f"""
with a as ({ACTIVE}),
mx as (select max(job_count) as m from a),
top as (select * from a order by demand_rank, skill limit 20)
select cast(demand_rank as bigint) as demand_rank, {_title('skill')} as skill_label, job_count,
       cast(floor(job_count * 1.0 / nullif(mx.m, 0) * 100) as bigint) as pct_of_max,
       {_money_k('median_salary')} as salary_label
from top cross join mx
"""

SQL["report_topic_top20"] = f"""
select skill_rank, {_title('skill')} as skill_label, ai_job_count, pct_of_ai_jobs,
       cast(round_even(pct_of_ai_jobs, 0) as bigint) || '%' as pct_fmt,
       {_money_k('median_salary')} as salary_label
from {_m('mart_topic_cooccurrence')} c
order by skill_rank, skill limit 20
"""

SQL["report_freshness"] = f"""
select strftime(max(month), '%Y-%m') as last_month,
       (select cast(max(ts) as date) from events) as last_fetch_date,
       (select count(*) from events) as record_count
from {_m('mart_hiring_trends')} h
"""

SQL["report_role_seniority"] = f"""
select * from {_m('mart_salary_by_role_seniority')} r where seniority in {in_list(O.FOCUS_LEVELS)}
"""

SQL["report_skill_table"] = f"""
select cast(demand_rank as bigint) as demand_rank, {_title('skill')} as skill_label, job_count,
       {_count_label('job_count')} as jobs_label, {_money_full('median_salary')} as median_label,
       {_money_k('median_salary')} as salary_k, coalesce(median_salary, 0) > 0 as in_bars
from ({ACTIVE}) a
"""

_NN = " union all ".join(
    f"select {_q(t)} as table_name, {_q(c)} as column_name, 'not_null' as check_name, "
    f"cast(count_if({c} is null) as bigint) as failures from {t}"
    for t, cols in O.DQ_NOT_NULL.items() for c in cols)
_UQ = " union all ".join(
    f"select {_q(t)} as table_name, {_q(c)} as column_name, 'unique' as check_name, "
    f"(select count(*) from (select {c} from {t} where {c} is not null group by {c} having count(*) > 1)) as failures"
    for t, c in O.DQ_UNIQUE)
SQL["dq_not_null"] = _NN
SQL["dq_unique"] = _UQ
SQL["dq_suite"] = f"""
select *, case when failures = 0 then 'pass' else 'fail' end as status from ({_NN} union all {_UQ}) c
"""

SQL["skills_extract"] = f"""
select conv_id, array_to_string(have, ',') as skills, len(have) as n_skills from ({HAVE}) where len(have) > 0
"""

SQL["skill_gap"] = f"""
from ({GAP})
select doc_id, array_to_string({_within('required', 'have')}, ',') as matched,
       array_to_string({_without('required', 'have')}, ',') as missing_critical,
       array_to_string({_without('preferred', 'have')}, ',') as missing_preferred
"""

SQL["match_score"] = f"""
from (select doc_id, len(required) as n_required, len({_within('required', 'have')}) as n_matched from ({GAP}))
select doc_id, n_required, n_matched, round(n_matched / nullif(n_required, 0), 4) as match_score,
       case when n_required = 0 then null when n_matched >= 0.7 * n_required then 'strong'
            when n_matched >= 0.5 * n_required then 'moderate' else 'weak' end as match_band
"""

SQL["learning_path"] = f"""
from (select doc_id, unnest({_without('required', 'have')}) as skill from ({GAP}))
     left join (select skill, demand_rank from {_m('mart_tech_skills')}) market using (skill)
select doc_id, skill, demand_rank::bigint as demand_rank,
       if(demand_rank <= 5, 'high', if(demand_rank <= 10, 'medium', 'low')) as priority,
       row_number() over (partition by doc_id order by demand_rank nulls last, skill) as step
"""

SQL["role_readiness"] = f"""
with tops as (select role_cluster, list_sort(list(skill)) as top from {_m('mart_tech_skills_by_role')} where role_rank <= 20 group by role_cluster)
from (select doc_id, lang, have, coalesce(top, []) as top from ({GAP}) left join tops on role_cluster = lang)
select doc_id, lang, len({_within('top', 'have')}) as covered, len(top) as top_n,
       round(100.0 * len({_within('top', 'have')}) / nullif(len(top), 0), 0) as readiness,
       array_to_string({_without('top', 'have')}, ',') as to_learn
"""


# --- staging models over raw-feed-shaped test rows -----------------------------------

_FMT = "'%Y-%m-%d %H:%M:%S'"


def _ts(expr: str) -> str:
    return f"strftime({expr}, {_FMT})"


RAW_FEED = """
    select cast(d.doc_id as varchar) as JOB_ID, p.p_name as TITLE, c.c_name as COMPANY, d.text as DESCRIPTION,
           n.n_name as LOCATION, n.n_name as STATE, cast(null as varchar) as CITY,
           o.o_totalprice * 0.8 as SALARY_MIN, o.o_totalprice * 1.2 as SALARY_MAX, o.o_totalprice as SALARY_EST,
           case when o.o_orderstatus = 'F' then '1' when o.o_orderstatus = 'O' then '0' end as REMOTE,
           cast(o.o_orderdate as varchar) as POSTED_AT, d.lang as QUERY,
           cast(o.o_orderdate as varchar) as FETCHED_AT, d.source as SOURCE, d.lang
    from documents d join orders o on o.o_orderkey = d.doc_id join customer c on c.c_custkey = o.o_custkey
         join nation n on n.n_nationkey = c.c_nationkey join part p on p.p_partkey = o.o_orderkey
"""


def _staged(where: str, source: str, salaries: bool, remote: str, work_rules) -> str:
    sal = (lambda c: f"cast({c} as double)") if salaries else (lambda c: "cast(null as double)")
    return f"""
    select JOB_ID as job_id, trim(COMPANY) as company_name, trim(TITLE) as job_title,
           trim(DESCRIPTION) as description, trim(LOCATION) as location, trim(STATE) as state_code,
           {sal('SALARY_MIN')} as min_salary, {sal('SALARY_MAX')} as max_salary, {sal('SALARY_EST')} as med_salary,
           'YEARLY' as pay_period,
           {case_regex('lower(DESCRIPTION)', work_rules, 'FULL_TIME')} as work_type,
           {remote} as remote_allowed,
           cast(null as integer) as views, cast(null as integer) as applies,
           {case_regex('lower(TITLE)', tx.EXPERIENCE_RULES, 'MI')} as experience_level,
           try_cast(POSTED_AT as timestamp) as listed_at, cast(null as timestamp) as expires_at,
           {sal('SALARY_EST')} as annual_salary_est, QUERY as search_query, {source} as source,
           try_cast(FETCHED_AT as timestamp) as _loaded_at
    from raw where {where} and JOB_ID is not null and TITLE is not null
"""


_REMOTE_A = ("case when contains(lower(LOCATION), 'remote') then '1' "
             + " ".join(f"when regexp_matches(lower(DESCRIPTION), {_q(p)}) then {_q(v)}" for p, v in tx.REMOTE_TEXT_RULES)
             + " else '0' end")
_LANGS = O.FEED_LANGS
SQL["stg_all_postings"] = f"""
with raw as ({RAW_FEED}),
adz as ({_staged(f"lang in {in_list(_LANGS['adzuna'])}", "'adzuna'", True, _REMOTE_A, tx.WORK_TYPE_RULES)}),
jse as ({_staged(f"lang in {in_list(_LANGS['jsearch'])}", "'jsearch'", True, "coalesce(REMOTE, '0')", tx.WORK_TYPE_RULES)}),
por as ({_staged(f"lang in {in_list(_LANGS['portal'])}", "SOURCE", False,
                 "case when REMOTE = '1' then '1' when contains(lower(LOCATION), 'remote') then '1' else '0' end",
                 tx.WORK_TYPE_RULES_PORTAL)}),
u as (select * from adz union all select * from jse union all select * from por),
dd as (
    select *, row_number() over (partition by lower(trim(company_name)), lower(trim(job_title)), cast(listed_at as date)
                                 order by case when annual_salary_est is not null then 0 else 1 end, source, job_id) as rn
    from u
)
select job_id, company_name, job_title, description, location, state_code, min_salary, max_salary, med_salary,
       pay_period, work_type, remote_allowed, views, applies, experience_level,
       {_ts('listed_at')} as listed_at, {_ts('expires_at')} as expires_at, annual_salary_est, search_query, source,
       {_ts('_loaded_at')} as _loaded_at
from dd where rn = 1
"""

SQL["stg_job_postings"] = f"""
with raw as (
    select o.o_orderkey as JOB_ID, c.c_name as COMPANY_NAME, o.o_orderpriority as TITLE,
           cast(null as varchar) as DESCRIPTION, c.c_mktsegment as LOCATION, o.o_totalprice * 0.5 as MIN_SALARY,
           o.o_totalprice as MAX_SALARY, o.o_totalprice / 100 as MED_SALARY,
           case o.o_orderstatus when 'F' then ' hourly' when 'O' then 'Monthly ' else 'YEARLY' end as PAY_PERIOD,
           c.c_mktsegment as FORMATTED_WORK_TYPE, o.o_orderstatus as REMOTE_ALLOWED, o.o_custkey as VIEWS,
           cast(null as varchar) as APPLIES, o.o_orderpriority as FORMATTED_EXPERIENCE_LEVEL,
           cast(epoch_ms(o.o_orderdate) as varchar) as ORIGINAL_LISTED_TIME, cast(o.o_orderdate as varchar) as EXPIRY
    from orders o join customer c on c.c_custkey = o.o_custkey
),
typed as (
    select *, upper(trim(PAY_PERIOD)) as period, cast(MED_SALARY as double) as med,
           case when regexp_matches(trim(ORIGINAL_LISTED_TIME), '^\\d+(\\.0+)?$') then
                    case when cast(regexp_extract(trim(ORIGINAL_LISTED_TIME), '^(\\d+)', 1) as bigint) >= 100000000000000
                              then make_timestamp(cast(regexp_extract(trim(ORIGINAL_LISTED_TIME), '^(\\d+)', 1) as bigint))
                         when cast(regexp_extract(trim(ORIGINAL_LISTED_TIME), '^(\\d+)', 1) as bigint) >= 100000000000
                              then epoch_ms(cast(regexp_extract(trim(ORIGINAL_LISTED_TIME), '^(\\d+)', 1) as bigint))
                         else epoch_ms(cast(regexp_extract(trim(ORIGINAL_LISTED_TIME), '^(\\d+)', 1) as bigint) * 1000) end
                else try_cast(trim(ORIGINAL_LISTED_TIME) as timestamp) end as listed_ts,
           try_cast(trim(EXPIRY) as timestamp) as expires_ts
    from raw where JOB_ID is not null and TITLE is not null
)
select cast(JOB_ID as varchar) as job_id, trim(COMPANY_NAME) as company_name, trim(TITLE) as job_title,
       trim(DESCRIPTION) as description, trim(LOCATION) as location, cast(MIN_SALARY as double) as min_salary,
       cast(MAX_SALARY as double) as max_salary, med as med_salary, period as pay_period,
       upper(trim(FORMATTED_WORK_TYPE)) as work_type, upper(trim(REMOTE_ALLOWED)) as remote_allowed,
       cast(VIEWS as integer) as views, try_cast(APPLIES as integer) as applies,
       cast(FORMATTED_EXPERIENCE_LEVEL as varchar) as experience_level,
       {_ts('listed_ts')} as listed_at, {_ts('expires_ts')} as expires_at,
       case period when 'HOURLY' then med * 2080.0 when 'MONTHLY' then med * 12.0 else med end as annual_salary_est,
       {_q(O.LOADED_AT)} as _loaded_at
from typed
"""

SQL["stg_job_skills"] = f"""
select cast(l.l_orderkey as varchar) as job_id, lower(trim(' ' || p.p_brand || ' ')) as skill_id,
       {_q(O.LOADED_AT)} as _loaded_at
from lineitem l join part p on p.p_partkey = l.l_partkey
where p.p_brand is not null
"""

SQL["stg_companies"] = f"""
select cast(c_custkey as varchar) as company_id, trim(' ' || c_name) as company_name,
       trim(c_mktsegment) as company_description, trim(cast(c_nationkey as varchar)) as company_size,
       cast(null as varchar) as state, cast(null as varchar) as country, cast(null as varchar) as city,
       cast(null as varchar) as website_url, {_q(O.LOADED_AT)} as _loaded_at
from customer
"""


# --- payload flatteners ---------------------------------------------------------------

DOC_ATTRS = """
    select d.doc_id, d.text, d.lang, d.source, o.o_orderstatus, o.o_orderpriority, o.o_totalprice, o.o_orderdate,
           c.c_name, c.c_mktsegment, n.n_name, p.p_name, p.p_type, p.p_size
    from documents d join orders o on o.o_orderkey = d.doc_id join customer c on c.c_custkey = o.o_custkey
         join nation n on n.n_nationkey = c.c_nationkey join part p on p.p_partkey = o.o_orderkey
"""

SQL["flatten_feed1"] = f"""
with j as (
    select *, case when o_orderpriority != '5-LOW' then o_totalprice end as smin,
              case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_totalprice * 1.25 end as smax
    from ({DOC_ATTRS}) x
)
select cast(doc_id as varchar) as JOB_ID, p_name as TITLE, c_name as COMPANY, text as DESCRIPTION, n_name as LOCATION,
       case when o_orderstatus in ('F', 'O') then n_name end as STATE,
       case when o_orderstatus = 'F' then c_name when o_orderstatus = 'O' then n_name end as CITY,
       smin as SALARY_MIN, smax as SALARY_MAX, nullif((coalesce(smin, 0) + coalesce(smax, 0)) / 2, 0) as SALARY_EST,
       cast(null as varchar) as REMOTE, p_type as CATEGORY, if(o_orderstatus = 'O', 'https://y/', 'https://x/') || cast(doc_id as varchar) as URL,
       cast(o_orderdate as varchar) as POSTED_AT, if(o_orderstatus = 'O', source, lang) as QUERY, {_q(O.FETCHED_AT)} as FETCHED_AT, 'adzuna' as SOURCE
from j
"""

_PERIOD = case_map("o_orderpriority", O.PERIODS)


def _annual(v: str) -> str:
    return (f"case when period = 'HOUR' then round_even({v} * 2080.0, 0) "
            f"when period in ('WEEK', 'WEEKLY') then round_even({v} * 52.0, 0) "
            f"when period in ('MONTH', 'MONTHLY') then round_even({v} * 12.0, 0) else {v} end")


SQL["flatten_feed2"] = f"""
with j as (
    select *, case when o_orderstatus != 'P' then c_mktsegment end as city,
              o_totalprice / 1000 as smin,
              case when o_orderstatus = 'F' then o_totalprice / 800 end as smax,
              upper(coalesce({_PERIOD}, '')) as period,
              case when o_orderstatus = 'O' then '' else 'https://x/' || cast(doc_id as varchar) end as apply_link,
              'https://g/' || cast(doc_id as varchar) as google_link
    from ({DOC_ATTRS}) x
),
a as (select *, {_annual('smin')} as lo, {_annual('smax')} as hi from j)
select cast(doc_id as varchar) as JOB_ID, p_name as TITLE, c_name as COMPANY, text as DESCRIPTION,
       trim(coalesce(city, '') || ', ' || coalesce(n_name, ''), ', ') as LOCATION, n_name as STATE, city as CITY,
       lo as SALARY_MIN, hi as SALARY_MAX,
       case when lo is not null and lo != 0 and hi is not null and hi != 0 then round_even((lo + hi) / 2, 0)
            when lo is not null and lo != 0 then lo else hi end as SALARY_EST,
       case when o_orderstatus = 'F' then '1' else '0' end as REMOTE, cast(p_size as varchar) as CATEGORY,
       coalesce(nullif(apply_link, ''), nullif(google_link, '')) as URL, cast(o_orderdate as varchar) as POSTED_AT,
       if(o_orderstatus = 'O', source, lang) as QUERY, {_q(O.FETCHED_AT)} as FETCHED_AT, 'jsearch' as SOURCE
from a
"""

_BOARD_LOC = ("case when o_orderstatus = 'F' then n_name || ', ' || c_mktsegment "
              "when o_orderstatus = 'O' then 'Remote, US' else n_name end")
_TITLE_OK = (f"not {_contains_any('lower(p_name)', O.PART_EXCLUDE)} and {_contains_any('lower(p_name)', O.PART_INCLUDE)}")


def _board(prefix: str, langs, desc: str, remote: str, url: str, source: str) -> str:
    return f"""
    select '{prefix}' || cast(doc_id as varchar) as JOB_ID, p_name as TITLE, c_mktsegment as COMPANY,
           {desc} as DESCRIPTION, loc as LOCATION,
           case when contains(loc, ', ') then string_split(loc, ', ')[-1] end as STATE,
           cast(null as double) as SALARY_MIN, cast(null as double) as SALARY_MAX, cast(null as double) as SALARY_EST,
           {remote} as REMOTE, '{url}' || cast(doc_id as varchar) as URL, cast(o_orderdate as varchar) as POSTED_AT,
           {_q(tx.BOARD_QUERY)} as QUERY, {_q(O.FETCHED_AT)} as FETCHED_AT, '{source}' as SOURCE
    from (select *, {_BOARD_LOC} as loc from ({DOC_ATTRS}) x) y
    where lang in {in_list(langs)} and {_TITLE_OK}
"""


SQL["flatten_boards"] = (
    _board("gh_", ["en", "de"], "cast(null as varchar)",
           "case when contains(lower(loc), 'remote') then '1' else '0' end", "https://b/", "greenhouse")
    + " union all " +
    _board("ashby_", ["fr", "es"],
           "nullif(if(o_orderstatus <> 'P', text, null), '')",
           "case when o_orderstatus = 'O' then '1' else '0' end", "https://c/", "ashby"))


SQL["flatten_search"] = f"""
select split_part(url, '/', 3) as company, page_id // {O.RESULTS_PER_PAGE} as chunk,
       row_number() over (partition by split_part(url, '/', 3), page_id // {O.RESULTS_PER_PAGE} order by page_id) - 1
           as position,
       {_strip("coalesce(url, '')")} as url,
       {_clean_title("coalesce(regexp_extract(html, '<title>(.*?)</title>', 1), '')")} as title
from pages
"""


SQL["extract_targets"] = f"""
with c as (
    select c_custkey, c_name, c_mktsegment, c_custkey // {O.TARGETS_PER_FILE} as file,
           row_number() over (partition by c_custkey // {O.TARGETS_PER_FILE} order by c_custkey) - 1 as target_order,
           lower(c_mktsegment) || '-' || cast(c_custkey as varchar) as slug
    from customer
)
select file, target_order, trim(c_name) as company,
       case when c_mktsegment in ('MACHINERY', 'BUILDING') then 'greenhouse' else 'ashby' end as kind, slug
from c where c_mktsegment in ('MACHINERY', 'BUILDING', 'AUTOMOBILE')
"""


SQL["seen_next"] = f"""
with new_items as ({NEW_PAGES}),
k as (
    select {_strip('url')} as url from pages where contains(url, {_q(O.SEEN_LANG_PATH)})
    union all
    select {_strip('url')} as url from new_items
)
select distinct url from k where url is not null and url != ''
"""


# --- lexicons that are tables ----------------------------------------------------------

def _listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


LEXICON_TABLE = f"""
    select distinct skill from (
        select unnest({_listed(B.WORDS)}) as skill union all select unnest(string_split(p_name, ' ')) from part
        union all from (select unnest(string_split_regex(lower(text), '[^a-z]+')) as skill from benchmark) where length(skill) >= 4)
"""

SQL["lexicon_table"] = f"""
select skill, count(*) as documents from ({LEXICON_TABLE}) join documents on lower(text) like '%' || skill || '%' group by skill
"""

SQL["mart_lexicon_table"] = f"""
with hits as (select skill, doc_id from ({LEXICON_TABLE}) join documents on length(text) > 100 and lower(text) like '%' || skill || '%')
select skill, count(*) as job_count, round(avg(o_totalprice), 0) as avg_salary, round(quantile_cont(o_totalprice, 0.5), 0) as median_salary,
       count(*) filter (where o_orderpriority in {tuple(B.SENIOR_PRIORITIES)}) as senior_count, rank() over (order by count(*) desc) as demand_rank
from hits join orders on o_orderkey = doc_id group by skill having count(*) > 10
"""


# --- loads and streams -------------------------------------------------------------------

SQL["load_manifest"] = f"""
select 'PAGES' as src, page_id as id, regexp_extract(html, {_q(O.TITLE_RE)}, 1) as name,
       url || ' ' || regexp_replace(html, '[\\r\\n]', ' ', 'g') as rest from pages
union all
select 'CUSTOMERS', c_custkey, c_name, c_acctbal::decimal(18, 2)::varchar || ' a "quoted", ' || c_mktsegment from customer
"""

SQL["replace_days"] = """
with ev as (select strftime(ts, '%Y-%m-%d') as day, event_type, value from events),
bought as (select distinct day from ev where event_type = 'purchase')
select day, case when day in (from bought) then 'again' else event_type end as event_type, count(*) as n, round(sum(value), 2) as total
from ev group by all
"""

SQL["feed_stream"] = f"""
select * exclude (FETCHED_AT) replace ('https://x/' || JOB_ID as URL, lang as QUERY)
from ({SQL['flatten_feed1']}) join (select doc_id::varchar as JOB_ID, lang from documents) using (JOB_ID)
"""
SQL["feed_stream"] = f"select * exclude (lang) from ({SQL['feed_stream']})"

SQL["stream_trend"] = f"""
with final as (select max(o_orderdate::date) as newest from orders
               where o_orderdate::date + interval 1 day <= (select max(o_orderdate)::timestamp - interval 3 day from orders))
select t.* from ({MART_SQL['mart_remote_trend']}) t, final where t.month + interval 1 month <= newest
"""

SQL["seen_store"] = SQL["unseen_items"]

SQL["best_postings"] = f"""
with pairs as (select conv_id, doc_id, len(required) as n_required, len({_within('required', 'have')}) as n_matched
               from ({HAVE}), (select doc_id, {hits('text', B.WORDS)} as required from documents)),
ranked as (select *, row_number() over (partition by conv_id order by n_matched / n_required desc, doc_id) as rank from pairs where n_matched > 0)
select conv_id, rank, doc_id, n_required, n_matched, round(n_matched / n_required, 4) as match_score from ranked where rank <= 10
"""
