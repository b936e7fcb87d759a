"""The eleven marts (M1–M11), each composed from the generic operators.

Every function takes the de-duplicated posting table (canonical columns, see
``sources.schemas.POSTING``) plus its configuration; column names are
parameters so the same plan runs over other tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy as tx
from ..functions.classify import classify, company_tier, seniority_label, seniority_order, tier_order
from ..functions.expr import in_window
from ..operators.geo import geo_rollup
from ..operators.lexicon import hit_words, lexicon_demand, lexicon_match, text_hits, topic_cooccurrence
from ..operators.stats import salary_stats
from ..operators.tags import tag_demand
from ..operators.trends import monthly_counts, share_trend


def hiring_trends(postings: DataFrame, title: str = "job_title", ts: str = "listed_at", id_col: str = "job_id",
                  roles=tx.ROLES_TRENDS, other: str = "Other") -> DataFrame:
    """M1: month, role_cluster, posting_count (catch-all role dropped)."""
    src = postings.select(F.col(ts), F.col(id_col), classify(title, roles, other).alias("role_cluster"))
    src = src.where(F.col("role_cluster") != F.lit(other))
    return monthly_counts(src, ts, ["role_cluster"], id_col)


def jobs_by_location(postings: DataFrame, state: str = "state_code", title: str = "job_title",
                     id_col: str = "job_id", value: str = "annual_salary_est", roles=tx.ROLES_LOCATION,
                     pivots=tx.LOCATION_PIVOTS, names: Mapping[str, str] = tx.US_STATES,
                     exclude: Sequence[str] = ("US",), min_count: int = 3, role_col: str | None = None) -> DataFrame:
    """M2: per state code: job_count, median/avg pay, fixed role-count pivot.

    ``role_col`` names an existing role column; otherwise roles come from
    the title rules.
    """
    src = postings
    if role_col is None:
        src = src.withColumn("_role", classify(title, roles, None))
        role_col = "_role"
    return geo_rollup(src, state, id_col, value, role_col, pivots, names, exclude, min_count)


def remote_trend(postings: DataFrame, ts: str = "listed_at", flag: str = "remote_allowed",
                 remote: Sequence[str] | None = ("1",), onsite: Sequence[str] | None = ("0",),
                 hybrid: Sequence[str] | None = ("hybrid",)) -> DataFrame:
    """M3: month, total, remote/onsite/hybrid counts and shares.

    The values default to what the feeds emit ('1' / '0' / 'hybrid'); pass
    ``None`` for a bucket to count NULL flags instead.
    """
    return share_trend(postings, ts, flag, [("remote", remote), ("onsite", onsite), ("hybrid", hybrid)])


def salary_by_company_tier(postings: DataFrame, company: str = "company_name", value: str = "annual_salary_est",
                           tiers=tx.COMPANY_TIERS, fallback: str = tx.TIER_FALLBACK,
                           unknown: str = tx.TIER_UNKNOWN, lo: float = 30000, hi: float = 500000,
                           min_len: int = 2) -> DataFrame:
    """M4: company_tier, job_count, median/avg/p25/p75, sort_order."""
    src = postings.where(F.col(value).isNotNull() & in_window(value, lo, hi, inclusive=True))
    src = src.select(F.col(value), company_tier(company, tiers, fallback, unknown, min_len).alias("company_tier"))
    src = src.where(F.col("company_tier") != F.lit(unknown))
    g = salary_stats(src, ["company_tier"], value, {
        "job_count": "count", "median_salary": "median", "avg_salary": "avg",
        "p25_salary": 0.25, "p75_salary": 0.75})
    return g.withColumn("sort_order", tier_order("company_tier", tiers, fallback))


def salary_by_role(postings: DataFrame, title: str = "job_title", value: str = "annual_salary_est",
                   roles=tx.ROLES_SALARY, other: str = "Other", lo: float = 10000, hi: float = 1000000,
                   role_col: str | None = None) -> DataFrame:
    """M5: role_cluster, posting_count, avg, median, p10 (= min), p90 (= max), p25, p75.

    The p10/p90 names hold min/max, as in the pipeline this reproduces.
    """
    src = postings.where(in_window(value, lo, hi))
    role = F.col(role_col) if role_col else classify(title, roles, other)
    src = src.select(F.col(value), role.alias("role_cluster")).where(F.col("role_cluster") != F.lit(other))
    return salary_stats(src, ["role_cluster"], value, {
        "posting_count": "count", "avg_salary": "avg", "median_salary": "median",
        "p10_salary": "min", "p90_salary": "max", "p25_salary": 0.25, "p75_salary": 0.75})


def salary_by_role_seniority(postings: DataFrame, title: str = "job_title", level: str = "experience_level",
                             value: str = "annual_salary_est", roles=tx.ROLES_SENIORITY,
                             labels=tx.SENIORITY_LABELS, order=tx.SENIORITY_ORDER,
                             lo: float = 20000, hi: float = 800000) -> DataFrame:
    """M6: role_cluster, seniority, sort_order, posting_count, median, p10, p90."""
    src = postings.where(in_window(value, lo, hi) & F.col(level).isin(list(labels)))
    src = src.select(F.col(value), classify(title, roles, None).alias("role_cluster"),
                     seniority_label(level, labels).alias("seniority"),
                     seniority_order(level, order).alias("sort_order"))
    src = src.where(F.col("role_cluster").isNotNull())
    return salary_stats(src, ["role_cluster", "seniority", "sort_order"], value, {
        "posting_count": "count", "median_salary": "median", "p10_salary": 0.10, "p90_salary": 0.90})


def salary_by_seniority(postings: DataFrame, level: str = "experience_level", value: str = "annual_salary_est",
                        labels=tx.SENIORITY_LABELS, order=tx.SENIORITY_ORDER,
                        lo: float = 20000, hi: float = 800000) -> DataFrame:
    """M7: seniority, sort_order, posting_count, avg, median, p10, p90."""
    src = postings.where(in_window(value, lo, hi) & F.col(level).isNotNull() & F.col(level).isin(list(labels)))
    g = salary_stats(src.select(F.col(level), F.col(value)), [level], value, {
        "posting_count": "count", "avg_salary": "avg", "median_salary": "median",
        "p10_salary": 0.10, "p90_salary": 0.90})
    return g.select(seniority_label(level, labels, "Other").alias("seniority"),
                    seniority_order(level, order, 9).alias("sort_order"),
                    "posting_count", "avg_salary", "median_salary", "p10_salary", "p90_salary")


def skill_demand(tags: DataFrame, postings: DataFrame, fulltime_value: str = "FULL_TIME",
                 senior_values: Sequence[str] = ("EN", "EX"), **cols) -> DataFrame:
    """M8: per tag: job_count, avg/median pay, fulltime/senior counts, senior_pct,
    first_seen_month, demand_rank. ``fulltime_value`` defaults to what the feeds
    emit (the pipeline tested a spelling no feed produces)."""
    return tag_demand(tags, postings, fulltime_value=fulltime_value, senior_values=senior_values, **cols)


def tech_skills(postings: DataFrame, id_col: str = "job_id", text: str = "description",
                value: str = "annual_salary_est", level: str = "experience_level",
                lexicon: Sequence[str] = tx.LEXICON_DEMAND, senior_values: Sequence[str] = ("EX", "DI"),
                min_count: int = 10, min_len: int = 100, mode: str = "substring",
                attrs: DataFrame | None = None, hits: DataFrame | None = None) -> DataFrame:
    """M9 (flagship): skill, job_count, avg/median pay, senior_count, demand_rank.

    Lexicon duplicates are dropped once (so a repeated word is not counted
    twice in ``senior_count``); groups need ``job_count > min_count``.
    With ``attrs`` (id, value, level in another table) the text is matched
    first and only the hits are joined to the attributes. ``hits`` (see
    ``lexicon.text_hits``) replaces the pass over the texts.
    """
    if hits is not None:
        m = hits.select(id_col, value, level, F.explode(hit_words(lexicon)).alias("skill"))
        return lexicon_demand(m, ["skill"], id_col, value, level_col=level, senior_values=senior_values, min_count=min_count)
    keep = [id_col] if attrs is not None else [id_col, value, level]
    m = lexicon_match(postings, text, lexicon, keep=keep, min_len=min_len, mode=mode, attrs=attrs, on=id_col)
    return lexicon_demand(m, ["skill"], id_col, value, level_col=level, senior_values=senior_values,
                          min_count=min_count)


def tech_skills_by_role(postings: DataFrame, id_col: str = "job_id", text: str = "description",
                        title: str = "job_title", value: str = "annual_salary_est",
                        lexicon: Sequence[str] = tx.LEXICON_BY_ROLE, roles=tx.ROLES_SKILLS, other: str = "Other",
                        min_count: int = 5, min_len: int = 100, role_col: str | None = None,
                        mode: str = "substring", attrs: DataFrame | None = None, hits: DataFrame | None = None) -> DataFrame:
    """role_cluster, skill, job_count, median_salary, role_rank (rank within role).

    The role comes from ``role_col`` or from title rules, read from the text
    table when it has the column (then the catch-all role is dropped before
    matching), else from ``attrs`` after the join.
    """
    role = F.col(role_col) if role_col else classify(title, roles, other)
    role_src = role_col or title
    if hits is not None:
        m = hits.select(id_col, value, role.alias("role_cluster"), "_words").where(F.col("role_cluster") != F.lit(other))
        m = m.select(id_col, value, "role_cluster", F.explode(hit_words(lexicon)).alias("skill"))
    elif role_src in postings.columns:
        src = postings.select(F.col(id_col), F.col(text), role.alias("role_cluster"),
                              *([F.col(value)] if attrs is None else []))
        src = src.where(F.col("role_cluster") != F.lit(other))
        keep = [id_col, "role_cluster"] + ([value] if attrs is None else [])
        m = lexicon_match(src, text, lexicon, keep=keep, min_len=min_len, mode=mode, attrs=attrs, on=id_col)
    else:
        m = lexicon_match(postings, text, lexicon, keep=[id_col], min_len=min_len, mode=mode, attrs=attrs, on=id_col)
        m = m.withColumn("role_cluster", role).where(F.col("role_cluster") != F.lit(other))
    g = lexicon_demand(m, ["role_cluster", "skill"], id_col, value, avg_name=None, senior_name=None,
                       min_count=min_count, min_inclusive=True, rank_name="role_rank",
                       rank_within=["role_cluster"])
    return g.select("role_cluster", "skill", "job_count", "median_salary", "role_rank")


def topic_skill_cooccurrence(postings: DataFrame, id_col: str = "job_id", text: str = "description",
                             title: str = "job_title", value: str = "annual_salary_est",
                             lexicon: Sequence[str] = tx.LEXICON_TOPIC, text_regex: str = tx.TOPIC_TEXT_REGEX,
                             title_regex: str = tx.TOPIC_TITLE_REGEX, min_count: int = 3, min_len: int = 100,
                             mode: str = "substring", attrs: DataFrame | None = None, hits: DataFrame | None = None) -> DataFrame:
    """Skill, ai_job_count, median_salary, pct_of_ai_jobs, skill_rank."""
    return topic_cooccurrence(postings, id_col, text, value, lexicon, text_regex, title, title_regex,
                              min_len=min_len, min_count=min_count, attrs=attrs, mode=mode, hits=hits)


def posting_hits(postings: DataFrame, id_col: str = "job_id", text: str = "description", title: str = "job_title",
                 value: str = "annual_salary_est", level: str = "experience_level") -> DataFrame:
    """The words of the three shipped lexicons in each posting, in one pass over the texts; input of M9-M11."""
    return text_hits(postings, id_col, text, [tx.LEXICON_DEMAND, tx.LEXICON_BY_ROLE, tx.LEXICON_TOPIC], tx.TOPIC_TEXT_REGEX, [title, value, level])
