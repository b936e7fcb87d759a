"""Report frames over the marts.

Marts are small (one row per role / state / skill / month), so these are
cheap; global figures such as "max of the column" come from a window over the
aggregated frame or a one-row aggregate, never a driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import (count_label, date_of_text, money_full, money_k, month_label, pct_label, pct_of_max,
                              ratio_pct, title_case, zero_if_null)


def kpi_remote(postings: DataFrame, flag: str = "remote_allowed", loaded: str = "_loaded_at",
               remote_values: Sequence[str] = ("1", "hybrid"), hybrid_values: Sequence[str] = ("hybrid",)) -> DataFrame:
    """Remote / hybrid counts and shares, last load date (one row; empty input → NULL shares)."""
    g = postings.agg(
        F.count_if(F.col(flag).isin(list(remote_values))).alias("remote_count"),
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col(flag).isin(list(hybrid_values))).alias("hybrid_count"),
        F.max(date_of_text(loaded)).alias("last_fetch_date"))
    return g.select("remote_count", "total_count", ratio_pct("remote_count", "total_count", 1).alias("remote_pct"),
                    "hybrid_count", ratio_pct("hybrid_count", "total_count", 1).alias("hybrid_pct"),
                    "last_fetch_date")


def kpi_coverage(postings: DataFrame, value: str = "annual_salary_est") -> DataFrame:
    """Rows with a value, all rows, coverage in whole percent."""
    g = postings.agg(F.count_if(F.col(value).isNotNull()).alias("with_salary"), F.count(F.lit(1)).alias("total"))
    return g.select("with_salary", "total", ratio_pct("with_salary", "total", 0).alias("salary_coverage_pct"))


def kpi_headline(roles: DataFrame, role: str = "role_cluster", count: str = "posting_count",
                 median: str = "median_salary") -> DataFrame:
    """Total postings, median of role medians (truncated), top role by volume,
    top-paying role and its median. Ties go to the alphabetically first role."""
    return roles.agg(
        F.sum(count).cast("long").alias("total_postings"),
        F.median(median).cast("long").alias("median_of_medians"),
        F.min_by(F.col(role), F.struct((-F.col(count)).alias("k"), F.col(role).alias("r"))).alias("top_role"),
        F.min_by(F.col(role), F.struct((-F.col(median)).alias("k"), F.col(role).alias("r"))).alias("top_pay_role"),
        F.max(median).cast("long").alias("top_pay_salary"))


def role_filtered(frame: DataFrame, role: str | None, role_col: str = "role_cluster") -> DataFrame:
    """The frame for one role, or all of it when ``role`` is None."""
    return frame if role is None else frame.where(F.col(role_col) == F.lit(role))


def active_skills(skills: DataFrame, skills_by_role: DataFrame, role: str | None,
                  role_col: str = "role_cluster") -> DataFrame:
    """Per-role skills (role_rank renamed demand_rank) when a role is chosen, else global."""
    if role is None:
        return skills
    return (skills_by_role.where(F.col(role_col) == F.lit(role)).withColumnRenamed("role_rank", "demand_rank"))


def top_states(geo: DataFrame, measure: str = "job_count", k: int = 10, state: str = "state_code",
               median: str = "median_salary") -> DataFrame:
    """Top-k states by a chosen measure, with display labels (k is the report size)."""
    return (geo.select(F.col(state), F.col(measure).alias("jobs"), F.col(median),
                       count_label(measure).alias("jobs_label"), money_k(median).alias("salary_label"))
            .orderBy(F.col("jobs").desc(), F.col(state)).limit(k))


def state_pay(geo: DataFrame, k: int = 20, state: str = "state_code", median: str = "median_salary",
              count: str = "job_count") -> DataFrame:
    """Top-k states by median pay among those with pay > 0."""
    return (geo.where(F.col(median) > 0).select(state, median, count)
            .orderBy(F.col(median).desc(), F.col(state)).limit(k))


def seniority_breakdown(role_sen: DataFrame, role: str, role_col: str = "role_cluster") -> DataFrame:
    """One role's seniority rows with a money label, in category order (sort_order, H4)."""
    return (role_sen.where(F.col(role_col) == F.lit(role))
            .select("seniority", "sort_order", "posting_count", "median_salary",
                    money_k("median_salary", "").alias("salary_label"))
            .orderBy("sort_order"))


def distinct_labels(frame: DataFrame, col: str = "role_cluster") -> DataFrame:
    """The sorted distinct non-NULL values of a column (e.g. the role picker)."""
    return frame.select(col).dropna().distinct().orderBy(col)


def pay_range(roles: DataFrame, role: str = "role_cluster") -> DataFrame:
    """Five-number box per role (NULL → 0) and the p10→p90 width, positive only."""
    lo, hi = zero_if_null("p10_salary"), zero_if_null("p90_salary")
    return roles.select(
        F.col(role), lo.alias("lower_fence"), zero_if_null("p25_salary").alias("q1"),
        zero_if_null("median_salary").alias("median"), zero_if_null("p75_salary").alias("q3"),
        hi.alias("upper_fence"), (hi - lo).alias("range_width")).where(F.col("range_width") > 0)


def tier_labels(tiers: DataFrame) -> DataFrame:
    """Tier table with '$123k', 'P25 $Xk — P75 $Yk', '$123,456' and '1,234' labels."""
    return tiers.select(
        "company_tier", "sort_order", "job_count", "median_salary",
        money_k("median_salary").alias("salary_fmt"),
        F.concat(F.lit("P25 "), money_k("p25_salary"), F.lit(" — P75 "), money_k("p75_salary")).alias("range_fmt"),
        money_full("median_salary").alias("median_fmt"), count_label("job_count").alias("jobs_fmt"))


def skill_chips(active: DataFrame, k: int = 20, skill: str = "skill", count: str = "job_count",
                rank: str = "demand_rank", median: str = "median_salary") -> DataFrame:
    """Top-k skills with % of the largest count (over all skills, truncated) and labels."""
    # the skill frame is an aggregate (one row per skill): a global window over it is cheap
    with_max = active.withColumn("_max", F.max(count).over(Window.partitionBy()))
    top = with_max.orderBy(F.col(rank), F.col(skill)).limit(k)
    return top.select(
        F.col(rank).cast("long").alias(rank), title_case(skill).alias("skill_label"), F.col(count),
        pct_of_max(count, "_max").alias("pct_of_max"), money_k(median).alias("salary_label"))


def topic_top(cooc: DataFrame, k: int = 20) -> DataFrame:
    """Top-k co-occurring skills with title-cased names and '%' labels."""
    return (cooc.orderBy(F.col("skill_rank"), F.col("skill")).limit(k)
            .select("skill_rank", title_case("skill").alias("skill_label"), "ai_job_count", "pct_of_ai_jobs",
                    pct_label("pct_of_ai_jobs").alias("pct_fmt"), money_k("median_salary").alias("salary_label")))


def freshness(trends: DataFrame, loads: DataFrame, ts: str, month: str = "month") -> DataFrame:
    """Last month label ('yyyy-MM'), last load date, record count (one row)."""
    m = trends.agg(F.max(month).alias("_m"), F.lit(None).cast("date").alias("_d"),
                   F.lit(None).cast("long").alias("_n"))
    l = loads.agg(F.lit(None).cast("date").alias("_m"), F.to_date(F.max(ts)).alias("_d"),
                  F.count(F.lit(1)).alias("_n"))
    both = m.unionByName(l).agg(F.max("_m").alias("_m"), F.max("_d").alias("_d"), F.max("_n").alias("_n"))
    return both.select(month_label("_m").alias("last_month"), F.col("_d").alias("last_fetch_date"),
                       F.col("_n").alias("record_count"))


def role_seniority(role_sen: DataFrame, levels: Sequence[str] | None = None) -> DataFrame:
    """Role × seniority rows for the chosen levels; none chosen → all."""
    return role_sen if not levels else role_sen.where(F.col("seniority").isin(list(levels)))


def skill_table(active: DataFrame, skill: str = "skill", count: str = "job_count", rank: str = "demand_rank",
                median: str = "median_salary") -> DataFrame:
    """Rank table with display labels and the bar-chart flag (median > 0)."""
    return active.select(
        F.col(rank).cast("long").alias(rank), title_case(skill).alias("skill_label"), F.col(count),
        count_label(count).alias("jobs_label"), money_full(median).alias("median_label"),
        money_k(median).alias("salary_k"), (F.coalesce(F.col(median), F.lit(0.0)) > 0).alias("in_bars"))
