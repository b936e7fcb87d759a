"""Tag demand: tags left-joined to facts, per-tag stats and rank (M8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import month_start, ratio_pct
from .stats import distinct_with_stats


def tag_demand(tags: DataFrame, facts: DataFrame, id_col: str = "job_id", tag_col: str = "skill_id",
               ts_col: str = "listed_at", value_col: str = "annual_salary_est",
               type_col: str = "work_type", fulltime_value: str = "FULL_TIME",
               level_col: str = "experience_level", senior_values: Sequence[str] = ("EN", "EX")) -> DataFrame:
    """Per tag: distinct tagged ids, pay stats of the matched facts, counts, rank.

    ``tags ⟕ facts`` on the id is a plain equi-join: Catalyst/AQE choose
    broadcast or sort-merge from runtime sizes, and AQE splits a skewed
    (hot) id partition on the tag side. Unmatched tags keep NULL facts.
    """
    f = facts.select(F.col(id_col).alias("_fid"), ts_col, value_col, type_col, level_col)
    # facts belong to the id: a tag's repeats on one id are counted before the join and weigh the row after it
    pairs = tags.groupBy(id_col, tag_col).agg(F.count(F.lit(1)).alias("_tagged"))
    j = pairs.join(f, F.col(id_col) == F.col("_fid"), "left")
    g = distinct_with_stats(
        j, [tag_col], id_col, value_col, count_name="job_count", avg_name="avg_salary",
        quantiles={"median_salary": 0.5},
        counts={"fulltime_count": F.col(type_col) == F.lit(fulltime_value),
                "senior_count": F.col(level_col).isin(list(senior_values))},
        mins={"_first": ts_col}, weight="_tagged")
    w = Window.orderBy(F.col("job_count").desc())
    return g.select(
        tag_col, "job_count", "avg_salary", "median_salary", "fulltime_count", "senior_count",
        ratio_pct("senior_count", "job_count", 1).alias("senior_pct"),
        month_start("_first").alias("first_seen_month"),
        F.rank().over(w).cast("long").alias("demand_rank"),
    )
