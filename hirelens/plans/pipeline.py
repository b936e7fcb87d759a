"""Raw feeds → staging → marts → checks, as one plain function.

``stg_all`` is read by every posting mart and its de-duplication shuffles, so
it is written once as a table (under ``out_root``, a shared folder on a
cluster) and the marts read it back: the dedup runs once, and a lost executor
never has to recompute it from the raw feeds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions import taxonomy as tx
from ..operators.quality import check_suite
from ..sources.sinks import materialize, write_bucketed, write_table
from . import marts, staging


def build_staging(raw: Mapping[str, DataFrame], loaded_at=None) -> dict[str, DataFrame]:
    """Staging frames (lazy) from raw tables keyed by their landed names."""
    out = {}
    if {"ADZUNA_POSTINGS", "JSEARCH_POSTINGS", "PORTAL_POSTINGS"} <= set(raw):
        out["stg_all_postings"] = staging.stg_all(raw["ADZUNA_POSTINGS"], raw["JSEARCH_POSTINGS"],
                                                  raw["PORTAL_POSTINGS"])
    if "JOB_POSTINGS" in raw:
        out["stg_job_postings"] = staging.stg_job_postings(raw["JOB_POSTINGS"], loaded_at)
    if "JOB_SKILLS" in raw:
        out["stg_job_skills"] = staging.stg_job_skills(raw["JOB_SKILLS"], loaded_at)
    if "COMPANIES" in raw:
        out["stg_companies"] = staging.stg_companies(raw["COMPANIES"], loaded_at)
    return out


def build_marts(postings: DataFrame, skills: DataFrame | None = None, hits: DataFrame | None = None) -> dict[str, DataFrame]:
    """All marts over the de-duplicated postings (and the archive skill tags).

    ``hits`` holds the postings' words (``marts.posting_hits``, best written once): the lexicon marts then read no text.
    """
    out = {
        "mart_hiring_trends": marts.hiring_trends(postings),
        "mart_jobs_by_location": marts.jobs_by_location(postings),
        "mart_remote_trend": marts.remote_trend(postings),
        "mart_salary_by_company_tier": marts.salary_by_company_tier(postings),
        "mart_salary_by_role": marts.salary_by_role(postings),
        "mart_salary_by_role_seniority": marts.salary_by_role_seniority(postings),
        "mart_salary_by_seniority": marts.salary_by_seniority(postings),
        "mart_tech_skills": marts.tech_skills(postings, hits=hits),
        "mart_tech_skills_by_role": marts.tech_skills_by_role(postings, hits=hits),
        "mart_ai_skill_cooccurrence": marts.topic_skill_cooccurrence(postings, hits=hits),
    }
    if skills is not None:
        out["mart_skill_demand"] = marts.skill_demand(skills, postings)
    return out


def run_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame], out_root: str, loaded_at=None,
                 checks=tx.DECLARED_CHECKS, gate: bool = False, buckets: int | None = None) -> DataFrame:
    """Build everything under ``out_root``; return the check results.

    Staging views stay lazy except ``stg_all_postings`` (materialised once).
    The three lexicon marts share one pass over the texts (``posting_hits``).
    With ``buckets``, the postings and the skill tags are stored bucketed by
    ``job_id`` so the tag mart's join runs without a shuffle. Each mart is
    written as a Parquet table. With ``gate=True`` a failed check raises after
    the build, like the post-build test step.
    """
    stg = build_staging(raw, loaded_at)
    tables: dict[str, DataFrame] = {}
    root = out_root.rstrip("/")
    for name, df in stg.items():
        if buckets and name in ("stg_all_postings", "stg_job_skills"):
            tables[name] = write_bucketed(df, name, f"{root}/{name}", "job_id", buckets)
            continue
        kind = "table" if name == "stg_all_postings" else "view"
        tables[name] = materialize(spark, name, df, kind=kind, root=out_root)
    postings = tables.get("stg_all_postings")
    if postings is not None:
        hits = materialize(spark, "posting_hits", marts.posting_hits(postings), kind="table", root=out_root)
        for name, df in build_marts(postings, tables.get("stg_job_skills"), hits).items():
            write_table(df, f"{out_root.rstrip('/')}/{name}")
            tables[name] = spark.read.parquet(f"{out_root.rstrip('/')}/{name}")
    runnable = [c for c in checks if c[0] in tables]
    results = check_suite(tables, runnable)
    if gate:
        from ..operators.quality import gate as _gate
        _gate(results)
    return results
