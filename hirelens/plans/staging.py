"""Staging models (L1–L7): typed, cleaned, classified postings.

Classifiers read the raw (untrimmed) text, as the models do; output text
columns are trimmed. ``loaded_at`` is a parameter so results are reproducible
(defaults to ``current_timestamp()``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy as tx
from ..functions.classify import (annualize, experience_level, remote_from_flag, remote_from_flag_or_location,
                                  remote_from_text, work_type)
from ..functions.expr import clean_upper, epoch_or_timestamp, safe_timestamp, to_double, to_int, to_str, typed_null
from ..operators.dedupe import dedupe_postings
from ..sources.schemas import POSTING


def _loaded(loaded_at) -> Column:
    return F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")


def _feed(raw: DataFrame, source: Column, remote: Column, work: Column, salaries: bool) -> DataFrame:
    sal = (lambda c: to_double(c)) if salaries else (lambda c: typed_null("double"))
    out = raw.where(F.col("JOB_ID").isNotNull() & F.col("TITLE").isNotNull()).select(
        to_str("JOB_ID").alias("job_id"),
        F.trim("COMPANY").alias("company_name"),
        F.trim("TITLE").alias("job_title"),
        F.trim("DESCRIPTION").alias("description"),
        F.trim("LOCATION").alias("location"),
        F.trim("STATE").alias("state_code"),
        sal("SALARY_MIN").alias("min_salary"),
        sal("SALARY_MAX").alias("max_salary"),
        sal("SALARY_EST").alias("med_salary"),
        F.lit("YEARLY").alias("pay_period"),
        work.alias("work_type"),
        remote.alias("remote_allowed"),
        typed_null("int").alias("views"),
        typed_null("int").alias("applies"),
        experience_level("TITLE").alias("experience_level"),
        safe_timestamp("POSTED_AT").alias("listed_at"),
        typed_null("timestamp").alias("expires_at"),
        sal("SALARY_EST").alias("annual_salary_est"),
        F.col("QUERY").cast("string").alias("search_query"),
        source.alias("source"),
        safe_timestamp("FETCHED_AT").alias("_loaded_at"),
    )
    return out


def stg_adzuna(raw: DataFrame) -> DataFrame:
    """L1: feed 1; remote from location and description text."""
    return _feed(raw, F.lit("adzuna"), remote_from_text("LOCATION", "DESCRIPTION"),
                 work_type("DESCRIPTION"), salaries=True)


def stg_jsearch(raw: DataFrame) -> DataFrame:
    """L2: feed 2; remote flag as landed, '0' when missing."""
    return _feed(raw, F.lit("jsearch"), remote_from_flag("REMOTE"), work_type("DESCRIPTION"), salaries=True)


def stg_portal(raw: DataFrame) -> DataFrame:
    """L3: board feeds; no pay; source taken from the data."""
    return _feed(raw, F.col("SOURCE").cast("string"), remote_from_flag_or_location("REMOTE", "LOCATION"),
                 work_type("DESCRIPTION", tx.WORK_TYPE_RULES_PORTAL), salaries=False)


def conform(df: DataFrame, schema=POSTING) -> DataFrame:
    """Align a frame to a schema by name: cast present columns, typed NULLs for missing ones."""
    cols = []
    for f in schema.fields:
        cols.append((F.col(f.name).cast(f.dataType) if f.name in df.columns else typed_null(f.dataType)).alias(f.name))
    return df.select(*cols)


def union_feeds(*frames: DataFrame, schema=POSTING) -> DataFrame:
    """UNION ALL by name after conforming each frame."""
    out = None
    for f in frames:
        c = conform(f, schema)
        out = c if out is None else out.unionByName(c)
    return out


def stg_all(adzuna: DataFrame, jsearch: DataFrame, portal: DataFrame, stored: tuple[str, str] | None = None, buckets: int = 64) -> DataFrame:
    """L4: the three live feeds, de-duplicated by employer + title + day.

    With ``stored`` (table name, shared folder) the union is written once and no description is shuffled after that.
    """
    return dedupe_postings(union_feeds(stg_adzuna(adzuna), stg_jsearch(jsearch), stg_portal(portal)), stored=stored, buckets=buckets)


def stg_job_postings(raw: DataFrame, loaded_at=None, factors=tx.PAY_FACTORS_ARCHIVE) -> DataFrame:
    """Archive postings. Epoch-millisecond text timestamps are decoded;
    pay is annualised from the cleaned period (HOURLY ×2080, MONTHLY ×12)."""
    src = raw.where(F.col("JOB_ID").isNotNull() & F.col("TITLE").isNotNull())
    period = clean_upper("PAY_PERIOD")
    med = to_double("MED_SALARY")
    return src.select(
        to_str("JOB_ID").alias("job_id"),
        F.trim("COMPANY_NAME").alias("company_name"),
        F.trim("TITLE").alias("job_title"),
        F.trim("DESCRIPTION").alias("description"),
        F.trim("LOCATION").alias("location"),
        to_double("MIN_SALARY").alias("min_salary"),
        to_double("MAX_SALARY").alias("max_salary"),
        med.alias("med_salary"),
        period.alias("pay_period"),
        clean_upper("FORMATTED_WORK_TYPE").alias("work_type"),
        clean_upper("REMOTE_ALLOWED").alias("remote_allowed"),
        to_int(to_double("VIEWS")).alias("views"),
        to_int(to_double("APPLIES")).alias("applies"),
        to_str("FORMATTED_EXPERIENCE_LEVEL").alias("experience_level"),
        epoch_or_timestamp("ORIGINAL_LISTED_TIME").alias("listed_at"),
        epoch_or_timestamp("EXPIRY").alias("expires_at"),
        annualize(med, period, factors).alias("annual_salary_est"),
        _loaded(loaded_at).alias("_loaded_at"),
    )


def stg_job_skills(raw: DataFrame, loaded_at=None) -> DataFrame:
    """One row per (job, lower-cased skill tag)."""
    src = raw.where(F.col("JOB_ID").isNotNull() & F.col("SKILL_ABR").isNotNull())
    return src.select(to_str("JOB_ID").alias("job_id"), F.lower(F.trim("SKILL_ABR")).alias("skill_id"),
                      _loaded(loaded_at).alias("_loaded_at"))


def stg_companies(raw: DataFrame, loaded_at=None) -> DataFrame:
    """Company metadata, trimmed."""
    src = raw.where(F.col("COMPANY_ID").isNotNull())
    return src.select(
        to_str("COMPANY_ID").alias("company_id"), F.trim("NAME").alias("company_name"),
        F.trim("DESCRIPTION").alias("company_description"), F.trim("COMPANY_SIZE").alias("company_size"),
        F.trim("STATE").alias("state"), F.trim("COUNTRY").alias("country"), F.trim("CITY").alias("city"),
        F.trim("URL").alias("website_url"), _loaded(loaded_at).alias("_loaded_at"))
