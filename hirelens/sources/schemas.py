"""Declared schemas: raw feed tables, landed JSON payloads, canonical posting."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B, TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw feed tables as landed (all text except the salary floats).
ADZUNA = struct(("JOB_ID", S), ("TITLE", S), ("COMPANY", S), ("DESCRIPTION", S), ("LOCATION", S), ("STATE", S),
                ("CITY", S), ("SALARY_MIN", D), ("SALARY_MAX", D), ("SALARY_EST", D), ("REMOTE", S),
                ("CATEGORY", S), ("URL", S), ("POSTED_AT", S), ("QUERY", S), ("FETCHED_AT", S), ("SOURCE", S))
JSEARCH = ADZUNA
PORTAL = struct(("JOB_ID", S), ("TITLE", S), ("COMPANY", S), ("DESCRIPTION", S), ("LOCATION", S), ("STATE", S),
                ("SALARY_MIN", D), ("SALARY_MAX", D), ("SALARY_EST", D), ("REMOTE", S), ("URL", S),
                ("POSTED_AT", S), ("SOURCE", S), ("FETCHED_AT", S), ("QUERY", S))

# Archive CSVs (columns read by the staging models; types inferred or text).
JOB_POSTINGS = struct(("JOB_ID", S), ("COMPANY_NAME", S), ("TITLE", S), ("DESCRIPTION", S), ("LOCATION", S),
                      ("MIN_SALARY", S), ("MAX_SALARY", S), ("MED_SALARY", S), ("PAY_PERIOD", S),
                      ("FORMATTED_WORK_TYPE", S), ("REMOTE_ALLOWED", S), ("VIEWS", S), ("APPLIES", S),
                      ("FORMATTED_EXPERIENCE_LEVEL", S), ("ORIGINAL_LISTED_TIME", S), ("EXPIRY", S))
JOB_SKILLS = struct(("JOB_ID", S), ("SKILL_ABR", S))
COMPANIES = struct(("COMPANY_ID", S), ("NAME", S), ("DESCRIPTION", S), ("COMPANY_SIZE", S), ("STATE", S),
                   ("COUNTRY", S), ("CITY", S), ("URL", S))

# Landed JSON payloads (one API response per file).
ADZUNA_PAYLOAD = struct(("results", T.ArrayType(struct(
    ("id", S), ("title", S), ("company", struct(("display_name", S))), ("description", S),
    ("location", struct(("display_name", S), ("area", T.ArrayType(S)))),
    ("salary_min", D), ("salary_max", D), ("category", struct(("label", S))),
    ("redirect_url", S), ("created", S)))))
JSEARCH_PAYLOAD = struct(("data", T.ArrayType(struct(
    ("job_id", S), ("job_title", S), ("employer_name", S), ("job_description", S), ("job_city", S),
    ("job_state", S), ("job_min_salary", D), ("job_max_salary", D), ("job_salary_period", S),
    ("job_is_remote", B), ("job_required_experience", struct(("required_experience_in_months", I))),
    ("job_apply_link", S), ("job_google_link", S), ("job_posted_at_datetime_utc", S)))))
GREENHOUSE_PAYLOAD = struct(("jobs", T.ArrayType(struct(
    ("id", L), ("title", S), ("location", struct(("name", S))), ("absolute_url", S), ("updated_at", S)))))
ASHBY_PAYLOAD = struct(("jobPostings", T.ArrayType(struct(
    ("id", S), ("title", S), ("descriptionPlain", S), ("location", S), ("isRemote", B), ("jobUrl", S),
    ("publishedAt", S)))))
SEARCH_PAYLOAD = struct(("organic", T.ArrayType(struct(("title", S), ("link", S)))))

# Canonical posting (output of cleaning, input of the marts), 21 columns.
POSTING = struct(("job_id", S), ("company_name", S), ("job_title", S), ("description", S), ("location", S),
                 ("state_code", S), ("min_salary", D), ("max_salary", D), ("med_salary", D), ("pay_period", S),
                 ("work_type", S), ("remote_allowed", S), ("views", I), ("applies", I),
                 ("experience_level", S), ("listed_at", TS), ("expires_at", TS), ("annual_salary_est", D),
                 ("search_query", S), ("source", S), ("_loaded_at", TS))
