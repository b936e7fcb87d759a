"""Flatten landed API payloads into raw feed rows.

Each payload file is one API response read with a declared schema
(``spark.read.schema(...).json``); the result arrays are exploded with their
position so that keep-first de-duplication has a total order
(query order, page, position).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import taxonomy as tx
from ..functions.classify import (annualize, clean_title, estimate_mean_or_either, estimate_midpoint_or_zero,
                                  keyword_filter)
from ..functions.expr import strip_chars, strip_ws, typed_null
from ..operators.dedupe import first_per_key
from .schemas import (ADZUNA_PAYLOAD, ASHBY_PAYLOAD, GREENHOUSE_PAYLOAD, JSEARCH_PAYLOAD, SEARCH_PAYLOAD)


def read_payloads(spark: SparkSession, path: str, kind: str, recursive: bool = False) -> DataFrame:
    """Read landed JSON responses (one document per file, multi-line) with their schema.

    Adds ``_file`` (source path), from which ``load.label_files`` takes query / page / company labels and their
    order, and ``_fetched`` (file modification time).
    """
    schema = {"adzuna": ADZUNA_PAYLOAD, "jsearch": JSEARCH_PAYLOAD, "greenhouse": GREENHOUSE_PAYLOAD,
              "ashby": ASHBY_PAYLOAD, "search": SEARCH_PAYLOAD}[kind]
    return (spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", recursive).json(path)
            .withColumn("_file", F.col("_metadata.file_path"))
            .withColumn("_fetched", F.col("_metadata.file_modification_time")))


def _explode(df: DataFrame, field: str, keep: list[str], order_col: str | None = None) -> DataFrame:
    if order_col is not None and order_col not in df.columns:
        raise ValueError(f"the payload needs a column {order_col!r}: the order in which queries or boards were asked")
    present = [k for k in keep + ["_fetched"] if k in df.columns]
    order = [F.col(order_col).alias("_qo")] if order_col else []
    return df.select(*present, *order, F.posexplode_outer(F.col(field)).alias("_pos", "j")).where(F.col("j").isNotNull())


def _lineage(source: str | Column, query: Column | None, fetched_at: str | Column | None) -> list[Column]:
    if fetched_at is None:
        fetched = typed_null("string")
    else:
        fetched = F.lit(fetched_at) if isinstance(fetched_at, str) else fetched_at
    return [
        (query if query is not None else typed_null("string")).alias("QUERY"),
        fetched.alias("FETCHED_AT"),
        (F.lit(source) if isinstance(source, str) else source).alias("SOURCE"),
    ]


def flatten_adzuna(df: DataFrame, fetched_at: str | Column | None = None, query_col: str = "query",
                   order_col: str = "query_order") -> DataFrame:
    """Feed 1 (A7): nested company / location / category; state = area[1] and
    city = area[-1] only when the area has more than one level; estimate =
    (min + max) / 2 with missing = 0 and 0 → NULL."""
    r = _explode(df, "results", [query_col, "page", "_file"], order_col)
    j = F.col("j")
    area = F.coalesce(j["location"]["area"], F.array().cast("array<string>"))
    deep = F.size(area) > 1
    q = F.col(query_col) if query_col in df.columns else None
    return r.select(
        j["id"].alias("JOB_ID"), j["title"].alias("TITLE"), j["company"]["display_name"].alias("COMPANY"),
        j["description"].alias("DESCRIPTION"), j["location"]["display_name"].alias("LOCATION"),
        F.when(deep, F.get(area, 1)).alias("STATE"),
        F.when(deep, F.try_element_at(area, F.lit(-1))).alias("CITY"),
        j["salary_min"].alias("SALARY_MIN"), j["salary_max"].alias("SALARY_MAX"),
        estimate_midpoint_or_zero(j["salary_min"], j["salary_max"]).alias("SALARY_EST"),
        typed_null("string").alias("REMOTE"), j["category"]["label"].alias("CATEGORY"),
        j["redirect_url"].alias("URL"), j["created"].alias("POSTED_AT"),
        *_lineage("adzuna", q, fetched_at), *_order_cols(r))


def flatten_jsearch(df: DataFrame, fetched_at: str | Column | None = None, query_col: str = "query",
                    factors=tx.PAY_FACTORS_FEED, order_col: str = "query_order") -> DataFrame:
    """Feed 2 (A8): annualised salaries (banker's rounding), "city, state" with
    the ', ' characters stripped, remote flag, apply link with a fallback."""
    r = _explode(df, "data", [query_col, "page", "_file"], order_col)
    j = F.col("j")
    period = F.upper(F.coalesce(j["job_salary_period"], F.lit("")))
    lo = annualize(j["job_min_salary"], period, factors, round_half_even=True)
    hi = annualize(j["job_max_salary"], period, factors, round_half_even=True)
    loc = strip_chars(F.concat(F.coalesce(j["job_city"], F.lit("")), F.lit(", "),
                               F.coalesce(j["job_state"], F.lit(""))), ", ")
    link = F.coalesce(F.nullif(j["job_apply_link"], F.lit("")), F.nullif(j["job_google_link"], F.lit("")))
    q = F.col(query_col) if query_col in df.columns else None
    return r.select(
        j["job_id"].alias("JOB_ID"), j["job_title"].alias("TITLE"), j["employer_name"].alias("COMPANY"),
        j["job_description"].alias("DESCRIPTION"), loc.alias("LOCATION"), j["job_state"].alias("STATE"),
        j["job_city"].alias("CITY"), lo.alias("SALARY_MIN"), hi.alias("SALARY_MAX"),
        estimate_mean_or_either(lo, hi).alias("SALARY_EST"),
        F.when(F.coalesce(j["job_is_remote"], F.lit(False)), F.lit("1")).otherwise(F.lit("0")).alias("REMOTE"),
        j["job_required_experience"]["required_experience_in_months"].cast("string").alias("CATEGORY"),
        link.alias("URL"), j["job_posted_at_datetime_utc"].alias("POSTED_AT"),
        *_lineage("jsearch", q, fetched_at), *_order_cols(r))


def _board_location(loc: Column) -> tuple[Column, Column]:
    state = F.when(F.contains(loc, F.lit(", ")), F.split_part(loc, F.lit(", "), F.lit(-1)))
    return loc, state


def flatten_greenhouse(df: DataFrame, company_col: str = "company", fetched_at: str | Column | None = None,
                       include=tx.TITLE_INCLUDE, exclude=tx.TITLE_EXCLUDE, order_col: str = "company_order") -> DataFrame:
    """Board type 1 (A9): id prefix ``gh_``, title filter, state = last ', ' part,
    remote when the location mentions it. No description on this board."""
    r = _explode(df, "jobs", [company_col, "_file"], order_col)
    j = F.col("j")
    r = r.where(keyword_filter(F.coalesce(j["title"], F.lit("")), include, exclude))
    loc, state = _board_location(F.coalesce(j["location"]["name"], F.lit("")))
    return r.select(
        F.concat(F.lit("gh_"), j["id"].cast("string")).alias("JOB_ID"), j["title"].alias("TITLE"),
        F.col(company_col).alias("COMPANY"), typed_null("string").alias("DESCRIPTION"),
        loc.alias("LOCATION"), state.alias("STATE"),
        typed_null("double").alias("SALARY_MIN"), typed_null("double").alias("SALARY_MAX"),
        typed_null("double").alias("SALARY_EST"),
        F.when(F.contains(F.lower(loc), F.lit("remote")), F.lit("1")).otherwise(F.lit("0")).alias("REMOTE"),
        j["absolute_url"].alias("URL"), j["updated_at"].alias("POSTED_AT"),
        *_lineage("greenhouse", F.lit(tx.BOARD_QUERY), fetched_at), *_order_cols(r))


def flatten_ashby(df: DataFrame, company_col: str = "company", fetched_at: str | Column | None = None,
                  include=tx.TITLE_INCLUDE, exclude=tx.TITLE_EXCLUDE, max_desc: int | None = None,
                  order_col: str = "company_order") -> DataFrame:
    """Board type 2 (A10): id prefix ``ashby_``, the whole description (empty → NULL;
    ``max_desc`` cuts it on request), ``isRemote`` flag."""
    r = _explode(df, "jobPostings", [company_col, "_file"], order_col)
    j = F.col("j")
    r = r.where(keyword_filter(F.coalesce(j["title"], F.lit("")), include, exclude))
    loc, state = _board_location(F.coalesce(j["location"], F.lit("")))
    desc = F.nullif(j["descriptionPlain"], F.lit(""))
    desc = desc if max_desc is None else F.substring(desc, 1, max_desc)
    return r.select(
        F.concat(F.lit("ashby_"), j["id"]).alias("JOB_ID"), j["title"].alias("TITLE"),
        F.col(company_col).alias("COMPANY"), desc.alias("DESCRIPTION"), loc.alias("LOCATION"), state.alias("STATE"),
        typed_null("double").alias("SALARY_MIN"), typed_null("double").alias("SALARY_MAX"),
        typed_null("double").alias("SALARY_EST"),
        F.when(F.coalesce(j["isRemote"], F.lit(False)), F.lit("1")).otherwise(F.lit("0")).alias("REMOTE"),
        j["jobUrl"].alias("URL"), j["publishedAt"].alias("POSTED_AT"),
        *_lineage("ashby", F.lit(tx.BOARD_QUERY), fetched_at), *_order_cols(r))


def flatten_search_results(df: DataFrame, company_col: str = "company", order_col: str = "company_order",
                           separators=tx.TITLE_SEPARATORS) -> DataFrame:
    """Search results (A11): company, link (trimmed), cleaned title, position."""
    keep = [company_col] + ([order_col] if order_col in df.columns else [])
    r = _explode(df, "organic", keep)
    j = F.col("j")
    order = F.col(order_col) if order_col in df.columns else F.lit(0)
    return r.select(F.col(company_col).alias("company"), order.alias("company_order"),
                    F.col("_pos").alias("position"),
                    strip_ws(F.coalesce(j["link"], F.lit(""))).alias("url"),
                    clean_title(F.coalesce(j["title"], F.lit("")), separators).alias("title"))


def _order_cols(r: DataFrame) -> list[Column]:
    cols = [F.col("_pos").alias("_pos"), F.col("_qo")]
    cols.append((F.col("page") if "page" in r.columns else F.lit(0)).alias("_page"))
    cols.append((F.col("_file") if "_file" in r.columns else F.lit("")).alias("_file"))
    return cols


def distinct_jobs(df: DataFrame, keys: Sequence[str] = ("JOB_ID",)) -> DataFrame:
    """Distinct by id (or the given keys) keeping the first seen: queries in the order they were asked, then pages, then positions.

    The winners are picked on ids and order columns; the rows with their texts are joined to them afterwards, so no
    description is sorted.
    """
    place = ["_qo", "_page", "_pos", "_file"]
    rows = df.withColumn("_key", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in place]))
    first = first_per_key(rows.select(*keys, "_key", *place), keys, place).select(
        *[F.col(k).alias(f"_first_{k}") for k in keys], F.col("_key").alias("_first"))
    same = F.col("_key") == F.col("_first")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_first_{k}"))
    return rows.join(first, same, "left_semi").drop("_key", *place)


def extract_targets(text_df: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Company → (kind, slug) from a target-list text.

    Every ``- name: X … api: https://…`` block is a target; kind by URL
    substring (greenhouse before ashby; others dropped); slug is the last path
    part, or the one before it when a greenhouse URL ends in ``/jobs``.
    """
    t = F.col(text_col)
    pairs = F.arrays_zip(F.regexp_extract_all(t, F.lit(tx.TARGET_PATTERN), 1).alias("name"),
                         F.regexp_extract_all(t, F.lit(tx.TARGET_PATTERN), 2).alias("api"))
    r = text_df.select(*keep, F.posexplode(pairs).alias("target_order", "p"))
    name, api = F.trim(F.col("p")["name"]), F.trim(F.col("p")["api"])
    base = F.rtrim(api, F.lit("/"))
    gh = F.contains(api, F.lit("greenhouse"))
    ash = F.contains(api, F.lit("ashby"))
    kind = F.when(gh, F.lit("greenhouse")).when(ash, F.lit("ashby"))
    slug = (F.when(gh & F.contains(api, F.lit("/jobs")), F.split_part(base, F.lit("/"), F.lit(-2)))
            .otherwise(F.split_part(base, F.lit("/"), F.lit(-1))))
    out = r.select(*keep, "target_order", name.alias("company"), kind.alias("kind"), slug.alias("slug"))
    return out.where(F.col("kind").isNotNull())


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    """Targets from a text file, else the static fallback list."""
    from .readers import path_exists
    if path_exists(spark, path):
        return extract_targets(spark.read.text(path, wholetext=True))
    rows = [(i, c, k, s) for i, (c, k, s) in enumerate(tx.FALLBACK_TARGETS)]
    return spark.createDataFrame(rows, "target_order int, company string, kind string, slug string")
