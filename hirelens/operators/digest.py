"""New-item digest: unseen, title-filtered items with per-company counts and run totals.

Rows stay rows: the digest is one row per new item carrying its company's
item count, and one row of run totals — no per-company list is collected, so a
company holding a third of all items stays dealt over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy as tx
from ..functions.classify import keyword_filter
from .dedupe import unseen


def new_items(candidates: DataFrame, seen: DataFrame, url: str = "url", title: str = "title",
              order: Sequence[str] = ("company_order", "position"), include=tx.TITLE_INCLUDE,
              exclude=tx.TITLE_EXCLUDE, seen_key: str | None = None) -> DataFrame:
    """Candidates whose (cleaned) title passes the filter and whose URL is new (E5).

    The title filter runs before the seen test, so a URL whose title failed
    is not marked; within the run, the first (company order, position) wins.
    """
    ok = candidates.where(keyword_filter(title, include, exclude))
    return unseen(ok, seen, url, [F.col(o) for o in order], seen_key=seen_key)


def digest(items: DataFrame, company: str = "company") -> DataFrame:
    """Per item: company_items (N14); items without a company count as one company.

    Per-company counts are a grouped count (map-side combined, so a hot company is pre-aggregated), joined back.
    """
    per = items.groupBy(F.col(company).alias("_company")).agg(F.count(F.lit(1)).alias("company_items"))
    return items.join(per, F.col(company).eqNullSafe(F.col("_company"))).drop("_company")


def digest_totals(items: DataFrame, company: str = "company") -> DataFrame:
    """One row: total_items and total_companies."""
    per = items.groupBy(company).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_items"), F.count(F.lit(1)).alias("total_companies"))
