"""Load of a live feed from landed files to its day-partitioned table.

Batch and stream share these functions, so both end in the same table: flatten, keep the first seen row of each job and
day, replace the days that arrived.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flatten as fl
from .sinks import replace_day

_FLATTEN: dict[str, Callable[..., DataFrame]] = {"adzuna": fl.flatten_adzuna, "jsearch": fl.flatten_jsearch,
                                                  "greenhouse": fl.flatten_greenhouse, "ashby": fl.flatten_ashby}


def label_files(landed: DataFrame, asked: Sequence[str], label: str = "query") -> DataFrame:
    """Query (or company), page and the order of asking, from paths like ``…/query=data engineer/page=2.json``.

    ``asked`` lists the queries in the order in which they were asked; a label that isn't listed comes last.
    """
    path = F.url_decode(F.regexp_replace("_file", r"\+", "%2B"))
    name = F.regexp_extract(path, rf"/{label}=([^/]+?)(/|\.json$)", 1)
    place = F.array_position(F.array(*[F.lit(a) for a in asked]).cast("array<string>"), name).cast("int")
    return (landed.withColumn(label, name)
            .withColumn("page", F.regexp_extract(path, r"/page=(\d+)", 1).try_cast("int"))
            .withColumn(f"{label}_order", F.nullif(place, F.lit(0))))


def flat_feed(labelled: DataFrame, kind: str) -> DataFrame:
    """Rows of a feed with their fetch time (the file's modification time) and order columns."""
    return _FLATTEN[kind](labelled, fetched_at=F.date_format(F.col("_fetched"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def load_flat(flat: DataFrame, sink_dir: str) -> bool:
    """First seen row of each job and day into the table at ``sink_dir``, whose days in ``flat`` are replaced."""
    day = F.left(F.col("FETCHED_AT"), F.lit(10))
    return replace_day(fl.distinct_jobs(flat.withColumn("fetch_date", day), ("JOB_ID", "fetch_date")), sink_dir)


def load_feed(landed: DataFrame, kind: str, asked: Sequence[str], sink_dir: str) -> bool:
    """Landed responses (``flatten.read_payloads``) to the feed's table; returns whether there were rows."""
    label = "query" if kind in ("adzuna", "jsearch") else "company"
    return load_flat(flat_feed(label_files(landed, asked, label), kind), sink_dir)
