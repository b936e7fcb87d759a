"""Regional roll-up with a fixed pivot of role counts (M2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import is_region_code, normalize_state
from ..functions import taxonomy as tx
from .stats import distinct_with_stats


def geo_rollup(df: DataFrame, state_col: str, id_col: str, value_col: str, role_col: str,
               pivots: Sequence[tuple[str, str]] = tx.LOCATION_PIVOTS,
               names: Mapping[str, str] = tx.US_STATES, exclude: Sequence[str] = ("US",),
               min_count: int = 3) -> DataFrame:
    """Per normalised region code: distinct ids, median / avg value, role counts.

    Pivot columns are conditional counts with a fixed schema (not ``pivot``,
    which would need a pass to discover values and yields a data-dependent
    schema). Groups need ``job_count >= min_count``.
    """
    code = normalize_state(state_col, names)
    src = df.where(F.col(state_col).isNotNull()).select(
        F.col(id_col), F.col(value_col), F.col(role_col), code.alias("state_code"))
    src = src.where(is_region_code("state_code", exclude))
    return distinct_with_stats(
        src, ["state_code"], id_col, value_col, count_name="job_count", avg_name="avg_salary",
        quantiles={"median_salary": 0.5},
        counts={name: F.col(role_col) == F.lit(label) for label, name in pivots},
    ).select("state_code", "job_count", "median_salary", "avg_salary", *[n for _, n in pivots]).where(
        F.col("job_count") >= min_count)
