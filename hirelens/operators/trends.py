"""Time-bucketed counts and shares (M1, M3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import month_start, ratio_pct


def monthly_counts(df: DataFrame, ts: str, keys: Sequence[str | Column], id_col: str,
                   count_name: str = "posting_count", month_name: str = "month") -> DataFrame:
    """count(id) per (month, keys); rows without a timestamp are dropped."""
    src = df.where(F.col(ts).isNotNull())
    return (src.groupBy(month_start(ts).alias(month_name), *keys)
            .agg(F.count(F.col(id_col)).alias(count_name)))


def share_trend(df: DataFrame, ts: str, flag: str,
                buckets: Sequence[tuple[str, Sequence[str] | None]],
                total_name: str = "total", month_name: str = "month") -> DataFrame:
    """Per month: total rows, one count per bucket and its share in % (M3).

    ``buckets`` is ``[(name, values)]``; ``values=None`` counts NULL flags.
    Output columns: month, total, <name>_count..., <name>_pct... .
    """
    src = df.where(F.col(ts).isNotNull())
    aggs = [F.count(F.lit(1)).alias(total_name)]
    for name, values in buckets:
        cond = F.col(flag).isNull() if values is None else F.col(flag).isin(list(values))
        aggs.append(F.count_if(cond).alias(f"{name}_count"))
    g = src.groupBy(month_start(ts).alias(month_name)).agg(*aggs)
    return g.select(month_name, total_name, *[f"{n}_count" for n, _ in buckets],
                    *[ratio_pct(f"{n}_count", total_name, 1).alias(f"{n}_pct") for n, _ in buckets])
