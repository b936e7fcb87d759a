"""Sinks: full refresh, same-day replace, seen-set store, view/table
materialisation (A3, A13, A14, A16); a table under a shared folder also serves repeated reads (A17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import strip_ws


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Full-refresh write as Parquet (A3)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` as an external table bucketed and sorted by ``key`` at ``path``.

    Two tables bucketed the same way on their join key join without a shuffle
    (each bucket pair meets in one task), so a large fact table written once
    this way saves a full shuffle on every later join by that key.
    """
    spark = df.sparkSession
    (df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def replace_day(df: DataFrame, path: str, fetched_col: str = "FETCHED_AT", part_col: str = "fetch_date") -> bool:
    """Idempotent same-day load: the days present in ``df`` are replaced, other days stay.

    The table is partitioned by the fetch day and written with dynamic partition overwrite (an option of this write), so
    a reload only rewrites its own days and an empty batch rewrites nothing. Returns whether there were rows, counted
    while they were written.
    """
    rows = Observation()
    staged = df.withColumn(part_col, F.left(F.col(fetched_col).cast("string"), F.lit(10))).observe(rows, F.count(F.lit(1)).alias("n"))
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)
    return rows.get["n"] > 0


def load_seen(spark: SparkSession, path: str, key: str = "url") -> DataFrame:
    """Seen keys: trimmed, blanks dropped; empty when the store does not exist."""
    from .readers import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{key} string")
    s = spark.read.parquet(path).select(strip_ws(key).alias(key))
    return s.where(F.col(key).isNotNull() & (F.col(key) != "")).distinct()


def next_seen(seen: DataFrame, new_keys: DataFrame, key: str = "url") -> DataFrame:
    """The next seen set: old ∪ new keys, whitespace-stripped, blanks dropped, distinct."""
    allk = seen.select(strip_ws(key).alias(key)).unionByName(new_keys.select(strip_ws(key).alias(key)))
    return allk.where(F.col(key).isNotNull() & (F.col(key) != "")).distinct()


def save_seen(new_keys: DataFrame, path: str, key: str = "url") -> None:
    """Append the keys that the store at ``path`` doesn't hold yet (A14); a repeated append is harmless, as readers take distinct keys."""
    spark = new_keys.sparkSession
    fresh = next_seen(spark.createDataFrame([], f"{key} string"), new_keys, key)
    fresh.join(load_seen(spark, path, key), key, "left_anti").write.mode("append").parquet(path)


def materialize(spark: SparkSession, name: str, df: DataFrame, kind: str = "view", root: str | None = None) -> DataFrame:
    """``view``: a temp view recomputed per reader; ``table``: written once as Parquet
    under ``root`` and read back, cutting the lineage (A16)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        if not root:
            raise ValueError("table materialisation needs a root folder")
        path = f"{root.rstrip('/')}/{name}"
        write_table(df, path)
        out = spark.read.parquet(path)
        out.createOrReplaceTempView(name)
        return out
    raise ValueError(f"unknown materialisation {kind!r}")

