"""Keep-first de-duplication and anti-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ColumnOrName, col, strip_ws


def keep_first(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column],
               digest_keys: bool = False) -> DataFrame:
    """One row per key: the first by ``order`` (which must be total to be deterministic).

    ``row_number() = 1`` is planned as a WindowGroupLimit: a partial limit runs
    map-side before the shuffle, so each task ships at most one row per key —
    a hot key (a third of all rows) does not pile up in one reducer.
    NULL keys group together, as in SQL PARTITION BY.

    ``digest_keys`` replaces each key by its SHA-256 digest (NULL stays NULL)
    for grouping: when a key is a whole text, the shuffle then carries 32 bytes
    instead of the text. Distinct keys collide only with SHA-256 collision
    probability.
    """
    key_cols = [col(k) for k in keys]
    if digest_keys:
        key_cols = [F.sha2(k.cast("string"), 256) for k in key_cols]
    w = Window.partitionBy(*key_cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_first_stored(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column], narrow: Sequence[str], name: str, path: str,
                      buckets: int = 64, digest_keys: bool = False) -> DataFrame:
    """``keep_first`` without a shuffle of whole rows: what is ranked are narrow rows, and texts stay in their task.

    ``df`` is written once, as the external table ``name`` at ``path``, a bucket file a task, with each row's task and place.
    The first rows are found among the ``narrow`` columns (those of ``keys`` and ``order``); their places become bitmaps, one row a task, which join the
    bucketed table where it lies: only they are shuffled. Of rows that are equal in keys and order, one stays.
    """
    spark, taken = df.sparkSession, set(df.columns)
    row, part = next(f"_row{i}" for i in range(99) if f"_row{i}" not in taken), next(f"_part{i}" for i in range(99) if f"_part{i}" not in taken)
    placed = df.withColumn(row, F.monotonically_increasing_id()).withColumn(part, F.shiftright(F.col(row), 33))
    placed.write.mode("overwrite").format("parquet").bucketBy(buckets, part).option("path", path).saveAsTable(name)
    table = spark.table(name)
    first = keep_first(table.select(*narrow, row, part), keys, [*order, F.col(row)], digest_keys)
    bits = (F.col(row).bitwiseAND(F.lit(2**33 - 1)))
    maps = first.select(part, bits.alias("_bit")).groupBy(part, F.expr("cast(_bit div 32768 as int) as block")).agg(
        F.expr("bitmap_construct_agg(_bit % 32768) as map"))
    per_task = maps.groupBy(part).agg(F.expr("map_from_entries(collect_list(struct(block, map))) as _kept"))     # a bit a row of the task
    joined = table.join(per_task.hint("shuffle_hash"), part).withColumn("_bit", bits)
    byte = F.expr("conv(hex(substring(try_element_at(_kept, cast(_bit div 32768 as int)), cast((_bit % 32768) div 8 as int) + 1, 1)), 16, 10)")
    return joined.where(byte.cast("int").bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 as int))")) != 0).select(*df.columns)


def dedupe_postings(df: DataFrame, company: str = "company_name", title: str = "job_title",
                    ts: str | None = "listed_at", value: str = "annual_salary_est", source: str = "source",
                    tie: str = "job_id", digest_keys: bool = False, stored: tuple[str, str] | None = None, buckets: int = 64) -> DataFrame:
    """Same employer + title + day → keep the pay-bearing row, then by source, then id (G1).

    The pipeline's order (pay first, then source) is not total; ``tie`` makes
    it so. ``ts=None`` drops the day from the key. ``stored`` names a table
    and its folder: then whole rows aren't shuffled (``keep_first_stored``).
    """
    keys = [F.lower(F.trim(F.col(company))), F.lower(F.trim(F.col(title)))]
    if ts is not None:
        keys.append(F.to_date(F.col(ts)))
    order = [F.col(value).isNull().asc(), F.col(source).asc_nulls_last(), F.col(tie).asc_nulls_last()]
    if stored:
        narrow = list(dict.fromkeys(c for c in (company, title, ts, value, source, tie) if c))
        return keep_first_stored(df, keys, order, narrow, *stored, buckets, digest_keys)
    return keep_first(df, keys, order, digest_keys)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Distinct by key keeping the first row in a stated order."""
    return keep_first(df, key, [F.col(c).asc_nulls_last() for c in order])


def unseen(df: DataFrame, seen: DataFrame, key: str, order: Sequence[ColumnOrName],
           seen_key: str | None = None) -> DataFrame:
    """Rows whose key is not in ``seen`` and not taken by an earlier row (E5).

    Empty or NULL keys are dropped. Within the run the first occurrence in
    ``order`` wins. The seen set is joined with a left-anti join (shuffle or
    broadcast chosen by AQE from its runtime size).
    """
    k = strip_ws(key)
    src = df.withColumn(key, k).where(F.col(key).isNotNull() & (F.col(key) != ""))
    s = seen.select(strip_ws(seen_key or key).alias(key))
    fresh = src.join(s, key, "left_anti")
    return keep_first(fresh, [key], [col(o) for o in order])
