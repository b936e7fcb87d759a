"""Declarative column checks and a suite runner (O1–O3).

A suite reads each table once and shuffles twice, whatever it checks. Every row of a table gives one small row for each
unique-checked value it holds, and one for each NULL in a column that must hold none; blank rows are counted per (check,
value) with map-side combine, so a hot value or a column full of NULLs leaves a task as one row; the counts of a check are
then added up. ``write_checked`` takes the NULL counts of a table while it is being written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("not_null", "unique")


def value_text(c: Column, kind: T.DataType) -> Column:
    """A value as text, different values as different texts and equal ones (0.0 and -0.0, any NaN) as one."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0).cast(kind)).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return c.cast("string")


def _marks(df: DataFrame, checks: Sequence[tuple[int, str, str]]) -> DataFrame:
    """(check, value) for each value to count; NULL values stand for NULLs of a not_null check."""
    types = {f.name: f.dataType for f in df.schema.fields}
    none = F.lit(None).cast("string")
    marks = []
    for i, column, kind in checks:
        c = F.col(f"`{column}`")
        if kind == "not_null":
            marks.append(F.when(c.isNull(), F.struct(F.lit(i).alias("check"), none.alias("value"))))
        else:
            marks.append(F.when(c.isNotNull(), F.struct(F.lit(i).alias("check"), value_text(c, types[column]).alias("value"))))
    return df.select(F.inline(F.array_compact(F.array(*marks))))


def _null_counts(df: DataFrame, checks: Sequence[tuple[int, str, str]]) -> DataFrame:
    """(check, failures) of a table that has not_null checks alone: one aggregate, no row leaves its task."""
    row = df.agg(*[F.expr(f"count_if(`{c}` is null) as n{i}") for i, c, _ in checks])
    return row.selectExpr("inline(array(" + ", ".join(f"named_struct('check', {i}, 'failures', n{i})" for i, *_ in checks) + "))")


def check_suite(tables: Mapping[str, DataFrame], checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Run ``(table, column, check)`` triples; one result row per triple with a status (O3).

    ``not_null``: the number of NULL rows. ``unique``: the number of non-NULL values that occur more than once.
    """
    for _, _, kind in checks:
        if kind not in KINDS:
            raise ValueError(f"unknown check {kind!r}")
    spark = next(iter(tables.values())).sparkSession
    numbered = [(i, t, c, k) for i, (t, c, k) in enumerate(checks)]
    marks, failures = None, spark.range(len(numbered)).selectExpr("cast(id as int) as check", "0L as failures")     # so that no check is missing
    for t in dict.fromkeys(t for t, _, _ in checks):
        own = [(i, c, k) for i, tt, c, k in numbered if tt == t]
        if all(k == "not_null" for *_, k in own):
            failures = failures.unionByName(_null_counts(tables[t], own))
            continue
        part = _marks(tables[t], own)
        marks = part if marks is None else marks.unionByName(part)
    if marks is not None:
        counted = marks.groupBy("check", "value").agg(F.expr("count(1) as n"))
        failures = failures.unionByName(counted.selectExpr("check", "if(value is null, n, if(n > 1, 1L, 0L)) as failures"))
    failures = failures.groupBy("check").agg(F.sum("failures").alias("failures"))
    label = lambda at: F.element_at(F.array(*[F.lit(c[at]) for c in numbered]), F.col("check") + 1)
    return failures.select(label(1).alias("table_name"), label(2).alias("column_name"), label(3).alias("check_name"), "failures",
                           F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))


def not_null(df: DataFrame, columns: Sequence[str], table_name: str = "") -> DataFrame:
    """One row per column: number of NULL rows (O1)."""
    return check_suite({table_name: df}, [(table_name, c, "not_null") for c in columns]).drop("status")


def unique(df: DataFrame, column: str | Sequence[str], table_name: str = "") -> DataFrame:
    """One row per column: number of non-NULL values that occur more than once (O2)."""
    columns = [column] if isinstance(column, str) else column
    return check_suite({table_name: df}, [(table_name, c, "unique") for c in columns]).drop("status")


def write_checked(df: DataFrame, path: str, not_null: Sequence[str] = (), mode: str = "overwrite") -> dict[str, int]:
    """Write ``df`` as Parquet and return its row count (``""``) and the NULLs of ``not_null`` columns, counted while it is written."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(not_null)]]
    df.observe(seen, *metrics).write.mode(mode).parquet(path)
    got = seen.get
    return {"": got["rows"], **{c: got[f"n{i}"] for i, c in enumerate(not_null)}}


def gate(results: DataFrame) -> None:
    """Raise when any check failed, naming all that did (the post-build gate; as many rows as declared checks)."""
    bad = results.where(F.col("status") == "fail").select("table_name", "column_name", "check_name").collect()
    if bad:
        raise AssertionError("data-quality checks failed: " + ", ".join(".".join(r) for r in bad))
