"""Running sums over ordered rows of a key, also when one key holds most of the rows.

Rows are range-partitioned by (key, order), so a large key lies over many tasks. Each task adds up its own rows and the
table is written once, with the number of the task. What a task lacks is the sum of the rows of its first key in the
tasks before it; for that one row a task comes to the driver (its first and last key with their sums), never rows of
the table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from hirelens.llm.common import map_batches, stored


def running(df: DataFrame, key: str, order: Sequence, sums: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``<s>_before`` for each s of ``sums`` (long columns): the sum of s over the earlier rows of the key.

    ``key`` is a long column without nulls, ``order`` columns (or sort expressions) within it. Sums are exact modulo
    2**64. Rows that are equal in ``order`` come in any order; to spread those of one key over tasks, end ``order`` with a
    column that tells them apart. ``df`` needs column names that don't start with ``__run``. Written once under ``name``.
    """
    spark, k = df.sparkSession, len(sums)
    added = [StructField(f"{s}_before", LongType()) for s in sums]
    notes = [StructField("__run_task", IntegerType()), StructField("__run_seq", LongType())]
    schema = StructType([*df.schema.fields, *added, *notes])
    from pyspark.sql.pandas.types import to_arrow_schema
    target, columns = to_arrow_schema(schema), df.columns

    def run(batches):
        task, seq, last, total = TaskContext.get().partitionId(), 0, None, np.zeros(k, np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.asarray(batch[key])
            values = np.stack([np.asarray(batch[s]).astype(np.int64) for s in sums], axis=1)
            upto = np.cumsum(values, axis=0)            # wraps, as the sums do
            before = upto - values
            new = np.ones(n, bool)
            new[1:] = keys[1:] != keys[:-1]
            new[0] = last is None or keys[0] != last
            starts = np.flatnonzero(new)
            own = np.searchsorted(starts, np.arange(n), side="right") - 1
            base = np.where((own >= 0)[:, None], before[starts[own]] if len(starts) else 0, -total)
            before = before - base
            last, total = keys[-1], before[-1] + values[-1]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in columns], *[pa.array(before[:, j]) for j in range(k)],
                                              pa.array(np.full(n, task, np.int32)), pa.array(np.arange(seq, seq + n))], schema=target)
            seq += n

    dealt = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    table = stored(map_batches(dealt, run, schema), name)
    # per task: first key, last key, and the sums of the last key up to the task's end
    ends = [F.struct(f"{s}_before", s).alias(s) for s in sums]
    edge = (table.groupBy("__run_task").agg(F.min(key).alias("first"), F.max(F.struct("__run_seq", F.col(key).alias("key"), *ends)).alias("end"))
            .orderBy("__run_task").collect())
    offsets, key_before, carried = [], None, [0] * k
    for r in edge:
        same = r["first"] == key_before
        if same and any(carried):
            offsets.append((r["__run_task"], r["first"], *carried))
        whole = [_wrap(r["end"][s][0] + r["end"][s][1]) for s in sums]
        if r["end"]["key"] == r["first"] and same:      # the key goes on beyond this task
            whole = [_wrap(a + b) for a, b in zip(whole, carried)]
        key_before, carried = r["end"]["key"], whole
    out = table
    if offsets:
        fields = [StructField("__run_task", IntegerType()), StructField("__run_key", LongType()), *[StructField(f"__run_{j}", LongType()) for j in range(k)]]
        more = F.broadcast(spark.createDataFrame(offsets, StructType(fields)))     # a row a task at most
        out = table.join(more.withColumnRenamed("__run_task", "__run_of"), (F.col("__run_task") == F.col("__run_of")) & (F.col(key) == F.col("__run_key")), "left")
        wide = [(f"{s}_before", j) for j, s in enumerate(sums)]
        out = out.withColumns({c: _added(F.col(c), F.coalesce(F.col(f"__run_{j}"), F.lit(0))) for c, j in wide})
    return out.select(*columns, *[f.name for f in added])


def _wrap(x: int) -> int:
    return (x + 2**63) % 2**64 - 2**63


def _added(a, b):
    """a + b modulo 2**64 without an overflow error."""
    whole = a.cast("decimal(38,0)") + b.cast("decimal(38,0)")
    two = F.lit(str(2**64)).cast("decimal(38,0)")
    return F.when(whole > F.lit(2**63 - 1), whole - two).when(whole < F.lit(-(2**63)), whole + two).otherwise(whole).cast("long")
