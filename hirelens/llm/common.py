"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: At most so many rows are ever marked for broadcast; larger sides go through an ordinary join.
SMALL_ROWS = 20_000
#: Rows of one Arrow batch between the JVM and a Python worker.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; only where it is unset, a folder of this machine (tests)."""
    sc = spark.sparkContext
    have = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not have:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        have = tempfile.mkdtemp(prefix="llm-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(have)
    return have


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read again: a cut of the lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete tables of ``stored`` from which nothing will be read any more: what they led to is stored itself."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def unused(columns: Sequence[str]) -> str:
    """A prefix with which no column name begins, whatever its case: for columns beside those of a caller."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def maybe_broadcast(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint for a side whose rows were counted and are at most ``limit``; the side itself otherwise."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def one_text(rows: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``keys`` and ``text``: of rows with equal keys the text with the smallest hash, so a sample of ids is one of rows too."""
    least = F.min(F.struct(F.xxhash64(text).alias("hash"), F.col(text).alias("text")))
    return rows.groupBy(*keys).agg(least.alias("least")).select(*keys, F.col("least.text").alias(text))


def crc_mod(col: Column, m: int) -> Column:
    """crc32 of the value as text, modulo m (null: crc32 of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | Iterator[dict]], schema: str) -> DataFrame:
    """``df.mapInArrow`` with a function from a record batch to {column: array} (or an iterator of such)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            got = fn(batch)
            for part in [got] if isinstance(got, dict) else got:
                yield pa.RecordBatch.from_arrays([as_array(part[f.name], f.type) for f in target], schema=target)

    return map_batches(df, run, schema)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` in batches of at most ``BATCH_ROWS`` rows.

    Texts are long, and a batch lies in the JVM and in the Python worker at once. The batch size is a setting of the
    session that no result depends on; it is only ever lowered.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))

    def run_and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return df.mapInArrow(run_and_release, schema)


def release_memory() -> None:
    """Give freed memory back to the system: workers live on between tasks, beside the JVM that may need it."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def as_array(x, kind: pa.DataType) -> pa.Array:
    if isinstance(x, pa.ChunkedArray):
        x = x.combine_chunks()
    if isinstance(x, pa.Array):
        return x if x.type == kind else x.cast(kind)
    return pa.array(x, type=kind)


def spans_to_list(values: np.ndarray, counts: Sequence[int], kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, type=kind))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each row given row starts (and the end) ``first``."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
