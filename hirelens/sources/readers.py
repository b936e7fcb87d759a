"""File readers: CSV with header, column-name normalisation, optional sources,
the load manifest (A1, A2, A4, A5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .sinks import write_table


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header; values may hold quotes (A1).

    ``multi_line`` is for files whose values hold line ends; such a file can't be split, so it is one task.

    With a schema no inference pass runs (the production setting); without
    one, types are inferred like the landing job did.
    """
    r = (spark.read.option("header", True).option("multiLine", multi_line)
         .option("escape", '"').option("quote", '"'))
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def normalize_name(name: str) -> str:
    return name.upper().replace(" ", "_").replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Upper-case names, spaces and '-' → '_'; fail on collisions (A2)."""
    names = [normalize_name(c) for c in df.columns]
    dupes = {n for n in names if names.count(n) > 1}
    if dupes:
        raise ValueError(f"column names collide after normalising: {sorted(dupes)}")
    return df.toDF(*names)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop filesystem of the path (works for object stores)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Read when present, else an empty frame with the declared schema (A4)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def load_manifest(spark: SparkSession, root: str, manifest: Mapping[str, str], out_root: str,
                  schemas: Mapping[str, T.StructType] | None = None, multi_line: bool = False) -> dict[str, int]:
    """For each ``file → table``: read (skip if missing), normalise names, overwrite (A5).

    Returns the tables written and whether each was found (1) or skipped (0).
    """
    done = {}
    for rel, name in manifest.items():
        path = f"{root.rstrip('/')}/{rel}"
        if not path_exists(spark, path):
            done[name] = 0
            continue
        schema = (schemas or {}).get(name)
        df = normalize_columns(read_csv(spark, path, schema, multi_line))
        write_table(df, f"{out_root.rstrip('/')}/{name}")
        done[name] = 1
    return done
