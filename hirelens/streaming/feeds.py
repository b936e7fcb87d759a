"""Structured Streaming form of the daily feed load and the monthly trend.

J1: landed API responses (JSON files) are read as a file stream. Each micro-batch is flattened into a history that is
partitioned by fetch day and batch id (a retried batch rewrites its own folders), and the days that it touched, and no
others, are read and loaded again with the batch functions: first seen row of each job and day, day replace. So a file that
lands late, whatever its modification time, is never dropped: it makes its day load again. A repeated file adds rows that
lose. A stream and a batch run over the same files end in equal tables.

J2: the monthly share trend (M3) over event time. Postings are counted in day windows under a watermark, and a day is
appended to its table once, when the watermark has passed its end. Rows up to ``lateness`` behind the newest always count;
later ones do as long as their day is open, and are left out once it was appended, so closed months never change. ``closed_months`` gives the trend of the months all of whose days are final, equal to the batch mart's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.expr import month_start, ratio_pct
from ..sources.load import flat_feed, label_files, load_flat
from ..sources.schemas import (ADZUNA_PAYLOAD, ASHBY_PAYLOAD, GREENHOUSE_PAYLOAD, JSEARCH_PAYLOAD)

_SCHEMAS = {"adzuna": ADZUNA_PAYLOAD, "jsearch": JSEARCH_PAYLOAD, "greenhouse": GREENHOUSE_PAYLOAD,
            "ashby": ASHBY_PAYLOAD}


LISTED_BY = 4     # tasks a core that list folders


def read_landed(spark: SparkSession, landing_dir: str, kind: str, max_files: int | None = None) -> DataFrame:
    """File stream of landed responses, in all subfolders, with path and modification time.

    Responses lie in a folder each, and Spark lists up to 10,000 folders with a task each, which takes longer to start than a
    folder to list. The number of listing tasks is a setting of the session that no result depends on; it is only ever lowered.
    """
    name, tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism", LISTED_BY * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(name)) > tasks:
        spark.conf.set(name, str(tasks))
    r = spark.readStream.schema(_SCHEMAS[kind]).option("multiLine", True).option("recursiveFileLookup", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    meta = F.col("_metadata")
    return r.json(landing_dir).withColumn("_file", meta["file_path"]).withColumn("_fetched", meta["file_modification_time"])


def start_feed_stream(spark: SparkSession, landing_dir: str, kind: str, asked: Sequence[str], history_dir: str, sink_dir: str,
                      checkpoint_dir: str, available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Run J1 into the table at ``sink_dir``; ``asked`` lists queries (boards: companies) in the order of asking."""
    label = "query" if kind in ("adzuna", "jsearch") else "company"
    history = history_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        days = Observation()
        flat = flat_feed(label_files(batch, asked, label), kind)
        flat = flat.withColumn("_day", F.left(F.col("FETCHED_AT"), F.lit(10))).withColumn("_batch", F.lit(batch_id))
        (flat.observe(days, F.collect_set("_day").alias("days")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_day", "_batch").parquet(history))
        touched = sorted(days.get["days"])      # a few: the days on which the batch's files were fetched
        if touched:
            load_flat(history_of(batch.sparkSession, history, touched), sink_dir)

    w = (read_landed(spark, landing_dir, kind, max_files).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def history_of(spark: SparkSession, history: str, days: Sequence[str]) -> DataFrame:
    """The flat rows of some days; only their folders are listed and read."""
    paths = [f"{history.rstrip('/')}/_day={d}" for d in days]
    return spark.read.option("basePath", history).parquet(*paths).drop("_day", "_batch")


BUCKETS = (("remote", ("1",)), ("onsite", ("0",)), ("hybrid", ("hybrid",)))


def share_days_stream(postings: DataFrame, ts: str = "listed_at", flag: str = "remote_allowed",
                      buckets: Sequence[tuple[str, Sequence[str]]] = BUCKETS, lateness: str = "3 days") -> DataFrame:
    """J2, first step: counts of each day window and month of a stream of postings, for append output.

    A window that two months share in the session's time zone has a row for each. Rows without ``ts`` are left out.
    """
    src = postings.where(F.col(ts).isNotNull()).select(F.col(ts).cast("timestamp").alias("_at"), flag).withWatermark("_at", lateness)
    counts = [F.count_if(F.col(flag).isin(list(v))).alias(f"{n}_count") for n, v in buckets]
    g = src.groupBy(F.window("_at", "1 day").alias("day"), month_start("_at").alias("month")).agg(F.count(F.lit(1)).alias("total"), *counts)
    return g.select(F.col("day.start").alias("day"), "month", "total", *[f"{n}_count" for n, _ in buckets])


def start_trend_stream(days: DataFrame, out_dir: str, checkpoint_dir: str, available_now: bool = True) -> StreamingQuery:
    """Append the final days of ``share_days_stream`` to the table at ``out_dir``."""
    w = days.writeStream.format("parquet").outputMode("append").option("path", out_dir).option("checkpointLocation", checkpoint_dir)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def closed_months(days: DataFrame, buckets: Sequence[tuple[str, Sequence[str]]] = BUCKETS) -> DataFrame:
    """J2, second step: the share trend of the months whose days are all final, from the table of final days.

    Days become final in order, so a month is closed once a day window that starts after its end is there.
    """
    names = [n for n, _ in buckets]
    g = days.groupBy("month").agg(F.sum("total").alias("total"), *[F.sum(f"{n}_count").alias(f"{n}_count") for n in names], F.max("day").alias("_last"))
    # a row a month: a global window over it is cheap
    g = g.withColumn("_newest", F.max("_last").over(Window.partitionBy())).where(F.add_months("month", 1).cast("timestamp") <= F.col("_newest"))
    return g.select("month", "total", *[f"{n}_count" for n in names], *[ratio_pct(f"{n}_count", "total", 1).alias(f"{n}_pct") for n in names])


def share_trend_stream(postings: DataFrame, ts: str = "listed_at", flag: str = "remote_allowed",
                       buckets: Sequence[tuple[str, Sequence[str]]] = BUCKETS) -> DataFrame:
    """The monthly share trend so far, months that are still open included (complete / update output)."""
    src = postings.where(F.col(ts).isNotNull())
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.col(flag).isin(list(v))).alias(f"{n}_count") for n, v in buckets]
    g = src.groupBy(month_start(ts).alias("month")).agg(*aggs)
    return g.select("month", "total", *[f"{n}_count" for n, _ in buckets],
                    *[ratio_pct(f"{n}_count", "total", 1).alias(f"{n}_pct") for n, _ in buckets])
