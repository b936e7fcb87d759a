"""Streaming feed load and streaming trend."""

import json
import os

from pyspark.sql import functions as F

from hirelens.plans import bindings_ops, marts
from hirelens.sources.flatten import read_payloads
from hirelens.sources.load import load_feed
from hirelens.streaming import feeds
from hirelens.streaming.feeds import share_trend_stream, start_feed_stream


ASKED = ["analyst", "engineer"]


def _land(root, query, page, name, jobs, stamp):
    folder = os.path.join(root, f"query={query}", f"page={page}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        json.dump({"results": [{"id": str(i), "title": t, "company": {"display_name": "Acme"}, "description": "x",
                                "location": {"display_name": "US", "area": ["US", "Texas"]}, "salary_min": 1.0,
                                "salary_max": 3.0, "created": "2026-01-01T00:00:00Z"} for i, t in jobs]}, f)
    os.utime(path, (stamp, stamp))


def test_feed_stream_equals_batch(spark, tmp_dir):
    """Several batches, a job seen by two queries, a late file of an old day, a restart: the table is the batch load's."""
    land = os.path.join(tmp_dir, "landing")
    day = 86_400
    stamp = 1_767_300_000
    _land(land, "engineer", 1, "a.json", [(1, "second query"), (2, "B")], stamp)
    _land(land, "analyst", 2, "b.json", [(1, "first query, second page"), (3, "C")], stamp)
    _land(land, "analyst", 1, "c.json", [(4, "D"), (4, "again")], stamp + day)
    sink, args = os.path.join(tmp_dir, "sink"), (os.path.join(tmp_dir, "history"), os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    start_feed_stream(spark, land, "adzuna", ASKED, *args, max_files=1).awaitTermination(180)
    _land(land, "analyst", 1, "late.json", [(1, "first query, first page"), (5, "E")], stamp - 30)
    start_feed_stream(spark, land, "adzuna", ASKED, *args).awaitTermination(180)
    start_feed_stream(spark, land, "adzuna", ASKED, *args).awaitTermination(180)  # nothing new
    landed = read_payloads(spark, land, "adzuna", recursive=True)
    batch = os.path.join(tmp_dir, "batch")
    assert load_feed(landed, "adzuna", ASKED, batch) is True
    rows = lambda p: sorted(map(str, (r.asDict() for r in spark.read.parquet(p).collect())))
    assert rows(sink) == rows(batch)
    got = {(r.JOB_ID, r.TITLE, r.QUERY) for r in spark.read.parquet(batch).collect()}
    assert got == {("1", "first query, first page", "analyst"), ("2", "B", "engineer"), ("3", "C", "analyst"), ("4", "D", "analyst"), ("5", "E", "analyst")}
    assert len({str(r.fetch_date) for r in spark.read.parquet(batch).collect()}) == 2
    assert load_feed(landed.limit(0), "adzuna", ASKED, batch) is False and spark.read.parquet(batch).count() == 5


def test_feed_stream_lands_few_files(spark, tmp_dir, monkeypatch):
    """a response holds some thousand ids, the folders are listed by a few tasks, and every row still arrives."""
    n, files = 4000, []
    ids = spark.range(n).withColumnRenamed("id", "k")
    tables = {
        "documents": ids.select(F.col("k").alias("doc_id"), F.concat(F.lit("text "), "k").alias("text"), F.lit("en").alias("lang"), F.lit("s1").alias("source")),
        "orders": ids.selectExpr("k as o_orderkey", "k % 7 as o_custkey", "if(k % 2 = 0, 'O', 'F') as o_orderstatus", "cast(k as double) as o_totalprice",
                                 "date'2020-01-01' as o_orderdate", "'1-URGENT' as o_orderpriority"),
        "customer": spark.range(7).selectExpr("id as c_custkey", "concat('c', id) as c_name", "0L as c_nationkey"),
        "nation": spark.range(1).selectExpr("id as n_nationkey", "'N' as n_name"),
        "part": ids.selectExpr("k as p_partkey", "concat('p', k) as p_name", "'T' as p_type")}
    for name, df in tables.items():
        df.write.parquet(os.path.join(tmp_dir, f"{name}.parquet"))
    own = bindings_ops.start_feed_stream

    def start(spark_, land, *args):
        files.extend(f for _, _, fs in os.walk(land.removeprefix("file:")) for f in fs if f.endswith(".json"))
        return own(spark_, land, *args)

    monkeypatch.setattr(bindings_ops, "start_feed_stream", start)
    got = bindings_ops.q_feed_stream(spark, tmp_dir).select("JOB_ID", "TITLE", "DESCRIPTION", "QUERY", "URL").collect()
    # the language is a listed query, the source is not: it comes last
    assert sorted(map(tuple, got)) == sorted((str(i), f"p{i}", f"text {i}", "en", f"https://x/{i}") for i in range(n))
    assert len(files) == 2
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= feeds.LISTED_BY * spark.sparkContext.defaultParallelism


def test_stream_trend_equals_batch(spark, tmp_dir):
    src = "/root/testdata/sf0.001/orders.parquet"
    orders = spark.read.parquet(src)
    stream = spark.readStream.schema(orders.schema).parquet(os.path.dirname(src) + "/orders*.parquet")
    agg = share_trend_stream(stream, ts="o_orderdate", flag="o_orderstatus",
                             buckets=[("remote", ["F"]), ("onsite", ["O"]), ("hybrid", ["P"])])
    q = agg.writeStream.outputMode("complete").format("memory").queryName("trend_stream").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.table("trend_stream").collect())
    ref = sorted(tuple(r) for r in marts.remote_trend(orders, ts="o_orderdate", flag="o_orderstatus", remote=["F"],
                                                       onsite=["O"], hybrid=["P"]).collect())
    assert got == ref and len(got) > 0


def test_micro_batch_reads_only_its_days(spark, tmp_dir, monkeypatch):
    """Late and repeated files: a batch reads the history of the days it touched, and the table is the batch load's."""
    land, read, day, stamp = os.path.join(tmp_dir, "landing"), [], 86_400, 1_767_300_000
    own = feeds.history_of
    monkeypatch.setattr(feeds, "history_of", lambda spark_, history, days: read.append(list(days)) or own(spark_, history, days))
    args = (os.path.join(tmp_dir, "history"), os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    run = lambda: start_feed_stream(spark, land, "adzuna", ASKED, *args).awaitTermination(180)
    _land(land, "engineer", 1, "a.json", [(1, "x"), (2, "B")], stamp)
    _land(land, "engineer", 2, "b.json", [(3, "C")], stamp + day)
    run()
    _land(land, "engineer", 1, "again.json", [(1, "x"), (2, "B")], stamp)              # the same file, landed once more
    run()
    _land(land, "analyst", 1, "late.json", [(1, "first"), (9, "new")], stamp + 5)       # fetched long before it landed
    _land(land, "analyst", 1, "next.json", [(1, "next")], stamp + 2 * day)
    run()
    days = ["2026-01-01", "2026-01-02", "2026-01-03"]
    assert read == [days[:2], days[:1], [days[0], days[2]]]
    batch = os.path.join(tmp_dir, "batch")
    load_feed(read_payloads(spark, land, "adzuna", recursive=True), "adzuna", ASKED, batch)
    rows = lambda p: sorted(map(str, (r.asDict() for r in spark.read.parquet(p).collect())))
    assert rows(args[1]) == rows(batch) and len(rows(batch)) == 5


def test_closed_months_equal_the_mart(spark, tmp_dir):
    """Days in append output under a watermark; late rows within it count, months still open are left out."""
    src = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderdate", "o_orderstatus")
    buckets = [("remote", ["F"]), ("onsite", ["O"]), ("hybrid", ["P"])]
    parts = [src.where("o_orderdate < '1994-01-31'"), src.where("o_orderdate >= '1994-01-31' and o_orderdate < '1996-06-01'"), src.where("o_orderdate >= '1996-06-01'")]
    late = spark.createDataFrame([("1994-01-28", "F"), ("1990-01-01", "F")], "o_orderdate string, o_orderstatus string").select(
        F.col("o_orderdate").cast(src.schema["o_orderdate"].dataType).alias("o_orderdate"), "o_orderstatus")
    land, out, ckpt = (os.path.join(tmp_dir, n) for n in ("land", "out", "ckpt"))
    seen = None
    for i, part in enumerate(parts):
        part = part.unionByName(late.where(f"year(o_orderdate) = {[0, 1994, 1990][i]}"))        # 3 days late, and 6 years
        part.coalesce(1).write.mode("append").parquet(land)
        stream = spark.readStream.schema(src.schema).parquet(land)
        days = feeds.share_days_stream(stream, "o_orderdate", "o_orderstatus", buckets, lateness="5 days")
        feeds.start_trend_stream(days, out, ckpt).awaitTermination(180)
        got = {r.month: tuple(r) for r in feeds.closed_months(spark.read.parquet(out), buckets).collect()}
        assert seen is None or all(got[m] == r for m, r in seen.items())        # closed months don't change
        seen = got
    counted = src.unionByName(late.where("o_orderdate > '1992-01-01'"))
    want = {r.month: tuple(r) for r in marts.remote_trend(counted, ts="o_orderdate", flag="o_orderstatus", remote=["F"], onsite=["O"], hybrid=["P"]).collect()}
    last = src.agg(F.max("o_orderdate")).first()[0]
    newest = max(r.o_orderdate for r in src.distinct().collect() if (last - r.o_orderdate).days >= 6)     # the last final day
    assert seen == {m: r for m, r in want.items() if (m.year, m.month) < (newest.year, newest.month)} and len(seen) > 70
