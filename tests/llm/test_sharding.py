"""Rendezvous sharding and the running sums below it."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hirelens.llm import sharding
from hirelens.llm.running import running
from tests.llm import samples


def _shard(key, weights):
    def score(j):
        u = (int(hashlib.md5(f"{'' if key is None else key}:{j}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        return -weights[j] / math.log(u)
    return max((j for j in range(len(weights)) if weights[j] > 0), key=lambda j: (score(j), -j))


@pytest.mark.parametrize("weights", [[1.0] * 7, [1.0, 0.0, 3.0, 0.5]])
def test_numbered_matches_brute_force(spark, weights):
    rows = samples.hard_texts() + [(100 + k, f"t{k}", "en", "a") for k in range(200)] + [(777, "same", "en", "a")] * 90
    got = sharding.numbered(samples.frame(spark, rows), weights, grow=2.0).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), _shard(i, weights), _shard(i, [*weights, 2.0])) for i, t, *_ in rows)
    assert Counter((r.key, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert all(r.grown_shard in (r.shard, len(weights)) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, r.key is not None, r.key or 0))
    for s in slots.values():
        assert [x[0] for x in sorted(s)] == list(range(len(s)))
        assert [x[1:] for x in sorted(s)] == sorted(x[1:] for x in s)
    assert sharding.numbered(samples.frame(spark, []), weights).collect() == []


def test_shares_follow_weights(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = {r.shard: r["count"] for r in sharding.assign(ids, [1.0, 2.0, 5.0]).groupBy("shard").count().collect()}
    assert abs(n[0] - 2500) < 250 and abs(n[1] - 5000) < 300 and abs(n[2] - 12500) < 350
    for bad in ([], [0.0], [-1.0, 2.0], [math.nan]):
        with pytest.raises(ValueError):
            sharding.assign(ids, bad)


def test_written_shards_hold_all_records(spark, tmp_dir):
    rows = samples.hard_texts()
    docs = samples.frame(spark, rows)
    for _ in range(2):
        sharding.write(docs, [1.0] * 3, f"{tmp_dir}/shards", files_per_shard=2)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == Counter((i, t, _shard(i, [1.0] * 3)) for i, t, *_ in rows)
    with pytest.raises(ValueError):
        sharding.write(docs.withColumn("shard", F.lit(1)), [1.0], f"{tmp_dir}/other")


def test_running_sums_over_a_hot_key(spark):
    rows = [(7, k, (k * 37) % 11 - 5, 2**62) for k in range(900)] + [(k, 0, 3, 1) for k in range(300)] + [(1000, 5, 1, 1)] * 3
    df = spark.createDataFrame(rows, "k long, at int, a long, b long").withColumn("salt", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running(df.repartition(5), "k", ["at", "salt"], ["a", "b"], "test").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before, wrap = defaultdict(lambda: [0, 0]), lambda x: (x + 2**63) % 2**64 - 2**63
    assert len(got) == len(rows)
    for r in sorted(got, key=lambda r: (r.k, r["at"], r.salt)):
        t = before[r.k]
        assert (r.a_before, r.b_before) == (t[0], wrap(t[1])), r
        t[0] += r.a
        t[1] += r.b
