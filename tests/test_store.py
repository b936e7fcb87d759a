"""Stored marts: fresh ones are read, expired ones are built again."""

import os

from pyspark.sql import functions as F

from hirelens.plans import bindings_ops as B
from hirelens.sources.store import MartStore, source_state


def test_store_reads_fresh_and_rebuilds_expired(spark, tmp_dir):
    built = []

    def build():
        built.append(1)
        return spark.range(3).select("id", F.lit(len(built)).alias("build"))

    store = MartStore(spark, os.path.join(tmp_dir, "marts"), max_age=100)
    first = lambda **kw: store.read("m", build, **kw).first()["build"]
    assert [first(now=1000.0), first(now=1000.0), first(now=1099.9)] == [1, 1, 1] and len(built) == 1
    assert first(now=1100.0) == 2                       # as old as max_age
    assert first(now=1150.0, state="other") == 3        # built from something else
    assert first(now=1150.0) == 2 and first(now=1199.0, state="other") == 3
    assert first(now=500.0) == 4                        # before all builds
    assert first(now=3000.0) == 5 and len(store.builds("m")) == 2 + sum(3000 - at < 100 for at, *_ in store.builds("m")[2:])
    assert [b[0] for b in store.builds("m")][0] == 3000.0
    half = os.path.join(tmp_dir, "marts", "m", "at=3050000-")
    os.makedirs(half)
    assert first(now=3060.0) == 5                       # a build that was not committed isn't read
    assert store.read("other", build, now=3060.0).count() == 3


def test_source_state_follows_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    assert source_state(spark, [path]) == source_state(spark, [path])
    states = {source_state(spark, [path])}
    for n in (1, 2):
        spark.range(n).write.mode("append").parquet(path)
        states.add(source_state(spark, [path]))
    assert len(states) == 3


def test_reports_scan_one_stored_mart(spark):
    d = "/root/testdata/sf0.001"
    for name in ("report_pay_range", "report_role_filtered", "report_top_states", "report_seniority", "report_tier_labels", "kpi_headline"):
        B.OP_QUERIES[name](spark, d).collect()          # builds the mart where there is none
        plan = B.OP_QUERIES[name](spark, d)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "Join" not in plan, plan
