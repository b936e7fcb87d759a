"""Checks: one scan a table, two shuffles in all, the same counts as plain aggregates."""

import os
import random

import pytest
from pyspark.sql import functions as F

from hirelens.operators.quality import check_suite, gate, not_null, unique, write_checked


def _tables(spark):
    rnd = random.Random(1)
    rows = [(k, rnd.choice([None, "a", "b", f"x{k}"]), rnd.choice([0.0, -0.0, 1.5, float("nan"), float(k)]), rnd.choice([None, [k], [1, None]]),
             rnd.choice([None, True]), k % 700 if k % 3 else 1) for k in range(900)]
    one = spark.createDataFrame(rows, "id int, `a b` string, v double, arr array<int>, flag boolean, hot int").withColumn("ts", F.timestamp_seconds(F.col("id") % 50))
    return {"one": one, "two": spark.createDataFrame([(1, None), (2, None)], "k int, n string"), "none": spark.createDataFrame([], "k int")}


def test_suite_matches_plain_aggregates(spark):
    tables = _tables(spark)
    checks = [(t, c, k) for t, df in tables.items() for c in df.columns for k in ("not_null", "unique")]
    got = {(r.table_name, r.column_name, r.check_name): (r.failures, r.status) for r in check_suite(tables, checks).collect()}
    assert set(got) == set(checks)
    for t, c, k in checks:
        df = tables[t].select(F.col(f"`{c}`").alias("c"))
        want = df.where("c is null").count() if k == "not_null" else df.where("c is not null").groupBy("c").count().where("count > 1").count()
        assert got[(t, c, k)] == (want, "pass" if want == 0 else "fail"), (t, c, k)
    assert {r.column_name: r.failures for r in not_null(tables["two"], ["k", "n"]).collect()} == {"k": 0, "n": 2}
    assert [tuple(r) for r in unique(tables["one"], "hot", "one").collect()] == [("one", "hot", "unique", got[("one", "hot", "unique")][0])]
    with pytest.raises(ValueError):
        check_suite(tables, [("one", "id", "positive")])
    with pytest.raises(AssertionError, match="two.n.not_null"):
        gate(check_suite(tables, [("two", "k", "unique"), ("two", "n", "not_null")]))


def test_suite_shuffles_twice(spark):
    base = "/root/testdata/sf0.001/"
    tables = {n: spark.read.parquet(f"{base}{n}.parquet") for n in ("orders", "lineitem", "customer")}
    checks = [("orders", "o_orderkey", "unique"), ("orders", "o_custkey", "not_null"), ("orders", "o_custkey", "unique"),
              ("lineitem", "l_orderkey", "unique"), ("lineitem", "l_shipdate", "not_null"), ("customer", "c_custkey", "unique")]
    df = check_suite(tables, checks)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum(" Exchange " in line for line in plan.splitlines()) == 2, plan
    assert plan.count("FileScan") == len(tables), plan


def test_write_checked_counts_while_writing(spark, tmp_dir):
    df = _tables(spark)["one"]
    path = os.path.join(tmp_dir, "t")
    got = write_checked(df, path, ["a b", "id"])
    assert got == {"": 900, "a b": df.where("`a b` is null").count(), "id": 0} and spark.read.parquet(path).count() == 900
