"""Operator properties and plan checks."""

import random

from pyspark.sql import functions as F

from hirelens.operators.dedupe import keep_first, unseen
from hirelens.operators.digest import digest, digest_totals, new_items
from hirelens.operators.lexicon import lexicon_match, matched_words, unique_words
from hirelens.operators.matching import learning_path, match_score, parse_skill_list, role_readiness, skill_gap
from hirelens.operators.quality import check_suite, gate
from hirelens.operators.stats import distinct_with_stats, salary_stats
from hirelens.plans import marts

SF = "/root/testdata/sf0.001"


def bnlj_cross_check(df, text, lexicon, keep, out="skill", min_len=100):
    """The literal cross-join form (lexicon × texts with a substring test), for comparison only."""
    lex = df.sparkSession.createDataFrame([(w.lower(),) for w in unique_words(lexicon)], [out])
    src = df.where(F.col(text).isNotNull() & (F.length(F.col(text)) > min_len))
    src = src.select(*keep, F.lower(F.col(text)).alias("_text"))
    return src.crossJoin(lex).where(F.col("_text").contains(F.col(out))).select(*keep, out)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_matcher_equals_cross_join(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = ["the", "and", "license", "token", "que", "zzz"]
    a = lexicon_match(docs, "text", words, keep=["doc_id"]).collect()
    b = bnlj_cross_check(docs, "text", words, keep=["doc_id"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) > 0


def test_word_mode(spark):
    df = spark.createDataFrame([("javascript and java",), ("digital",), ("git flow",)], "t string")
    sub = [r[0] for r in df.select(matched_words("t", ["java", "git"])).collect()]
    word = [r[0] for r in df.select(matched_words("t", ["java", "git"], mode="word")).collect()]
    assert sub == [["java"], ["git"], ["git"]] and word == [["java"], [], ["git"]]


def test_lexicon_marts_plan_has_no_nested_loop_or_python(spark):
    from hirelens.plans.bindings import q_mart_tech_skills, q_mart_topic_cooccurrence
    for q in (q_mart_tech_skills, q_mart_topic_cooccurrence):
        p = plan_text(q(spark, SF))
        assert "BroadcastNestedLoopJoin" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_dedupe_plan_uses_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id"))
    out = keep_first(df, ["k"], [F.col("id").desc()])
    p = out._jdf.queryExecution().sparkPlan().toString()
    # partial limit before the shuffle, final limit after it
    assert p.count("WindowGroupLimit") == 2
    assert sorted(r.id for r in out.collect()) == [93, 94, 95, 96, 97, 98, 99]


def test_distinct_with_stats_matches_naive(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), rnd.randint(0, 30), rnd.choice([None, 1.0, 2.0, 3.5, 10.0]), rnd.random() < 0.3)
            for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, id int, v double, f boolean")
    got = {r.k: r for r in distinct_with_stats(df, ["k"], "id", "v", avg_name="a", quantiles={"m": 0.5, "p9": 0.9},
                                              counts={"c": F.col("f")}, mins={"lo": "v"}, digits=None).collect()}
    ref = {r.k: r for r in df.groupBy("k").agg(
        F.count_distinct("id").alias("job_count"), F.avg("v").alias("a"), F.median("v").alias("m"),
        F.percentile("v", 0.9).alias("p9"), F.count_if("f").alias("c"), F.min("v").alias("lo")).collect()}
    assert set(got) == set(ref)
    for k in ref:
        g, r = got[k], ref[k]
        assert g.job_count == r.job_count and g.c == r.c and g.lo == r.lo
        assert abs(g.a - r.a) < 1e-9 and abs(g.m - r.m) < 1e-9 and abs(g.p9 - r.p9) < 1e-9


def test_percentiles_ordered(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    s = salary_stats(li, ["l_returnflag"], "l_extendedprice",
                     {"lo": "min", "p10": 0.1, "p25": 0.25, "med": "median", "p75": 0.75, "p90": 0.9, "hi": "max"},
                     digits=None).collect()
    for r in s:
        assert r.lo <= r.p10 <= r.p25 <= r.med <= r.p75 <= r.p90 <= r.hi


def test_shares_sum_to_100(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    for r in marts.remote_trend(o, ts="o_orderdate", flag="o_orderstatus", remote=["F"], onsite=["O"],
                                hybrid=["P"]).collect():
        assert abs(r.remote_pct + r.onsite_pct + r.hybrid_pct - 100) <= 0.2


def test_unseen_and_digest(spark):
    cands = spark.createDataFrame([
        ("A", 0, 0, "u1", "Data Analyst"), ("A", 0, 1, "u2", "Data Analyst"), ("B", 1, 0, "u2", "Data Analyst"),
        ("B", 1, 1, "", "Data Analyst"), ("B", 1, 2, "u3", "Senior Data Analyst"), ("B", 1, 3, "u4", "Data Engineer")],
        "company string, company_order int, position int, url string, title string")
    seen = spark.createDataFrame([("u1",)], "url string")
    items = new_items(cands, seen)
    got = sorted((r.company, r.url) for r in items.collect())
    assert got == [("A", "u2"), ("B", "u4")]
    d = {r.url: r for r in digest(items).collect()}
    assert d["u2"].company_items == 1 and tuple(digest_totals(items).first()) == (2, 2)
    nameless = items.withColumn("company", F.lit(None).cast("string"))
    assert [r.company_items for r in digest(nameless).collect()] == [2, 2] and tuple(digest_totals(nameless).first()) == (2, 1)
    seen2 = seen.unionByName(items.select("url"))
    assert new_items(cands, seen2).count() == 0
    assert unseen(cands, seen, "url", ["company_order", "position"]).count() == 3


def test_quality_suite(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "id int, v string")
    res = {(r.column_name, r.check_name): (r.failures, r.status) for r in
           check_suite({"t": df}, [("t", "id", "not_null"), ("t", "v", "not_null"), ("t", "id", "unique")]).collect()}
    assert res == {("id", "not_null"): (1, "fail"), ("v", "not_null"): (1, "fail"), ("id", "unique"): (1, "fail")}
    ok = check_suite({"t": df.where("id = 2")}, [("t", "id", "unique")])
    gate(ok)


def test_matching(spark):
    pairs = spark.createDataFrame([(1, ["python", "sql"], ["python", "spark"], ["dbt"]),
                                   (2, [], [], ["sql"]), (3, ["sql"], ["sql", "x", "y"], None)],
                                  "id int, have array<string>, required array<string>, preferred array<string>")
    g = match_score(skill_gap(pairs))
    rows = {r.id: r for r in g.collect()}
    assert rows[1].matched == ["python"] and rows[1].missing_critical == ["spark"] and rows[1].missing_preferred == ["dbt"]
    assert rows[1].match_score == 0.5 and rows[1].match_band == "moderate"
    assert rows[2].match_score is None and rows[2].match_band is None
    assert rows[3].match_band == "weak"
    market = spark.createDataFrame([("spark", 1), ("x", 7), ("y", 30)], "skill string, demand_rank int")
    lp = {(r.id, r.skill): (r.priority, r.step) for r in learning_path(g, "id", market).collect()}
    assert lp == {(1, "spark"): ("high", 1), (3, "x"): ("medium", 1), (3, "y"): ("low", 2)}
    people = spark.createDataFrame([(1, " Python, SQL ,, ", "de")], "id int, csv string, role string").withColumn(
        "skills", parse_skill_list("csv"))
    unranked = {(r.id, r.skill): (r.priority, r.step) for r in learning_path(g, "id", market.where("skill = 'y'")).collect()}
    assert unranked == {(1, "spark"): ("low", 1), (3, "y"): ("low", 1), (3, "x"): ("low", 2)}
    top = spark.createDataFrame([("de", "python", 1), ("de", "spark", 2), ("de", "sql", 2), ("de", "dbt", 4), ("de", "x", 30)],
                                "role_cluster string, skill string, role_rank int")
    r = role_readiness(people, "id", "skills", "role", top).collect()[0]
    assert (r.covered, r.top_n, r.readiness, r.to_learn) == (2, 4, 50.0, "dbt,spark")
    assert role_readiness(people, "id", "skills", "role", top, top_n=2).collect()[0].top_n == 3


def test_lexicon_frame_and_labels(spark):
    from hirelens.operators.lexicon import lexicon_frame
    from hirelens.operators.reports import distinct_labels
    lex = lexicon_frame(spark, '["python", " sql ", "airflow", "airflow"]')
    assert [r.skill for r in lex.collect()] == ["python", "sql", "airflow", "airflow"]
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "role_cluster string")
    assert [r[0] for r in distinct_labels(df).collect()] == ["a", "b"]


def test_dedupe_order_independent_and_digest(spark):
    from hirelens.operators.dedupe import dedupe_postings
    rows = [(str(i), f"C{i % 5}", f"t{i % 3}", None if i % 4 else 1.0, f"s{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "job_id string, company_name string, job_title string, "
                                     "annual_salary_est double, source string")
    a = {tuple(r) for r in dedupe_postings(df, ts=None).collect()}
    b = {tuple(r) for r in dedupe_postings(df.orderBy(F.rand(3)).repartition(7), ts=None).collect()}
    c = {tuple(r) for r in dedupe_postings(df, ts=None, digest_keys=True).collect()}
    assert a == b == c and len(a) == 15


def test_hot_key_paths(spark):
    """One key holds a third of all rows: every keyed path still returns whole, exact results."""
    from hirelens.operators.dedupe import keep_first
    from hirelens.operators.tags import tag_demand
    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        (F.col("id") % 5000).alias("job_id"), ((F.col("id") * 7) % 1000).cast("double").alias("v"),
        (F.col("id") % 2 == 0).alias("f"))
    got = {r.k: r for r in distinct_with_stats(base, ["k"], "job_id", "v", avg_name="a", quantiles={"m": 0.5},
                                              counts={"c": F.col("f")}, digits=None).collect()}
    ref = {r.k: r for r in base.groupBy("k").agg(F.count_distinct("job_id").alias("job_count"), F.avg("v").alias("a"),
                                                 F.median("v").alias("m"), F.count_if("f").alias("c")).collect()}
    assert set(got) == set(ref) and got["hot"].job_count == ref["hot"].job_count
    for k in ("hot", "k1", "k996"):
        assert got[k].job_count == ref[k].job_count and got[k].c == ref[k].c
        assert abs(got[k].a - ref[k].a) < 1e-6 and got[k].m == ref[k].m
    first = keep_first(base, ["k"], [F.col("v").desc(), F.col("job_id")])
    assert first.count() == base.select("k").distinct().count()
    facts = spark.range(5000).select(F.col("id").alias("job_id"), F.lit(None).cast("timestamp").alias("listed_at"),
                                     F.col("id").cast("double").alias("annual_salary_est"),
                                     F.lit("FULL_TIME").alias("work_type"), F.lit("EN").alias("experience_level"))
    tags = base.select("job_id", F.col("k").alias("skill_id"))
    td = {r.skill_id: r for r in tag_demand(tags, facts).collect()}
    assert td["hot"].job_count == ref["hot"].job_count and td["hot"].demand_rank == 1


QS = {"p10": 0.1, "med": 0.5, "p75": 0.75, "p90": 0.9}


def _equal_to_percentile(df, got):
    got = {r.k: r for r in got.collect()}
    ref = {r.k: r for r in df.groupBy("k").agg(*[F.percentile("v", p).alias(n) for n, p in QS.items()]).collect()}
    assert set(got) == set(ref)
    for k in ref:
        for n in QS:
            assert got[k][n] == ref[k][n] or abs(got[k][n] - ref[k][n]) < 1e-9 * max(1, abs(ref[k][n])), (k, n, got[k][n], ref[k][n])


def test_quantiles_equal_percentile(spark):
    """Ties, one value, only NULL values, a NULL key, and a key with most of the rows."""
    rnd = random.Random(11)
    rows = [("hot", float(rnd.choice([100, 100, 100, 250.5, 999, rnd.randint(0, 10 ** 6)]))) for _ in range(3000)]
    rows += [(f"k{i % 17}", float(rnd.randint(0, 50))) for i in range(900)]
    rows += [(None, float(rnd.randint(0, 10 ** 6))) for _ in range(500)]
    rows += [("one", 42.0), ("same", 7.0), ("same", 7.0), ("nulls", None), ("nulls", 3.0), ("never", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    _equal_to_percentile(df, salary_stats(df, ["k"], "v", QS, digits=None))
    _equal_to_percentile(df, distinct_with_stats(df.withColumn("id", F.monotonically_increasing_id()), ["k"], "id", "v", quantiles=QS, digits=None))
    assert salary_stats(df.limit(0), ["k"], "v", QS).collect() == []


def test_quantile_brackets_are_bounded(spark):
    """An outlier of 1e12 over 200,000 distinct values: exact, and no more than the stated share of them is counted one by one."""
    from hirelens.operators import stats
    n = 200_000
    df = spark.range(n).select(F.lit("x").alias("k"), F.col("id").cast("double").alias("v")).union(
        spark.createDataFrame([("x", 1e12), ("few", 1.0)], "k string, v double"))
    _equal_to_percentile(df, salary_stats(df, ["k"], "v", QS, digits=None))
    _equal_to_percentile(df, distinct_with_stats(df.withColumn("id", F.lit(1)), ["k"], "id", "v", quantiles=QS, digits=None))
    rows = df.withColumnRenamed("v", "_v")
    (bracket,) = stats._brackets(rows, ["k"], list(QS.values())).collect()      # few values need none
    values = [float(i) for i in range(n)] + [1e12]
    for p, lo, hi in zip(QS.values(), bracket["_lo"], bracket["_hi"]):
        rank = p * (len(values) - 1)
        assert lo <= values[int(rank)] and values[min(int(rank) + 1, n)] <= hi
        assert sum(lo <= v <= hi for v in values) <= 2.2 * stats.MARGIN * n


def test_quantiles_of_many_keys_with_few_brackets(spark, monkeypatch):
    """Keys beyond those that get brackets, ties inside and outside of brackets, infinities: still exact."""
    from hirelens.operators import stats
    monkeypatch.setattr(stats, "WHOLE", 20)
    monkeypatch.setattr(stats, "HEAVY", 3)
    rnd = random.Random(3)
    rows = [(f"k{i % 9}" if i % 3 else "hot", rnd.choice([1.0, 5.0, 5.0, float(rnd.randint(0, 200)), None])) for i in range(4000)]
    rows += [("hot", float("inf")), ("k1", float("-inf")), (None, 2.0)] + [(None, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, v double")
    _equal_to_percentile(df, salary_stats(df, ["k"], "v", QS, digits=None))
    assert len(stats._brackets(df.withColumnRenamed("v", "_v"), ["k"], [0.5]).collect()) == 3


def test_pay_statistics_shuffle_little(spark):
    """At most four exchanges, whatever the statistics."""
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.col("id").cast("double").alias("v"))
    for got in (salary_stats(df, ["k"], "v", QS), distinct_with_stats(df, ["k"], "id", "v", avg_name="a", quantiles=QS)):
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        shuffles = sum(" Exchange " in line for line in plan.splitlines())
        assert 0 < shuffles <= 4, plan


def test_weights_stand_for_rows(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot"] * 5 + ["a", "b", None]), rnd.randint(0, 40), rnd.choice([None, 1.0, 2.5, 10.0, 10.0]),
             rnd.random() < 0.4) for _ in range(600)]
    df = spark.createDataFrame(rows, "k string, id int, v double, f boolean")
    kw = dict(avg_name="a", quantiles={"m": 0.5, "p9": 0.9}, counts={"c": F.col("f")}, mins={"lo": "v"})
    plain = distinct_with_stats(df, ["k"], "id", "v", **kw)
    weighed = distinct_with_stats(df.groupBy(*df.columns).agg(F.count("*").alias("w")), ["k"], "id", "v", weight="w", **kw)
    key = lambda r: str(r.k)
    assert sorted(plain.collect(), key=key) == sorted(weighed.collect(), key=key) and plain.count() == 4


def test_keep_first_stored_shuffles_no_text(spark, tmp_dir):
    from hirelens.operators.dedupe import keep_first_stored
    rnd = random.Random(4)
    rows = [(rnd.choice(["hot"] * 5 + [f"k{i % 40}", None]), rnd.choice([None, 1, 2, 3]), i // 2, f"text {i % 7}" * 20, 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, id int, text string, _row0 int").repartition(7)
    order = [F.col("v").isNull().asc(), F.col("v"), F.col("id")]
    got = keep_first_stored(df, [F.lower("k")], order, ["k", "v", "id"], "keep_first_test", f"{tmp_dir}/t", buckets=4)
    want = keep_first(df, [F.lower("k")], order)
    cut = lambda d: sorted((str(r.k), str(r.v), r.id) for r in d.collect())
    assert cut(got) == cut(want) and got.columns == df.columns and {r.text for r in got.collect()} <= {r[3] for r in rows}
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    scans = [i for i, line in enumerate(plan) if "FileScan" in line and "text" in line.split("]")[0]]
    assert len(scans) == 1
    above, at = [], depth(plan[scans[0]])
    for line in reversed(plan[:scans[0]]):
        if depth(line) < at:
            at = depth(line)
            above.append(line)
    assert above and not any("Exchange" in line for line in above), "\n".join(above)
    spark.sql("drop table keep_first_test")
    assert keep_first_stored(df.limit(0), ["k"], order, ["k", "v", "id"], "keep_first_none", f"{tmp_dir}/n").count() == 0
