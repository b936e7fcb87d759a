"""Lexicons that are tables against one test per word."""

import random
import re

from pyspark.sql import functions as F

from hirelens.operators.automaton import match_table, word_sets
from hirelens.operators.lexicon import lexicon_match, matched_words


def _frames(spark):
    rnd = random.Random(3)
    letters = "abcé_1 -"
    texts = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))) for i in range(200)]
    texts += [(900, None), (901, ""), (902, "ABC É a_b"), (902, "ABC É a_b"), (903, "ab" * 5000)]
    words = sorted({"".join(rnd.choice("abcé_1") for _ in range(rnd.randint(1, 4))) for _ in range(60)})
    listed = [f" {w.upper()} " for w in words] + words[:5] + ["", "  ", None]
    return spark.createDataFrame(texts, "id long, text string").repartition(3), spark.createDataFrame([(w,) for w in listed], "word string"), words


def test_match_table_equals_a_test_per_word(spark):
    docs, lexicon, words = _frames(spark)
    for mode in ("substring", "word"):
        want = sorted((r.id, r.skill) for r in docs.select("id", F.explode(matched_words("text", words, mode)).alias("skill")).collect())
        for size in (1000, 7):
            got = match_table(docs, "text", lexicon, "word", keep=["id"], mode=mode, size=size)
            assert got.columns == ["id", "skill"] and sorted((r.id, r.skill) for r in got.collect()) == want, (mode, size)
    assert any(len(s) > 1 for s in word_sets(lexicon, "word", 7)) and sorted(w for s in word_sets(lexicon, "word", 7) for w in s) == sorted(words)
    assert all(re.fullmatch("[abcé_1]+", w) for w in words)


def test_lexicon_match_takes_a_table(spark):
    docs, lexicon, words = _frames(spark)
    attrs = spark.range(0, 1000).withColumnRenamed("id", "doc").selectExpr("doc as id", "doc % 7 as level")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(lexicon_match(docs, "text", lexicon, keep=["id"], min_len=20, attrs=attrs, on="id")) == rows(
        lexicon_match(docs, "text", words, keep=["id"], min_len=20, attrs=attrs, on="id"))
    none = lexicon.where("word = 'no such word'")
    assert match_table(docs, "text", none, "word", keep=["id"]).collect() == []


def test_listed_words_are_the_words_of_each_row(spark):
    lexicon = spark.createDataFrame([(w,) for w in ("ab", "b", "zz", "c d")], "word string")
    docs = spark.createDataFrame([(1, "xABx c d"), (2, "none"), (3, None), (1, "b"), (None, "zz b"), (4, "")], "id int, text string")
    for size in (100, 1):
        plain = match_table(docs, "text", lexicon, "word", keep=["id"], size=size).collect()
        listed = match_table(docs, "text", lexicon, "word", keep=["id"], size=size, listed=True).collect()
        assert sorted(((r.id, w) for r in listed for w in r.skill), key=str) == sorted(((r.id, r.skill) for r in plain), key=str)
        assert size < 100 or len(listed) == 3


def test_lexicon_mart_joins_rows_of_texts_and_counts_repeated_ids_once(spark, tmp_dir):
    from hirelens.plans.registry import QUERIES

    docs = [(i % 20, f"The {'apache ' * (i % 2)}license of document {i}" + " and so on" * 12, "en", "a", 0) for i in range(30)]
    orders = [(i % 18, 1000.0 + i, "1-URGENT" if i % 3 else "5-LOW") for i in range(25)]
    spark.createDataFrame([*docs, (None, "apache " * 30, "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(0, "zinc bolt")], "p_partkey long, p_name string").write.parquet(f"{tmp_dir}/part.parquet")
    spark.createDataFrame([(0, "passage")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    table = QUERIES["lexicon_table"](spark, tmp_dir)
    assert {r.skill: r.documents for r in table.collect()} == {"the": 20, "license": 20, "and": 20, "apache": 10}
    mart = QUERIES["mart_lexicon_table"](spark, tmp_dir)
    got = {r.skill: r for r in mart.collect()}
    pay = {w: sorted(p for i, t, *_ in docs for k, p, _ in orders if i == k and w in t.lower()) for w in ("the", "license", "and")}
    assert {w: (r.job_count, r.avg_salary, r.median_salary, r.senior_count) for w, r in got.items()} == {
        w: (18, round(sum(v) / len(v)), int((v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 + 0.5),
            sum(1 for i, t, *_ in docs for k, _, q in orders if i == k and w in t.lower() and q == "1-URGENT")) for w, v in pay.items()}
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan[plan.index("Generate explode(words"):]  # words are exploded above the join: it moves a row a text
