"""What the classifiers learn from: bounded in rows, whatever ids repeat, and of texts of any length."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm import langid, quality, toxicity
from hirelens.llm.common import one_text
from tests.llm import samples


def _repeated(spark):
    """One id on a third of all rows, with different texts."""
    rng = random.Random(6)
    rows = [(k if k % 3 else 7, samples.prose(rng, 30)) for k in range(900)] + [(7, None), (7, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_one_text_of_each_id(spark):
    docs = _repeated(spark)
    one = one_text(docs, ["doc_id"], "text").collect()
    assert len(one) == docs.select("doc_id").distinct().count()
    assert {(r.doc_id, r.text) for r in one} <= {(r.doc_id, r.text) for r in docs.collect()}
    assert one_text(docs.repartition(9), ["doc_id"], "text").where("doc_id = 7").first() == next(r for r in one if r.doc_id == 7)


def test_samples_are_bounded_in_rows(spark, monkeypatch):
    docs = _repeated(spark)
    labels = docs.select("doc_id").distinct().withColumn("quality", F.expr("cast(doc_id % 2 as int)")).withColumn("toxic", F.expr("cast(doc_id % 2 as int)"))
    taken = []
    for name in ("toPandas", "toArrow"):
        own = getattr(type(docs), name)
        monkeypatch.setattr(type(docs), name, lambda self, own=own: taken.append(len(got := own(self))) or got)
    labels = labels.unionByName(labels.where("doc_id = 7"))
    quality.train(docs, labels, F.lit(True), quality.RuleConfig(rows=5))
    assert taken and max(taken) <= 5
    taken.clear()
    toxicity.train(docs, labels, F.lit(True), toxicity.TrainConfig(rows=5))
    assert taken and max(taken) <= 5
    assert isinstance(docs, DataFrame)


def test_languages_of_long_texts_are_learned(spark):
    rng = random.Random(9)
    words = {"aa": ["alfa", "abba", "labas", "falla"], "bb": ["bronz", "zorn", "brunn", "norbz"], "cc": ["中文字", "字文", "文中"]}
    rows = [(k, samples.prose(rng, 1500, words[lang]), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 6)]
    rows += [(100, "z" * 9000, "dd"), (101, "z" * 5001, "dd")]                         # no blank to cut at
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(len(t) > 4000 for _, t, _ in rows)
    model = langid.train(docs, F.lit(True))
    assert set(model.languages) == {"aa", "bb", "cc", "dd"}
    short = spark.createDataFrame([(1, "alfa labas"), (2, "zorn brunn"), (3, "文中 字文")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(short, model).orderBy("doc_id").collect()] == ["aa", "bb", "cc"]
