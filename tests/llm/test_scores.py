"""Classifiers, language identification and perplexity rules."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hirelens.llm import langid, perplexity, quality, toxicity
from hirelens.llm.common import table
from hirelens.llm.textops import text_bytes, words_of
from hirelens.llm.textstats import STATS, base_stats
from tests.llm import samples

SF = "/root/testdata/sf0.01"
OPS = {"op2": (quality.op2_quality, "quality", 0.95, SF), "op10": (toxicity.op10_toxicity, "toxic", 0.96, "/root/testdata/sf0.1")}


def test_base_stats_match_brute_force():
    rng = random.Random(4)
    texts = [t for _, t, *_ in samples.hard_texts()] + [
        "".join(rng.choice([" ", "\n", "a", "b c", "é", "#", "\t", "x y z a b", "\x0b", "　"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for i, j, w in words_of(pa.array(texts, pa.string())):
        got = base_stats(w)
        for k in range(i, j):
            assert tuple(int(got[c][k - i]) for c in got) == samples.base_stats(texts[k])


@pytest.mark.parametrize("name", OPS)
def test_classifiers_on_held_out_rows(spark, name):
    op, label, least, sf = OPS[name]
    got = op(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got[label]).mean() >= least
    assert ((got["score"] >= 0.3).astype(int) == got["predicted"]).all() and got["score"].between(0, 1).all()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_hard_rows(spark, module):
    docs = samples.frame(spark, samples.hard_texts())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = module.train(docs, none, F.lit(True))
    assert {r.score for r in module.score(docs, model).collect()} == {0.0}
    rows = [(i % 20, int(i % 2 == 0), int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    model = module.train(docs, labels, F.lit(True))
    got = module.score(docs, model)
    assert got.columns == ["doc_id", "score", "predicted"]
    got = got.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in samples.hard_texts())
    assert all(0 <= r.score <= 1 for r in got)
    empty = samples.frame(spark, [])
    assert module.score(empty, module.train(empty, labels, F.lit(True))).collect() == []


def test_rule_columns_equal_rules(spark):
    """The compiled column gives what the rules give in numpy."""
    rng = np.random.default_rng(0)
    x = rng.random((400, len(STATS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.7)).astype(float)
    model = quality.fit(x, y, quality.RuleConfig(trees=5))
    z = model.intercept + sum(w * quality._holds(x, r) for r, w in model.rules)
    got = spark.createDataFrame([list(map(float, r)) for r in x], list(STATS)).select(model.column().alias("p")).toPandas()["p"]
    assert sorted(got) == pytest.approx(sorted(1 / (1 + np.exp(-z))))
    assert ((1 / (1 + np.exp(-z)) > 0.5) == y.astype(bool)).mean() > 0.97


def test_phrases_match_brute_force():
    rng = random.Random(3)
    ref = {"a": b"abracadabra the cat", "b": b"der die das und"}
    model = langid.build({k: np.frombuffer(v, np.uint8) for k, v in {
        k: langid.symbols(np.frombuffer(v, np.uint8), np.array([0, len(v)]))[0].tobytes() for k, v in ref.items()}.items()})
    own = {k: langid.symbols(np.frombuffer(v, np.uint8), np.array([0, len(v)]))[0].tobytes() for k, v in ref.items()}

    def brute(text, source):
        n = 0
        while text:
            size = 1
            while size < len(text) and text[:size + 1] in source:
                size += 1
            n, text = n + 1, text[size:]
        return n

    texts = ["".join(rng.choice("abcdert hxz") for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["", "a" * 1024]
    raw, offs = text_bytes(pa.array(texts))
    syms, at = langid.symbols(raw, offs)
    got = langid.phrases(model, syms, at)
    for k in range(len(texts)):
        assert got[k].tolist() == [brute(syms[at[k]:at[k + 1]].tobytes(), own[lang]) for lang in model.languages]


def test_language_on_held_out_and_hard_rows(spark):
    got = langid.op7_language(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() >= 0.97
    rows = samples.hard_texts() + [(900, "12 34 !!", "en", "a"), (901, "中文", "en", "a")]
    docs = samples.frame(spark, rows)
    pred = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, langid.train(docs, F.lit(True))).collect()}
    assert {pred[k] for k in (1, 2, 4, 900)} == {("und", 0.0)} and pred[901][0] != "und"
    nothing = langid.train(samples.frame(spark, []), F.lit(True))
    assert {tuple(r)[1:] for r in langid.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert langid.identify(samples.frame(spark, []), nothing).collect() == []


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 64**4, 5000)).astype(np.uint32)
    model = perplexity.build(keys, rng.integers(1, 9, len(keys)))
    for context in [*(keys[:40] >> 6), *rng.integers(0, 64**3, 40)]:
        q = (np.uint32(context) << np.uint32(6)) | np.arange(64, dtype=np.uint32)
        assert (2.0 ** -model.bits(q)).sum() == pytest.approx(1, abs=1e-6)


def test_gram_counts_match_brute_force(spark):
    rows = samples.hard_texts()[:12]
    want = Counter()
    for _, t, *_ in rows:
        s = [0] * 3 + [perplexity._symbol(b) for b in (t or "").encode()]
        want.update((s[k - 3] << 18) | (s[k - 2] << 12) | (s[k - 1] << 6) | s[k] for k in range(3, len(s)))
    assert {r.gram: r.n for r in perplexity.count_grams(samples.frame(spark, rows)).collect()} == dict(want)


def test_perplexity_rules(spark):
    rows = samples.hard_texts()
    got = perplexity.judge(samples.frame(spark, rows)).collect()
    stats = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert Counter((r.doc_id, *stats(r)) for r in got) == Counter((i, *samples.base_stats(t)) for i, t, *_ in rows)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert perplexity.judge(samples.frame(spark, [])).collect() == []
    judged = perplexity.op3_perplexity(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("quality = 1 and not base_failed").toPandas()
    assert judged["kept"].mean() > 0.98


def _chains(rng, n, successors):
    """Texts of 150 words in which each word is one of the few that may follow the one before."""
    out = []
    for _ in range(n):
        text = [rng.choice(list(successors))]
        while len(text) < 150:
            text.append(rng.choice(successors[text[-1]]))
        out.append(text)
    return out


def test_word_counts_match_brute_force(spark):
    rows = samples.hard_texts()
    want = Counter()
    for _, t, *_ in rows:
        w = [None, None, *samples.words(t)]
        want.update(zip(w, w[1:], w[2:]))
    docs = samples.frame(spark, rows).select(F.xxhash64("text").alias("text_key"), F.col("text").alias("__text"))
    got = perplexity.count_words(docs).toPandas()
    assert sorted(got["n0"] + got["n1"]) == sorted(want.values())
    assert len(want) > 20_000 and got[["ctx", "c"]].drop_duplicates().shape[0] == len(want)


def test_word_model_sums_to_one(spark):
    """Over all words of a fold and its unknown word, the probabilities after any context add up to one."""
    rng = random.Random(2)
    voc = samples.vocabulary(rng, 12)
    texts = [" ".join(rng.choice(voc) for _ in range(30)) for _ in range(40)]
    every = [" ".join((a, b, c)) for a in voc[:3] for b in voc[:3] for c in voc]
    docs = spark.createDataFrame([(2 * i, t) for i, t in enumerate(texts)] + [(1 + 2 * i, t) for i, t in enumerate(every)], "text_key long, __text string")
    got = perplexity.word_model(docs).toPandas()
    known = {tuple(r) for r in perplexity.count_words(docs.where("text_key % 2 = 0")).select("c").distinct().collect()}
    sums = (2.0 ** -got["bits0"]).groupby(got["ctx"]).sum()
    full = got.groupby("ctx").size() == len(set(voc))
    assert len(known) == len(set(voc)) and full.sum() >= 9
    assert all(0.9 < x <= 1.0 + 1e-9 for x in sums[full])


def test_perplexity_bands_reject_shuffled_and_junk_texts(spark):
    rng = random.Random(3)
    voc = list(dict.fromkeys(samples.vocabulary(rng, 400)))
    successors = {v: rng.sample(voc, 4) for v in voc}
    clean = _chains(rng, 400, successors)
    shuffled = [rng.sample(t, len(t)) for t in _chains(rng, 8, successors)]
    junk = [samples.vocabulary(rng, 150) for _ in range(8)]
    rows = [(i, " ".join(t), "en", "a") for i, t in enumerate(clean + shuffled + junk)]
    got = {r.doc_id: r for r in perplexity.judge(samples.frame(spark, rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert not any(got[i].kept for i in range(400, 416))
    assert sum(got[i].kept for i in range(400)) >= 0.98 * 400


def test_perplexity_in_slices_is_the_same_and_frees_its_tables(spark, monkeypatch):
    docs, kept, stored = samples.frame(spark, samples.hard_texts()), [], perplexity.stored
    monkeypatch.setattr(perplexity, "stored", lambda df, name: kept.append((name, stored(df, name))) or kept[-1][1])
    rows = lambda: sorted(perplexity.judge(docs).collect(), key=lambda r: str(r[:-1]))
    whole = rows()
    left = {name for name, t in kept if any(Path(t.stored_path.removeprefix("file:")).glob("*.parquet"))}
    assert left == {"sums", "perplexity"} and "trigrams" in dict(kept)
    monkeypatch.setattr(perplexity, "SLICE_ROWS", 0)
    kept.clear()
    sliced = rows()
    assert [name for name, _ in kept].count("sums") == perplexity.SLICES
    assert [r[:-1] for r in sliced] == [r[:-1] for r in whole]
    assert [r.perplexity for r in sliced] == [r.perplexity and pytest.approx(r.perplexity, rel=1e-9) for r in whole]


def test_perplexity_by_brute_force_with_little_on_disk(spark, monkeypatch):
    """Scores equal those of a plain model, also where every word is dealt by two words; blocks of a slice are far smaller than rows of hashes."""
    rng = random.Random(9)
    voc = samples.vocabulary(rng, 60)
    texts = [" ".join(rng.choice(voc) for _ in range(rng.randint(1, 40))) for _ in range(80)] + ["", None, voc[0]]
    docs = spark.createDataFrame([(7 * i, t) for i, t in enumerate(texts)], "text_key long, __text string")
    seen = [Counter(), Counter()]
    for i, t in enumerate(texts):
        w = [1, 0, *samples.words(t)]
        seen[7 * i & 1].update(zip(w, w[1:], w[2:]))
    want = {}
    for f in (0, 1):
        three = seen[f]
        two = Counter((b, c) for _, b, c in three)
        one = Counter(c for _, c in two)
        cut = {o: perplexity._discounts_of(*(sum(n == k for n in of.values()) for k in (1, 2, 3, 4))) for o, of in ((3, three), (2, two), (1, one))}

        def tail(of, d):
            total, mass = Counter(), Counter()
            for g, n in of.items():
                total[g[:-1]] += n
                mass[g[:-1]] += d[min(n, 3)]
            return total, mass

        t3, t2, t1 = tail(three, cut[3]), tail(two, cut[2]), tail({(c,): n for c, n in one.items()}, cut[1])

        def p(a, b, c):
            def step(n, d, of, context, lower):
                return (n - d[min(n, 3)] + of[1][context] * lower) / of[0][context] if of[0][context] else lower
            p1 = step(one[c], cut[1], t1, (), 1 / (len(one) + 1))
            return step(three[a, b, c], cut[3], t3, (a, b), step(two[b, c], cut[2], t2, (b,), p1)), p1

        for i, t in enumerate(texts):
            if samples.words(t) and 7 * i & 1 != f:
                w = [1, 0, *samples.words(t)]
                got = [p(*g) for g in zip(w, w[1:], w[2:])]
                want[7 * i] = (-np.mean([np.log2(x) for x, _ in got]), np.mean([np.log2(x / y) for x, y in got]))
    monkeypatch.setattr(perplexity, "COUNT_SLICES", 2)
    for rows, slices, often in ((1 << 60, 1, 1000), (0, 3, 10**9), (0, 2, 1)):
        monkeypatch.setattr(perplexity, "SLICES", slices)
        monkeypatch.setattr(perplexity, "SLICE_ROWS", rows)
        monkeypatch.setattr(perplexity, "OFTEN", often)
        got = {r.key: (r.bits, r.gain) for r in perplexity.word_scores(docs).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9) for k in want)
    big = [" ".join(rng.choice(voc) for _ in range(4000)) for _ in range(10)]
    size = lambda k, slices: sum(len(r.block) for r in perplexity._asked(
        spark.createDataFrame(list(enumerate(big)), "text_key long, __text string"), k, slices, np.zeros(0, np.uint64)).collect())
    whole = size(0, 1)
    assert whole < 40_000 * 24
    assert all(size(k, 14) < whole / 3 for k in (0, 13))


def test_toxicity_thresholds_come_from_all_labelled_rows(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(toxicity.FUNCTION_WORDS["en" if i % 4 else "de"] + (("vile",) if i % 3 == 0 else ("nice",))) for _ in range(30))
             for i in range(120)]
    docs = samples.frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    counted, cuts = [], toxicity.cuts
    monkeypatch.setattr(toxicity, "cuts", lambda seen, config: counted.append(seen) or cuts(seen, config))
    toxicity.train(docs, labels, F.col("doc_id") < 100, toxicity.TrainConfig(rows=40, max_words=1000, visits=200))
    assert sum(counted[0].values()) == 100 and sum(n for (*_, label), n in counted[0].items() if label) == 34
    assert {lang for lang, *_ in counted[0]} == {0, 1}


def test_toxicity_thresholds_shrink_smoothly():
    config = toxicity.TrainConfig()
    at = lambda n: Counter({(0, 100, 1): 400, (0, -100, 0): 400, (1, 300, 1): n, (1, 200, 0): 10 * n})
    few, more, many = (toxicity.cuts(at(n), config) for n in (1, 14, 400))
    assert few["fr"] == few[""] and few["de"] != few[""]
    own = toxicity._cut(Counter({(300, 1): 1, (200, 0): 10}))
    assert abs(own - many["de"]) < abs(own - more["de"]) < abs(own - few["de"])
