"""Quality classifier: a sparse ensemble of rules over text statistics.

Small regression trees, boosted on a bounded, seeded sample of labelled documents, give one conjunctive rule per node
(the tests on the path to it). A logistic model with a lasso penalty picks and weighs the rules; the penalty is chosen on
a fifth of the sample. The chosen rules are compiled into Spark column expressions over the statistics, so scoring is a
sum of CASE expressions that Catalyst sees.

Defined cases: a null or empty text has all statistics 0 and is scored by them; without labelled rows of both classes
every score is the share of positives (0.0 without any row). Repeated labels of one document: the largest counts. Null
labels teach nothing. Repeated document rows are scored row by row; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import arrow_map, crc_mod, maybe_broadcast, one_text, table
from hirelens.llm.textops import words_of
from hirelens.llm.textstats import STATS, quality_stats

THRESHOLD = 0.3

Test = tuple[int, bool, float]  # statistic, whether above, cut: "x > cut" or "x <= cut"


@dataclass
class RuleConfig:
    rows: int = 4000      # at most so many labelled documents are learned from
    trees: int = 20
    depth: int = 3
    cuts: int = 24        # candidate cuts of a statistic
    shrink: float = 0.3
    share: float = 0.5    # of the rows for each tree
    least: int = 10       # rows in a leaf
    steps: int = 120      # of the lasso solver
    seed: int = 7


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[tuple[Test, ...], float]] = field(default_factory=list)
    constant: float | None = None  # the score of every text where nothing could be learned

    def column(self) -> Column:
        """The score as a column expression over the columns of ``STATS``."""
        if self.constant is not None:
            return F.lit(self.constant)

        def holds(rule: tuple[Test, ...]) -> Column:
            return reduce(lambda a, b: a & b, [F.col(STATS[k]) > cut if above else F.col(STATS[k]) <= cut for k, above, cut in rule])

        z = reduce(lambda a, b: a + b, [F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _tree(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray], c: RuleConfig, path: tuple[Test, ...],
          found: dict[tuple[Test, ...], None], out: np.ndarray) -> None:
    """Grow from ``path``; adds the path of every node to ``found`` and leaves' means to ``out``."""
    if path:
        found.setdefault(tuple(sorted(path)))
    mean = y[rows].mean()
    best = (1e-12, None)
    if len(path) < c.depth and len(rows) >= 2 * c.least:
        own, total = y[rows] - mean, len(rows)
        for k, some in enumerate(cuts):
            if not len(some):
                continue
            bin_ = np.searchsorted(some, x[rows, k], side="left")
            n = np.cumsum(np.bincount(bin_, minlength=len(some) + 1))[:-1]
            s = np.cumsum(np.bincount(bin_, own, minlength=len(some) + 1))[:-1]
            ok = (n >= c.least) & (total - n >= c.least)
            gain = np.where(ok, s * s / np.maximum(n, 1) + s * s / np.maximum(total - n, 1), 0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (k, float(some[i])))
    if best[1] is None:
        out[rows] = mean
        return
    k, cut = best[1]
    above = x[rows, k] > cut
    _tree(x, y, rows[~above], cuts, c, (*path, (k, False, cut)), found, out)
    _tree(x, y, rows[above], cuts, c, (*path, (k, True, cut)), found, out)


def _holds(x: np.ndarray, rule: tuple[Test, ...]) -> np.ndarray:
    return reduce(np.logical_and, [(x[:, k] > cut) if above else (x[:, k] <= cut) for k, above, cut in rule])


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray, steps: int) -> np.ndarray:
    """Accelerated proximal gradient; the first column is the intercept, which is not penalised."""
    rate = 4 * len(y) / np.linalg.norm(a, 2) ** 2
    w = v = start
    t = 1.0
    for _ in range(steps):
        g = a.T @ (1 / (1 + np.exp(-(a @ v))) - y) / len(y)
        new = v - rate * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


def _loss(a: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    z = a @ w
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit(x: np.ndarray, y: np.ndarray, config: RuleConfig) -> RuleModel:
    """Rules and weights from statistics (rows x STATS) and 0/1 labels."""
    if len(y) < 10 or y.min() == y.max():
        return RuleModel(0.0, constant=float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(config.seed)
    cuts = []
    for k in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, k], np.linspace(0, 1, config.cuts + 2)[1:-1], method="lower"))
        higher = np.array([x[:, k][x[:, k] > v].min(initial=np.inf) for v in values])
        cuts.append(((values + higher) / 2)[np.isfinite(higher)])
    found: dict[tuple[Test, ...], None] = {}
    score = np.full(len(y), float(np.log(y.mean() / (1 - y.mean()))))
    for _ in range(config.trees):
        rest = y - 1 / (1 + np.exp(-score))
        rows = np.sort(rng.choice(len(y), max(2, int(config.share * len(y))), replace=False))
        own: dict[tuple[Test, ...], None] = {}
        _tree(x, rest, rows, cuts, config, (), own, np.zeros(len(y)))
        for rule in own:
            found.setdefault(rule)
        for rule in own:
            if len(rule) == config.depth:
                hit = _holds(x, rule)
                if hit.any():
                    p = 1 / (1 + np.exp(-score[hit]))
                    score[hit] += config.shrink * float(np.clip(rest[hit].sum() / max((p * (1 - p)).sum(), 1e-3), -4, 4))
    rules = list(found)
    if not rules:
        return RuleModel(0.0, constant=float(y.mean()))
    a = np.column_stack([np.ones(len(y)), *[_holds(x, r) for r in rules]]).astype(float)
    order = rng.permutation(len(y))
    check, learn = order[: len(y) // 5], order[len(y) // 5:]
    most = np.abs(a[learn].T @ (y[learn] - y[learn].mean())).max() / len(learn)
    w, best = np.zeros(a.shape[1]), (np.inf, most)
    for penalty in most * np.logspace(-0.5, -3, 6):
        w = _lasso(a[learn], y[learn], penalty, w, config.steps)
        loss = _loss(a[check], y[check], w)
        if loss < best[0]:
            best = (loss, penalty)
    w = _lasso(a, y, best[1], w, 2 * config.steps)
    return RuleModel(float(w[0]), [(r, float(v)) for r, v in zip(rules, w[1:]) if abs(v) > 1e-6])


def with_stats(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the statistics of each whole text."""
    def run(batch: pa.RecordBatch):
        for i, j, w in words_of(batch["__text"]):
            yield {**{c: batch[c].slice(i, j - i) for c in keep}, **quality_stats(w)}

    ddl = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"{c} double" for c in STATS])
    return arrow_map(docs.select(*keep, F.col(text_col).alias("__text")), run, ddl)


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, config: RuleConfig | None = None, label_col: str = "quality",
          id_col: str = "doc_id", text_col: str = "text") -> RuleModel:
    """Learn from the labelled documents for which ``may_learn`` (over ``labels``) holds."""
    config = config or RuleConfig()
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & may_learn)
              .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__label"))
              .orderBy(F.xxhash64(F.col("__id"), F.lit(config.seed)), "__id").limit(config.rows))
    sample = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__own_text"))
              .join(maybe_broadcast(chosen, config.rows), "__id"))
    sample = one_text(sample, ["__id", "__label"], "__own_text")
    got = with_stats(sample, ["__id", "__label"], "__own_text").toPandas().sort_values(["__id", *STATS])
    return fit(got[list(STATS)].to_numpy(float), got["__label"].to_numpy(float), config)


def score(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    stats = with_stats(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__own_text")), ["__id"], "__own_text")
    return (stats.select(F.col("__id").alias(id_col), model.column().alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; documents with crc32(doc_id) mod 5 = 0 are held out of learning."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, crc_mod(F.col("doc_id"), 5) != 0)
    return score(docs, model).select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
