"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of the embeddings of its hash and of the hashes of its first four and five bytes, so that
unseen endings of a known stem still count. Filters of several widths slide over the words, the maximum of each filter
over the whole text goes through one logistic unit. Learning uses a bounded, seeded sample of the labelled rows
(``TrainConfig.rows``); scoring covers every whole text. The decision threshold is calibrated by language, told from
function words in the text itself, and the score is shifted so that each language's threshold stands at ``THRESHOLD``.
The thresholds come from the scores of all labelled rows that may be learned from, counted exactly by language, label and
``1 / GRID`` of a logit: rows of the sample are scored by models that haven't seen them (``TrainConfig.folds``), all others
by Spark. A language's threshold is drawn towards that of all rows, the less toxic rows it has (``TrainConfig.drawn``).

Defined cases: a null or empty text is scored like a text without words; without labelled rows of both classes every
score is the share of positives (0.0 without any row). Repeated labels of one document: the largest counts. Null labels
teach nothing. Repeated document rows are scored row by row; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import arrow_map, crc_mod, map_batches, maybe_broadcast, one_text, table
from hirelens.llm.textops import Words, words_of

THRESHOLD = 0.3
# Frequent function words by which a text's language is told for the threshold.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "in", "that", "is", "was", "for", "with"),
    "de": ("der", "die", "und", "das", "den", "ist", "mit", "von", "auf", "nicht"),
    "fr": ("le", "et", "les", "des", "une", "est", "dans", "que", "pour", "par"),
    "es": ("el", "los", "las", "del", "y", "una", "por", "con", "que", "para"),
}
_SEPARATORS = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
BUCKETS = 1 << 20
GRID = 100


@dataclass
class TrainConfig:
    rows: int = 5000          # at most so many labelled documents are learned from
    max_words: int = 20_000   # longer ones are left out of the sample
    dim: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8          # of each width
    epochs: int = 8           # at least, and so many that ``visits`` documents are seen
    visits: int = 24_000
    batch: int = 64
    rate: float = 0.05
    least_docs: int = 3       # buckets in fewer sample documents have no embedding
    seed: int = 7
    folds: int = 4            # of the sample, for thresholds
    drawn: float = 15.0       # at so many toxic rows, a language's own threshold counts half


@dataclass
class ToxicityModel:
    config: TrainConfig
    slot: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.int32))  # bucket -> embedding row, 0: none
    embed: np.ndarray = field(default_factory=lambda: np.zeros((1, 1), np.float32))
    filters: list[np.ndarray] = field(default_factory=list)  # by width: (width, dim, filters)
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    offset: float = 0.0
    cuts: dict[str, float] = field(default_factory=dict)  # logit threshold by language; "": any other
    constant: float | None = None


def _buckets(w: Words) -> np.ndarray:
    """(words, 3) buckets: the word, its first four bytes, its first five bytes."""
    shift = np.uint64(44)
    salt = np.array([0x1357, 0x2468, 0x3579], np.uint64)
    return np.stack([(h * (salt[k] * np.uint64(2) + np.uint64(1))) >> shift for k, h in enumerate(
        (w.hashes, w.prefix_hashes(4), w.prefix_hashes(5)))], axis=1).astype(np.int32)


def _language_hashes() -> dict[str, np.ndarray]:
    out = {}
    for lang, words in FUNCTION_WORDS.items():
        raw = " ".join(words).encode()
        out[lang] = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), separators=_SEPARATORS).hashes
    return out


def _languages(w: Words) -> np.ndarray:
    """Index into FUNCTION_WORDS of each text's language, -1 where no function word occurs."""
    hits = np.stack([np.diff(np.concatenate(([0], np.cumsum(np.isin(w.hashes, hs))))[w.first])
                     for hs in _language_hashes().values()], axis=1)
    return np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), -1)


def _lay_out(rows: np.ndarray, first: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word slots with ``pad`` empty rows after each text: (slots, start of each text)."""
    counts = np.diff(first)
    starts = first[:-1] + pad * np.arange(len(counts))
    out = np.zeros((len(rows) + pad * len(counts), rows.shape[1]), np.int32)
    out[np.arange(len(rows)) + np.repeat(pad * np.arange(len(counts)), counts)] = rows
    return out, starts


def _pooled(m: ToxicityModel, slots: np.ndarray, starts: np.ndarray, where: bool = False):
    """Maximum of every filter over every text; with ``where``, also the places of the maxima."""
    emb = m.embed[slots[:, 0]] + m.embed[slots[:, 1]] + m.embed[slots[:, 2]]
    best, at = [], []
    n = len(emb)
    for kernel in m.filters:
        conv = emb @ kernel[0]
        for o in range(1, len(kernel)):
            conv[: n - o] += emb[o:] @ kernel[o]
        best.append(np.maximum.reduceat(conv, starts, axis=0))
        if where:
            ends = np.append(starts[1:], n)
            at.append(np.stack([conv[a:b].argmax(axis=0) + a for a, b in zip(starts, ends)]))
    pooled = np.maximum(np.concatenate(best, axis=1) + m.bias, 0)
    return (pooled, np.concatenate(at, axis=1), emb) if where else pooled


def _logits(m: ToxicityModel, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    slots, starts = _lay_out(m.slot[rows], first, max(m.config.widths))
    return _pooled(m, slots, starts) @ m.weights + m.offset


def fit(rows: list[np.ndarray], langs: np.ndarray, labels: np.ndarray, config: TrainConfig) -> tuple[ToxicityModel, Counter]:
    """Train on buckets by document; with it how often (language, bin, label) occurs among the sample's scores out of fold."""
    if len(labels) < 10 or labels.min() == labels.max():
        return ToxicityModel(config, constant=float(labels.mean()) if len(labels) else 0.0), Counter()
    shuffled = np.random.default_rng(config.seed).permutation(len(labels))
    dealt = shuffled[np.argsort(labels[shuffled], kind="stable")]  # each fold has its share of either label
    seen: Counter = Counter()
    for k in range(config.folds):
        held = dealt[k:: config.folds]
        if not len(held):
            continue
        m = _learn(rows, labels, np.sort(np.setdiff1d(dealt, held)), config)
        first = np.concatenate(([0], np.cumsum([len(rows[i]) for i in held])))
        z = _logits(m, np.concatenate([rows[i] for i in held]), first)
        seen.update(zip(langs[held].tolist(), _bins(z).tolist(), labels[held].astype(int).tolist()))
    return _learn(rows, labels, np.arange(len(labels)), config), seen


def _bins(z: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(z, -60, 60) * GRID).astype(np.int32)


def _learn(rows: list[np.ndarray], labels: np.ndarray, learn: np.ndarray, config: TrainConfig) -> ToxicityModel:
    """Train on the documents ``learn``."""
    m = ToxicityModel(config)
    rng = np.random.default_rng(config.seed)
    df = np.zeros(BUCKETS, np.int32)
    for i in learn:
        df[np.unique(rows[i])] += 1
    kept = np.flatnonzero(df >= config.least_docs)
    m.slot[kept] = np.arange(1, len(kept) + 1)
    m.embed = rng.normal(0, 0.1, (len(kept) + 1, config.dim)).astype(np.float32)
    m.embed[0] = 0
    m.filters = [rng.normal(0, 0.5, (w, config.dim, config.filters)).astype(np.float32) for w in config.widths]
    total = config.filters * len(config.widths)
    m.bias = np.zeros(total, np.float32)
    m.weights = rng.normal(0, 0.3, total).astype(np.float32)
    positives = np.clip(labels[learn].mean(), 1e-3, 1 - 1e-3)
    m.offset = float(np.log(positives / (1 - positives)))
    seen = [np.zeros_like(m.embed), *[np.zeros_like(k) for k in m.filters], np.zeros_like(m.bias), np.zeros_like(m.weights)]

    def step(x, g, cache, at=...):
        cache[at] += g * g
        x[at] -= config.rate * g / np.sqrt(cache[at] + 1e-8)

    for _ in range(max(config.epochs, -(-config.visits // len(learn)))):
        rng.shuffle(learn)
        for a in range(0, len(learn), config.batch):
            some = learn[a: a + config.batch]
            first = np.concatenate(([0], np.cumsum([len(rows[i]) for i in some])))
            slots, starts = _lay_out(m.slot[np.concatenate([rows[i] for i in some])], first, max(config.widths))
            pooled, at, emb = _pooled(m, slots, starts, True)
            p = 1 / (1 + np.exp(-(pooled @ m.weights + m.offset)))
            d = ((p - labels[some]) / len(some)).astype(np.float32)
            up = d[:, None] * m.weights * (pooled > 0)
            g_embed_at, g_embed = [], []
            k = 0
            for j, kernel in enumerate(m.filters):
                place, g = at[:, k: k + config.filters], up[:, k: k + config.filters]
                g_kernel = np.empty_like(kernel)
                for o in range(len(kernel)):
                    near = np.minimum(place + o, len(emb) - 1)
                    g_kernel[o] = np.einsum("bfd,bf->df", emb[near], g)
                    g_embed_at.append(near.ravel())
                    g_embed.append((g[:, :, None] * kernel[o].T[None]).reshape(-1, config.dim))
                step(kernel, g_kernel + 1e-4 * kernel, seen[1 + j])
                k += config.filters
            step(m.weights, pooled.T @ d + 1e-4 * m.weights, seen[-1])
            step(m.bias, up.sum(axis=0), seen[-2])
            m.offset -= config.rate * float(d.sum())
            place, g = np.concatenate(g_embed_at), np.concatenate(g_embed)
            touched, back = np.unique(slots[place].ravel(), return_inverse=True)
            sums = np.zeros((len(touched), config.dim), np.float32)
            np.add.at(sums, back, np.repeat(g, 3, axis=0))
            if touched[0] == 0:
                touched, sums = touched[1:], sums[1:]
            step(m.embed, sums + 1e-4 * m.embed[touched], seen[0], touched)
    return m


def cuts(seen: Counter, config: TrainConfig) -> dict[str, float]:
    """The logit threshold of each language and ("") of all rows, from counts by (language, bin, label)."""
    pooled: Counter = Counter()
    for (_, at, label), n in seen.items():
        pooled[at, label] += n
    out = {"": _cut(pooled)}
    for k, lang in enumerate(FUNCTION_WORDS):
        own = Counter({(at, label): n for (of, at, label), n in seen.items() if of == k})
        toxic = sum(n for (_, label), n in own.items() if label)
        share = toxic / (toxic + config.drawn)
        out[lang] = share * _cut(own) + (1 - share) * out[""] if toxic else out[""]
    return out


def _cut(counts: Counter) -> float:
    """The logit threshold of the best F1, in the middle of its gap, from counts by (bin, label)."""
    at = np.array(sorted({a for a, _ in counts}, reverse=True))
    hits, others = (np.cumsum([counts[a, label] for a in at.tolist()]) for label in (1, 0))
    if not len(at) or not hits[-1] or not others[-1]:
        return 0.0
    i = int((2 * hits / (hits + others + hits[-1])).argmax())
    return float((at[i] + at[i + 1] + 1) / 2 / GRID) if i + 1 < len(at) else float(at[i] / GRID - 1)


def predict(m: ToxicityModel, w: Words) -> np.ndarray:
    """Score of each text."""
    n = len(w.offs) - 1
    if m.constant is not None:
        return np.full(n, m.constant)
    cuts = np.array([m.cuts.get(lang, m.cuts[""]) for lang in FUNCTION_WORDS] + [m.cuts[""]])
    z = _logits(m, _buckets(w), w.first) - cuts[_languages(w)] + np.log(THRESHOLD / (1 - THRESHOLD))
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, config: TrainConfig | None = None, label_col: str = "toxic",
          id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learn from the labelled documents for which ``may_learn`` (over ``labels``) holds."""
    config = config or TrainConfig()
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & may_learn)
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    chosen = known.orderBy(F.xxhash64(F.col("id"), F.lit(config.seed)), "id").limit(config.rows)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(maybe_broadcast(chosen, config.rows), "id")
    sample = one_text(sample, ["id", "label"], "text")

    def run(batch: pa.RecordBatch):
        for i, j, w in words_of(batch["text"], lower=True, separators=_SEPARATORS):
            keep = np.flatnonzero(w.counts() <= config.max_words)
            rows, langs = _buckets(w), _languages(w)
            yield {"id": batch["id"].slice(i, j - i).take(pa.array(keep)), "label": batch["label"].slice(i, j - i).take(pa.array(keep)),
                   "lang": langs[keep].astype(np.int32),
                   "buckets": pa.array([rows[w.first[k]: w.first[k + 1]].tobytes() for k in keep], pa.binary())}

    got = arrow_map(sample.select("id", "label", "text"), run,
                    f"id {docs.schema[id_col].dataType.simpleString()}, label int, lang int, buckets binary").toArrow()
    got = sorted(zip(got["id"].to_pylist(), got["buckets"].to_pylist(), got["lang"].to_pylist(), got["label"].to_pylist()))
    model, seen = fit([np.frombuffer(x[1], np.int32).reshape(-1, 3) for x in got], np.array([x[2] for x in got]),
                      np.array([x[3] for x in got], np.float32), config)
    if model.constant is None:
        model.cuts = cuts(seen + _count_others(docs, known, chosen, model, id_col, text_col), config)
    return model


def _count_others(docs: DataFrame, known: DataFrame, chosen: DataFrame, model: ToxicityModel, id_col: str, text_col: str) -> Counter:
    """How often (language, bin, label) occurs among the labelled rows that the model hasn't learned from."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        for i, j, w in words_of(batch.column(1), lower=True, separators=_SEPARATORS):
            yield {"id": batch.column(0).slice(i, j - i), "lang": _languages(w).astype(np.int32),
                   "bin": _bins(_logits(sent.value, _buckets(w), w.first)), "words": w.counts()}

    kind = docs.schema[id_col].dataType.simpleString()
    scored = arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, lang int, bin int, words long")
    others = known.join(chosen.select("id", F.lit(True).alias("learned")), "id", "left")
    met = scored.join(others, "id").where(F.col("learned").isNull() | (F.col("words") > model.config.max_words))
    return Counter({(r.lang, r.bin, r.label): r.n for r in met.groupBy("lang", "bin", "label").agg(F.count("*").alias("n")).collect()})


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        for i, j, w in words_of(batch.column(1), lower=True, separators=_SEPARATORS):
            p = predict(sent.value, w)
            yield {"id": batch.column(0).slice(i, j - i), "score": p, "predicted": (p >= THRESHOLD).astype(np.int32)}

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run,
                     f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model doesn't hold toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            good = [predict(sent.value, w) < THRESHOLD
                    for _, _, w in words_of(batch.column(at), lower=True, separators=_SEPARATORS)]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return map_batches(docs, run, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; documents with crc32(doc_id) mod 4 = 2 are held out of learning."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, crc_mod(F.col("doc_id"), 4) != 2)
    return score(docs, model).select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
