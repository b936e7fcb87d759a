"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled reference text is built. A text is parsed greedily into the longest
phrases that occur in the reference; a symbol that occurs nowhere in it is a phrase of its own. The language whose
reference needs the fewest phrases, normalised as phrases * log2(reference length) / text length, wins; ties go to the
smaller name by code point.

Symbols are the bytes of letters (A-Z folded, two-byte capitals of Latin-1 folded too); each run of anything else is one
blank. Texts are parsed in runs of ``RUN`` symbols, each run starting anew, so that all runs of a batch advance through
the automata in step: one numpy gather per symbol for many texts and languages. All symbols of a text take part.

References are a documented, bounded, seeded sample (``chars_per_language``, ``total_chars``) of whole documents. A null
text and a text without letters are ``und`` with score 0.0; so is every text if nothing can be learned. Repeated rows
are predicted row by row; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import arrow_map, crc_mod, maybe_broadcast, one_text, table
from hirelens.llm.textops import runs, text_bytes

RUN = 1024
UNKNOWN = "und"
BLANK = 0


def symbols(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, offsets): letters' bytes folded, one BLANK per run of other bytes."""
    out = np.zeros(len(raw), np.uint8)
    upper, lower, high = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122), raw >= 128
    out[upper] = raw[upper] + 32
    out[lower] = raw[lower]
    out[high] = raw[high]
    if high.any():
        after = np.flatnonzero(raw[:-1] == 0xC3) + 1
        after = after[(raw[after] >= 0x80) & (raw[after] <= 0x9E)]
        out[after] += 32
    keep = np.ones(len(raw), bool)
    keep[1:] = (out[1:] != BLANK) | (out[:-1] != BLANK)
    starts = offs[:-1][offs[:-1] < len(raw)]
    keep[starts] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], total[offs]


class Automaton:
    """Suffix automaton of a symbol sequence, built online (Blumer et al.)."""

    def __init__(self, text: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur


@dataclass
class LanguageModel:
    """Automata as one flat table: entry = 4 * (place of the next state's row) + phrases that the step completes."""

    languages: list[str]
    log_size: np.ndarray   # log2 of each reference's length
    code: np.ndarray       # byte -> column
    width: int
    roots: np.ndarray      # place of each language's root row
    steps: np.ndarray


def build(references: dict[str, np.ndarray]) -> LanguageModel:
    languages = sorted(k for k, v in references.items() if len(v))
    used = np.unique(np.concatenate([references[k] for k in languages])) if languages else np.zeros(0, np.uint8)
    code = np.full(256, len(used), np.int64)  # the last column: bytes of no reference
    code[used] = np.arange(len(used))
    width = len(used) + 1
    tables, roots, base = [], [], 0
    for lang in languages:
        states = Automaton(code[references[lang]].tolist()).next
        root = np.full(width, base * 4 + 1, np.int64)  # an unknown symbol is a phrase
        for c, s in states[0].items():
            root[c] = (base + s * width) * 4
        step = np.tile(root + 1, (len(states), 1))  # a miss ends the phrase before it
        step[0] = root
        at = [(s, c, t) for s, nxt in enumerate(states) for c, t in nxt.items()]
        s, c, t = np.array(at, np.int64).T
        step[s, c] = (base + t * width) * 4
        tables.append(step.ravel())
        roots.append(base)
        base += len(states) * width
    steps = np.concatenate(tables) if tables else np.zeros(0, np.int64)
    return LanguageModel(languages, np.array([np.log2(max(2, len(references[k]))) for k in languages]), code, width,
                         np.array(roots, np.int64), steps.astype(np.int32) if base < 2**28 else steps)


def phrases(m: LanguageModel, syms: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(texts, languages) phrase counts of the greedy parse."""
    n, k = len(offs) - 1, len(m.languages)
    coded = m.code[syms]
    sizes = np.diff(offs)
    pieces = (sizes + RUN - 1) // RUN
    text = np.repeat(np.arange(n), pieces)
    part = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = offs[:-1][text] + part * RUN
    size = np.minimum(RUN, offs[1:][text] - start)
    order = np.argsort(-size, kind="stable")
    start, size, text = start[order], size[order], text[order]
    state = np.tile(m.roots, (len(start), 1))
    count = np.zeros((len(start), k), np.int32)
    live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    for t, a in enumerate(live.tolist()):
        got = m.steps[state[:a] + coded[start[:a] + t][:, None]]
        count[:a] += got & 3
        state[:a] = got >> 2
    count += state != m.roots  # the last phrase of a run
    out = np.zeros((n, k), np.int64)
    np.add.at(out, text, count)
    return out


def predict(m: LanguageModel, raw: np.ndarray, offs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text; score = runner-up's cost / (best cost + runner-up's cost), 1 with one language."""
    n = len(offs) - 1
    syms, at = symbols(raw, offs)
    letters = np.concatenate(([0], np.cumsum(((raw >= 97) & (raw <= 122)) | ((raw >= 65) & (raw <= 90)))))[offs]
    lettered = np.diff(letters) > 0
    highs = np.diff(np.concatenate(([0], np.cumsum(raw >= 128)))[offs]) > 0
    for i in np.flatnonzero(~lettered & highs):
        lettered[i] = any(map(str.isalpha, raw[offs[i]: offs[i + 1]].tobytes().decode("utf-8")))
    if not m.languages:
        return [UNKNOWN] * n, np.zeros(n)
    cost = phrases(m, syms, at) * m.log_size / np.maximum(np.diff(at), 1)[:, None]
    best = cost.argmin(axis=1)
    if len(m.languages) > 1:
        two = np.partition(cost, 1, axis=1)[:, :2]
        score = two[:, 1] / np.maximum(two.sum(axis=1), 1e-12)
    else:
        score = np.ones(n)
    return [m.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)], np.where(lettered, score, 0.0)


def train(docs: DataFrame, may_learn: Column, chars_per_language: int = 40_000, total_chars: int = 400_000,
          docs_per_language: int = 80, longest: int = 4_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> LanguageModel:
    """References from documents in seeded order, up to the bounds: whole, or, of a document of more than ``longest``
    characters, a seeded span of that length, cut to whole words."""
    fit = docs.where(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id")
    chosen = (fit.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= docs_per_language))
    text = F.col(text_col)
    begin = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed + 1)), F.greatest(F.length(text) - longest, F.lit(1))).cast("int") + 1
    span = F.substring(text, begin, F.lit(longest))
    words = F.nullif(F.regexp_extract(span, r"(?s)^\S*\s(.*)\s\S*$", 1), F.lit(""))
    text = F.when(F.length(text) <= longest, text).otherwise(F.coalesce(words, span))
    texts = fit.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text.alias("text"))
    got = one_text(texts.join(maybe_broadcast(chosen), ["id", "lang"]), ["id", "lang", "place"], "text").toArrow().to_pylist()
    groups: dict[str, list[str]] = {}
    for row in sorted(got, key=lambda r: (r["lang"], r["place"], r["text"])):
        groups.setdefault(row["lang"], []).append(row["text"])
    bound = min(chars_per_language, total_chars // max(1, len(groups)))
    references = {}
    for lang, own in groups.items():
        size, some = 0, []
        for text in own:
            if size < bound:
                some.append(text)
                size += len(text)
        raw = np.frombuffer((" ".join(some)).encode("utf-8"), np.uint8)
        references[lang] = symbols(raw, np.array([0, len(raw)]))[0]
    return build(references)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        raw, offs = text_bytes(batch.column(1))
        for i, j in runs(offs, 1 << 20):
            lang, score = predict(sent.value, raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
            yield {"id": batch.column(0).slice(i, j - i), "lang_pred": pa.array(lang, pa.string()), "score": score}

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run,
                     f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; documents with crc32(doc_id) mod 4 = 2 are held out of learning."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, crc_mod(F.col("doc_id"), 4) != 2)
    return identify(docs, model).select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
