"""Lexicons given as tables: all their words are looked for in one pass over the texts.

A literal lexicon costs one ``contains`` a word and text, and its words travel in the plan. Here the words of a DataFrame
become an Aho-Corasick automaton, which reads a text once however many words there are. Words come to the tasks in sets of
about ``SET`` (dealt by hash); each set is one pass over the texts, so neither the driver nor a task holds more than a set.
Texts go to the workers as Arrow batches and stay where they are; only (kept columns, word) rows come back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from operator import itemgetter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import ColumnOrName, col

#: Words of one automaton.
SET = 100_000


def word_sets(lexicon: DataFrame, word: str = "skill", size: int = SET) -> Iterator[list[str]]:
    """The distinct trimmed lower-case words of ``lexicon``, in sets of about ``size``; blank and NULL words are left out."""
    words = lexicon.select(F.lower(F.trim(F.col(word).cast("string"))).alias("w")).where("w <> ''").distinct()
    n = max(1, math.ceil(words.count() / size))
    for i in range(n):
        part = words if n == 1 else words.where(F.pmod(F.xxhash64("w"), F.lit(n)) == i)
        yield [r.w for r in part.collect()]


def match_words(df: DataFrame, text: ColumnOrName, words: Sequence[str], keep: Sequence[ColumnOrName] = (), out: str = "skill",
                mode: str = "substring", listed: bool = False) -> DataFrame:
    """One row per (row, found word) for one set of lower-case words; ``text`` is lower-cased. NULL texts hold none.

    ``mode="word"``: no letter, digit or underscore on either side. ``listed``: one row per row with words, which are an array.
    """
    if mode not in ("substring", "word"):
        raise ValueError(f"unknown match mode {mode!r}")
    src = df.select(*[col(k) for k in keep], F.lower(col(text)).alias("_text"))
    kept = [f for f in src.schema.fields if f.name != "_text"]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.StringType()) if listed else T.StringType())])
    words, whole = list(words), mode == "word"

    def run(batches):
        import ahocorasick
        import numpy as np
        import pyarrow as pa

        automaton = ahocorasick.Automaton()
        for i, w in enumerate(words):
            automaton.add_word(w, (i, len(w)) if whole else i)
        automaton.make_automaton()
        every = pa.array(words, pa.string())
        inside = lambda c: c == "_" or c.isalnum()
        for batch in batches:
            rows, hits, ends = [], [], [0]
            for r, t in enumerate(batch["_text"]):
                t = t.as_py()
                if not t:
                    continue
                # substrings take no Python step a hit: frequent words have many
                found = set() if whole else set(map(itemgetter(1), automaton.iter(t)))
                for end, (i, n) in automaton.iter(t) if whole else ():
                    if not ((end >= n and inside(t[end - n])) or (end + 1 < len(t) and inside(t[end + 1]))):
                        found.add(i)
                if found:
                    rows += [r] * (1 if listed else len(found))
                    hits += sorted(found)
                    ends.append(len(hits))
            at = pa.array(np.array(rows, np.int64))
            got = every.take(pa.array(np.array(hits, np.int64)))
            got = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), got) if listed else got
            yield pa.RecordBatch.from_arrays([*[batch[f.name].take(at) for f in kept], got], names=[*[f.name for f in kept], out])

    if not words:
        return df.sparkSession.createDataFrame([], schema)
    return src.where(F.col("_text").isNotNull()).mapInArrow(run, schema)


def match_table(df: DataFrame, text: ColumnOrName, lexicon: DataFrame, word: str = "skill", keep: Sequence[ColumnOrName] = (),
                out: str = "skill", mode: str = "substring", size: int = SET, listed: bool = False) -> DataFrame:
    """One row per (row, word of ``lexicon`` found in it): the ``keep`` columns and ``out``; ``listed``: per row and set, an array."""
    found = None
    for words in word_sets(lexicon, word, size):
        part = match_words(df, text, words, keep, out, mode, listed)
        found = part if found is None else found.unionByName(part)
    return found
