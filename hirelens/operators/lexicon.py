"""Lexicon matching and lexicon demand (E2, P1, M9–M11 building blocks).

The posting pipeline expresses "which lexicon words occur in which text" as a
cross join of the lexicon with every text under a ``LIKE '%w%'`` predicate.
On Spark that plans as a BroadcastNestedLoopJoin. Here it is one pass over the
text instead: the hits ``[w for w in lexicon if contains(text, w)]`` are built
as one array of codegen'd ``contains`` tests and exploded by a single Generate —
no join, no shuffle, and the lexicon (bounded literals) travels with the plan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ColumnOrName, col, ratio_pct
from .automaton import match_table
from .stats import distinct_with_stats


def unique_words(words: Sequence[str]) -> list[str]:
    """Trim and de-duplicate, keeping first occurrence order."""
    seen, out = set(), []
    for w in words:
        w = w.strip()
        if w and w not in seen:
            seen.add(w)
            out.append(w)
    return out


def _word_pattern(w: str) -> str:
    return r"(?<![\p{L}\p{N}_])" + re.escape(w) + r"(?![\p{L}\p{N}_])"


def lexicon_frame(spark, json_array: str, out: str = "skill") -> DataFrame:
    """A lexicon given as a JSON array literal → one trimmed word per row."""
    one = spark.range(1).select(F.from_json(F.lit(json_array), "array<string>").alias("_a"))
    return one.select(F.explode("_a").alias("_w")).select(F.trim("_w").alias(out))


def matched_words(text: ColumnOrName, lexicon: Sequence[str], mode: str = "substring",
                  lowered: bool = False) -> Column:
    """array<string> of lexicon entries found in ``lower(text)``.

    ``mode="substring"`` is the pipeline's LIKE semantics (``java`` also hits
    ``javascript``); ``mode="word"`` requires non-word characters around a hit.
    """
    words = unique_words(w.lower() for w in lexicon)
    t = col(text) if lowered else F.lower(col(text))
    # One codegen'd test per word (no lambda), then drop the misses; the order
    # of the lexicon is kept. Equivalent to filter(lexicon, w -> contains(t, w)).
    if mode == "substring":
        return F.array_compact(F.array(*[F.when(F.contains(t, F.lit(w)), F.lit(w)) for w in words]))
    if mode == "word":
        return F.array_compact(F.array(*[F.when(t.rlike(_word_pattern(w)), F.lit(w)) for w in words]))
    raise ValueError(f"unknown match mode {mode!r}")


def lexicon_match(df: DataFrame, text: str, lexicon: Sequence[str] | DataFrame, keep: Sequence[ColumnOrName] = (),
                  out: str = "skill", min_len: int | None = 100, mode: str = "substring",
                  attrs: DataFrame | None = None, on: str | None = None, listed: bool = False) -> DataFrame:
    """One row per (input row, matched word): ``keep`` columns (+ ``attrs``) + ``out``.

    Rows with a NULL text or a text of ``min_len`` characters or fewer are
    skipped (the ``length > 100`` guard). Lower-casing happens once per row.

    When the row attributes live in another table (``attrs``, joined on
    ``on``), matching runs first on the text table and only ``(keep, words)``
    rows with at least one hit enter the join — the text never crosses a
    shuffle. A lexicon that is a table (its first column holds the words) is
    matched by an automaton instead of one test per word (``automaton``); with
    ``listed`` it gives the words of a row as an array (a row a set of words),
    so that joins move a row per text and not one per word.
    """
    src = df
    if min_len is not None:
        src = src.where(F.col(text).isNotNull() & (F.length(F.col(text)) > min_len))
    if isinstance(lexicon, DataFrame):
        found = match_table(src, text, lexicon, lexicon.columns[0], keep, out, mode, listed=listed)
        return found if attrs is None else found.join(attrs, on)
    if listed:
        raise ValueError("only a table lexicon gives arrays")
    src = src.select(*[col(k) for k in keep], F.lower(F.col(text)).alias("_text"))
    hits = matched_words("_text", lexicon, mode, lowered=True)
    kept = [F.col(c) for c in src.columns if c != "_text"]
    if attrs is None:
        return src.select(*kept, F.explode(hits).alias(out))
    words = src.select(*kept, F.explode(hits).alias(out))
    return words.join(attrs, on)


def text_hits(df: DataFrame, id_col: str, text: str, lexicons: Sequence[Sequence[str]], text_regex: str, keep: Sequence[str] = (),
              min_len: int = 100, mode: str = "substring") -> DataFrame:
    """One pass over the texts for several lexicons: id, ``keep``, ``_words`` (found words of all lexicons) and ``_text_hit``
    (the text matches ``text_regex``), for rows whose text is longer than ``min_len``. Written once, it serves every lexicon mart."""
    src = df.where(F.col(text).isNotNull() & (F.length(F.col(text)) > min_len)).select(
        F.col(id_col), *keep, F.lower(F.col(text)).alias("_text"))
    every = [w for lexicon in lexicons for w in lexicon]
    return src.select(id_col, *keep, matched_words("_text", every, mode, lowered=True).alias("_words"),
                      F.col("_text").rlike(text_regex).alias("_text_hit"))


def hit_words(lexicon: Sequence[str]) -> Column:
    """The words of one lexicon among ``_words``."""
    return F.array_intersect(F.array(*[F.lit(w) for w in unique_words(w.lower() for w in lexicon)]), F.col("_words"))


def lexicon_demand(matches: DataFrame, keys: Sequence[str], id_col: str, value_col: str | None = None,
                   count_name: str = "job_count", avg_name: str | None = "avg_salary",
                   median_name: str | None = "median_salary", level_col: str | None = None,
                   senior_values: Sequence[str] = (), senior_name: str | None = "senior_count",
                   min_count: int = 10, min_inclusive: bool = False, rank_name: str = "demand_rank",
                   rank_within: Sequence[str] = (), once: str | None = None) -> DataFrame:
    """Aggregate matches per key: distinct ids, pay stats, senior count, rank.

    Keeps groups with ``count > min_count`` (or ``>=`` when ``min_inclusive``)
    and ranks them by count (``rank()``, ties share a rank) within
    ``rank_within``. ``count(distinct id)`` is exact and the median is the
    exact interpolated one (see ``stats.distinct_with_stats``, also for ``once``).
    The rank window runs on the aggregated frame, whose size is bounded by the
    lexicon size times the number of ``rank_within`` groups.
    """
    g = distinct_with_stats(
        matches, keys, id_col, value_col, count_name=count_name,
        avg_name=avg_name if value_col else None,
        quantiles={median_name: 0.5} if (value_col and median_name) else None,
        counts={senior_name: F.col(level_col).isin(list(senior_values))} if (level_col and senior_name) else None, once=once)
    keep = (F.col(count_name) >= min_count) if min_inclusive else (F.col(count_name) > min_count)
    w = Window.partitionBy(*rank_within).orderBy(F.col(count_name).desc())
    return g.where(keep).withColumn(rank_name, F.rank().over(w).cast("long"))


def topic_cooccurrence(df: DataFrame, id_col: str, text: str, value_col: str, lexicon: Sequence[str],
                       text_regex: str, title: str | None = None, title_regex: str | None = None,
                       min_len: int = 100, min_count: int = 3, attrs: DataFrame | None = None,
                       count_name: str = "ai_job_count", median_name: str = "median_salary",
                       pct_name: str = "pct_of_ai_jobs", rank_name: str = "skill_rank",
                       mode: str = "substring", hits: DataFrame | None = None) -> DataFrame:
    """Which lexicon words occur in rows passing a topic gate, and their share.

    Gate: text present, longer than ``min_len``, and text matches
    ``text_regex`` OR title matches ``title_regex``. The text-side work (gate
    regex and word matching) is one narrow pass over the text table; only
    ``(id, text_hit, words)`` rows meet ``attrs`` (title, value) in the join.
    The denominator (distinct ids passing the gate) comes out of the same
    aggregation as the per-word counts. ``hits`` (see ``text_hits``) replaces
    the pass over the texts.
    """
    if hits is not None:
        narrow = hits.select(id_col, *[c for c in (title, value_col) if c], "_text_hit", hit_words(lexicon).alias("_words"))
        return _cooccurrence(narrow, id_col, value_col, title, title_regex, min_count, count_name, median_name, pct_name, rank_name)
    present = F.col(text).isNotNull() & (F.length(F.col(text)) > min_len)
    carry = [c for c in (title, value_col) if c and c in df.columns and c != id_col]
    src = df.where(present).select(F.col(id_col), *carry, F.lower(F.col(text)).alias("_text"))
    narrow = src.select(F.col(id_col), *carry, F.col("_text").rlike(text_regex).alias("_text_hit"),
                        matched_words("_text", lexicon, mode, lowered=True).alias("_words"))
    if attrs is not None:
        narrow = narrow.join(attrs, id_col)
    return _cooccurrence(narrow, id_col, value_col, title, title_regex, min_count, count_name, median_name, pct_name, rank_name)


def _cooccurrence(narrow: DataFrame, id_col: str, value_col: str, title: str | None, title_regex: str | None, min_count: int,
                  count_name: str, median_name: str, pct_name: str, rank_name: str) -> DataFrame:
    gate = F.col("_text_hit")
    if title and title_regex:
        gate = gate | F.coalesce(F.lower(F.col(title)).rlike(title_regex), F.lit(False))
    gated = narrow.where(gate).select(F.col(id_col), F.col(value_col), "_words")
    # One pass: every gated row also lands in a NULL-word group whose distinct
    # count is the denominator, so the text side is never evaluated twice.
    with_total = F.concat(F.col("_words"), F.array(F.lit(None).cast("string")))
    m = gated.select(F.col(id_col), F.col(value_col), F.explode(with_total).alias("skill"))
    g = distinct_with_stats(m, ["skill"], id_col, value_col, count_name=count_name,
                            quantiles={median_name: 0.5})
    # The aggregated frame has at most len(lexicon) + 1 rows: a global window is cheap.
    g = g.withColumn("_total", F.max(F.when(F.col("skill").isNull(), F.col(count_name))).over(Window.partitionBy()))
    g = g.where(F.col("skill").isNotNull() & (F.col(count_name) >= min_count))
    w = Window.orderBy(F.col(count_name).desc())
    return g.select("skill", count_name, median_name,
                    ratio_pct(count_name, "_total", 1).alias(pct_name),
                    F.rank().over(w).cast("long").alias(rank_name))
