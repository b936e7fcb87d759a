"""Profile-versus-posting matching as set operations over tables.

Skill sets are arrays bounded by the lexicon size, so per-id arrays never
grow with the data. Texts are matched row by row (never concatenated per id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import taxonomy as tx
from ..functions.expr import ColumnOrName, col
from .lexicon import matched_words


def skill_sets(df: DataFrame, id_col: str, text: str, lexicon: Sequence[str], out: str = "skills",
               mode: str = "substring") -> DataFrame:
    """Per id: sorted distinct lexicon words found in any of its rows.

    ``collect_set`` holds at most ``len(lexicon)`` values per id, merged
    partially on the map side.
    """
    lowered = df.select(F.col(id_col), F.lower(F.col(text)).alias("_t"))
    hits = lowered.select(F.col(id_col), F.explode(matched_words("_t", lexicon, mode, lowered=True)).alias("_w"))
    return hits.groupBy(id_col).agg(F.sort_array(F.collect_set("_w")).alias(out))


def parse_skill_list(c: ColumnOrName, sep: str = ",") -> Column:
    """'a, b ,c' → ['a', 'b', 'c'] (lower-cased, trimmed, blanks dropped) (P5)."""
    parts = F.transform(F.split(col(c), sep), lambda s: F.lower(F.trim(s)))
    return F.array_distinct(F.filter(parts, lambda s: s != ""))


def joined(c: ColumnOrName) -> Column:
    """Sorted, comma-joined rendering of a skill array."""
    return F.array_join(F.sort_array(col(c)), ",")


def skill_gap(pairs: DataFrame, have: str = "have", required: str = "required",
              preferred: str | None = "preferred") -> DataFrame:
    """Matched / missing critical / missing preferred per pair."""
    empty = F.array().cast("array<string>")
    h = F.coalesce(F.col(have), empty)
    r = F.coalesce(F.col(required), empty)
    out = (pairs.withColumn("matched", F.array_sort(F.array_intersect(r, h)))
           .withColumn("missing_critical", F.array_sort(F.array_except(r, h))))
    if preferred:
        p = F.coalesce(F.col(preferred), empty)
        out = out.withColumn("missing_preferred", F.array_sort(F.array_except(p, h)))
    return out


def match_score(gap: DataFrame, required: str = "required", bands=tx.MATCH_BANDS,
                default_band: str = tx.MATCH_BAND_DEFAULT) -> DataFrame:
    """score = |matched| / |required| (NULL when nothing is required) and its band."""
    n_req = F.size(F.coalesce(F.col(required), F.array().cast("array<string>")))
    score = F.when(n_req > 0, F.size("matched").cast("double") / n_req)
    band = None
    for threshold, label in bands:
        cond = score >= F.lit(threshold)
        band = F.when(cond, F.lit(label)) if band is None else band.when(cond, F.lit(label))
    band = band.otherwise(F.when(score.isNotNull(), F.lit(default_band))) if band is not None else F.lit(default_band)
    return gap.withColumn("match_score", F.round(score, 4)).withColumn("match_band", band)


def learning_path(gap: DataFrame, id_col: str, market: DataFrame, skill_col: str = "skill",
                  rank_col: str = "demand_rank", missing: Sequence[str] = ("missing_critical",),
                  priority_bands: Sequence[tuple[int, str]] = ((5, "high"), (10, "medium")),
                  default_priority: str = "low") -> DataFrame:
    """Every missing skill, ordered by market demand.

    Skills that the market does not rank come last, by name, with the default priority.
    """
    ranks = market.select(skill_col, rank_col)
    arrs = [F.coalesce(F.col(m), F.array().cast("array<string>")) for m in missing]
    allm = F.array_distinct(F.concat(*arrs)) if len(arrs) > 1 else arrs[0]
    m = gap.select(F.col(id_col), F.explode(allm).alias(skill_col))
    j = m.join(ranks, skill_col, "left")
    pr = None
    for limit, label in priority_bands:
        cond = F.col(rank_col) <= limit
        pr = F.when(cond, F.lit(label)) if pr is None else pr.when(cond, F.lit(label))
    pr = pr.otherwise(F.lit(default_priority)) if pr is not None else F.lit(default_priority)
    w = Window.partitionBy(id_col).orderBy(F.col(rank_col).asc_nulls_last(), F.col(skill_col))
    return j.select(F.col(id_col), F.col(skill_col), F.col(rank_col).cast("long").alias(rank_col),
                    pr.alias("priority"), F.row_number().over(w).cast("long").alias("step"))


def role_readiness(people: DataFrame, id_col: str, skills: str, role_col: str, role_top: DataFrame,
                   top_role_col: str = "role_cluster", top_skill_col: str = "skill", rank_col: str = "role_rank",
                   top_n: int = 20) -> DataFrame:
    """0–100 coverage of the target role's ``top_n`` skills by a person's skills (P5).

    ``role_top`` holds one row per (role, skill) with its rank in the role; the
    skills ranked up to ``top_n`` become one bounded array per role.
    """
    tops = role_top.where(F.col(rank_col) <= top_n).groupBy(top_role_col).agg(F.sort_array(F.collect_set(top_skill_col)).alias("_top"))
    j = people.join(tops, people[role_col] == tops[top_role_col], "left")
    top = F.coalesce(F.col("_top"), F.array().cast("array<string>"))
    have = F.coalesce(F.col(skills), F.array().cast("array<string>"))
    covered = F.array_intersect(top, have)
    score = F.when(F.size(top) > 0, F.round(F.lit(100.0) * F.size(covered) / F.size(top), 0))
    return j.select(F.col(id_col), F.col(role_col), F.size(covered).cast("long").alias("covered"),
                    F.size(top).cast("long").alias("top_n"), score.alias("readiness"),
                    F.array_join(F.array_sort(F.array_except(top, have)), ",").alias("to_learn"))
