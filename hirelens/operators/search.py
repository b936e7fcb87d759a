"""The best postings of each profile by match score (P2, P3), without comparing all pairs.

Score: the share of a posting's required skills that the profile has. It depends on the two skill sets alone, so sets
become bit masks (bit 0 is the skill that the fewest postings require) and equal sets become classes; a posting class keeps
its ``k`` smallest ids. A pair of classes can reach a score t only if they share one of the first ``n - ceil(t * n) + 1``
skills of the posting, counted from the rarest: so posting classes go into the lists of those skills only, a profile
looks into the lists of its skills, and a pair is taken in the list of its rarest common skill alone. Profiles that find
``k`` postings at the first bound are done; the others go on to the next, the last of which is any common skill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of one mask column.
BITS = 62


def _masks(df: DataFrame, skills: str, ranked: Sequence[str], out: str) -> DataFrame:
    """``df`` with mask columns ``<out>0``, …: bit i of all says whether ``skills`` holds ``ranked[i]``."""
    exprs = []
    for w in range(0, len(ranked), BITS):
        pairs = ", ".join(f"{_text(s)}, {1 << i}L" for i, s in enumerate(ranked[w:w + BITS]))
        exprs.append(f"aggregate(coalesce(`{skills}`, array()), 0L, (a, s) -> a | coalesce(try_element_at(map({pairs}), s), 0L)) as {out}{w // BITS}")
    return df.selectExpr("*", *exprs)


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def best_postings(profiles: DataFrame, postings: DataFrame, k: int = 10, profile_id: str = "profile", posting_id: str = "posting",
                  have: str = "have", required: str = "required", bounds: Sequence[float] = (0.5,)) -> DataFrame:
    """(profile, rank, posting, n_required, n_matched, match_score): the ``k`` best postings of each profile that share a skill with it.

    Ties go to the smaller posting id. Skills are text; repeats in a list count once, a NULL list is empty. Ids are unique.
    The number of different skills is bounded by the lexicon; they come to the driver with their counts.
    """
    counts = postings.select(F.explode(F.array_distinct(required)).alias("s")).where("s is not null").groupBy("s").count()
    ranked = [r["s"] for r in sorted(counts.collect(), key=lambda r: (r["count"], r["s"]))]
    words = range((len(ranked) + BITS - 1) // BITS)
    names = ("profile", "rank", "posting", "n_required", "n_matched", "match_score")
    if not ranked:
        none = profiles.selectExpr(f"`{profile_id}` as profile", "1L as rank").join(postings.selectExpr(f"`{posting_id}` as posting"), F.lit(False))
        return none.selectExpr("profile", "rank", "posting", "0L as n_required", "0L as n_matched", "0D as match_score").toDF(*names)
    a, b = [f"a{w}" for w in words], [f"b{w}" for w in words]
    size = lambda cols: " + ".join(f"bit_count({c})" for c in cols)
    bits = lambda c: ("filter(sequence(0, {last}), i -> {test})".format(
        last=len(ranked) - 1, test=" or ".join(f"(i div {BITS} = {w} and shiftright({c}{w}, cast(i % {BITS} as int)) & 1 = 1)" for w in words)))
    # classes: a row a set of skills
    sets = _masks(postings, required, ranked, "b").selectExpr(f"`{posting_id}` as posting", *b).where(f"{size(b)} > 0")
    first = sets.selectExpr("*", f"row_number() over (partition by {', '.join(b)} order by posting) as n").where(f"n <= {k}")
    jobs = first.groupBy(*b).agg(F.expr("array_sort(collect_list(posting)) as ids"))         # k ids at most
    jobs = jobs.selectExpr("*", f"{size(b)} as n_required", f"{bits('b')} as skills")
    people = _masks(profiles, have, ranked, "a").selectExpr(f"`{profile_id}` as profile", *a).where(f"{size(a)} > 0")
    classes = people.select(*a).distinct()
    matched = " + ".join(f"bit_count(a{w} & b{w})" for w in words)
    # no common skill below the one whose list this is
    lowest = " and ".join(f"(case when bit div {BITS} > {w} then a{w} & b{w} when bit div {BITS} = {w} then a{w} & b{w} & (shiftleft(1L, cast(bit % {BITS} as int)) - 1) else 0L end) = 0"
                          for w in words)
    found, left = None, classes
    for t in [*bounds, 0.0]:
        lists = jobs.selectExpr(*b, "n_required", "ids", f"explode(slice(skills, 1, n_required - cast(greatest(ceil({float(t)}D * n_required), 1) as int) + 1)) as bit")
        asked = left.selectExpr(*a, f"explode({bits('a')}) as bit")
        pairs = asked.join(lists, "bit").where(lowest).selectExpr(*a, "n_required", "ids", f"{matched} as n_matched").where(f"n_matched >= {float(t)}D * n_required")
        best = pairs.selectExpr("*", f"row_number() over (partition by {', '.join(a)} order by n_matched / n_required desc, ids[0]) as n").where(f"n <= {k}").drop("n")
        best = best.selectExpr(*a, "n_required", "n_matched", "explode(ids) as posting")
        best = best.selectExpr("*", f"row_number() over (partition by {', '.join(a)} order by n_matched / n_required desc, posting) as rank").where(f"rank <= {k}")
        if t:
            done = best.where(f"rank = {k}").select(*a)
            left = left.join(done, a, "left_anti")
            best = best.join(done, a, "left_semi")
        found = best if found is None else found.unionByName(best)
    return people.join(found, a).selectExpr("profile", "cast(rank as bigint) as rank", "posting", "cast(n_required as bigint) as n_required",
                                            "cast(n_matched as bigint) as n_matched", "round(n_matched / n_required, 4) as match_score")
