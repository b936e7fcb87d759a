"""Best postings of each profile against all pairs."""

import random
from decimal import ROUND_HALF_UP, Decimal

from hirelens.operators.search import best_postings


def _brute(profiles, postings, k):
    out = set()
    for p, have in profiles:
        scored = []
        for j, req in postings:
            r = set(req or []) - {None}
            m = r & set(have or [])
            if m:
                scored.append((-len(m) / len(r), j, len(r), len(m)))
        for rank, (s, j, n, m) in enumerate(sorted(scored)[:k], 1):
            out.add((p, rank, j, n, m, float(Decimal(m / n).quantize(Decimal("0.0001"), ROUND_HALF_UP))))
    return out


def _check(spark, profiles, postings, k, **kw):
    p = spark.createDataFrame(profiles, "profile long, have array<string>")
    j = spark.createDataFrame(postings, "posting long, required array<string>")
    got = [tuple(r) for r in best_postings(p, j, k, **kw).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(profiles, postings, k)


def test_best_postings_match_all_pairs(spark):
    rnd = random.Random(7)
    for n_skills, k, bounds in ((9, 3, (0.5,)), (130, 5, (0.8, 0.4)), (70, 4, ())):
        skills = [f"s{i}'x" for i in range(n_skills)]
        draw = lambda most: [s for s in skills if rnd.random() < rnd.choice([0.02, 0.1, most])] or [rnd.choice(skills)]
        postings = [(i, draw(0.5)) for i in range(150)] + [(500 + i, skills[:2]) for i in range(60)] + [(900, None), (901, []), (902, [skills[0], skills[0], None])]
        profiles = [(i, draw(0.7)) for i in range(60)] + [(100 + i, skills) for i in range(30)] + [(200, None), (201, []), (202, ["other"])]
        _check(spark, profiles, postings, k, bounds=bounds)


def test_best_postings_of_nothing(spark):
    _check(spark, [(1, ["a"])], [(1, []), (2, None)], 3)
    _check(spark, [], [(1, ["a"])], 3)
    _check(spark, [(1, ["a"])], [(1, ["a"])], 3)
