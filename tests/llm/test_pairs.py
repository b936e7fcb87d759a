"""N-gram join, substring removal and components against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

from hirelens.llm import simjoin, substrings
from hirelens.llm.components import components
from tests.llm import samples


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_join_matches_all_pairs(spark):
    rows = samples.hard_texts() + samples.many_near_copies()
    got = _rows(simjoin.join(samples.frame(spark, rows)))
    assert got == Counter(samples.near_components(rows))


def test_join_of_nothing(spark):
    assert simjoin.join(samples.frame(spark, [])).collect() == []
    rows = [(1, None, None, None), (2, "", None, None)]
    assert _rows(simjoin.join(samples.frame(spark, rows))) == Counter({(1, 0, 1): 1, (2, 0, 2): 1})


def test_representatives(spark):
    rows = samples.hard_texts()
    got = [r for r in simjoin.representatives(samples.frame(spark, rows)).collect()]
    least = {i: c for i, _, c in samples.near_components(rows)}
    want = {i for i, c in least.items() if i is not None and i == c}
    assert Counter(r.doc_id for r in got) == Counter([*want, None])
    assert got[0].__fields__ == samples.frame(spark, rows).columns


def test_prefix_requirement_is_safe():
    """Sets that reach the similarity share min(l) shingles at the places that count, whatever l they chose."""
    import numpy as np
    rng = np.random.default_rng(3)
    sketch = rng.integers(0, 400, 1 << simjoin.SKETCH_BITS).astype(np.uint32)
    linked = 0
    for _ in range(600):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.12], rng.integers(0, 2**64, int(rng.integers(0, 5)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 75 * (len(a) + len(b) - both):
            continue
        linked += 1
        (pa_, la), (pb, lb) = simjoin.prefix(a, sketch, 20.0), simjoin.prefix(b, sketch, 20.0)
        overlap, match = -(-(len(a) + len(b)) * 75 // 175), min(la, lb)
        assert both >= overlap and len(pa_) >= len(a) - overlap + match and len(pb) >= len(b) - overlap + match
        assert len(np.intersect1d(pa_[: len(a) - overlap + match], pb[: len(b) - overlap + match])) >= match
    assert linked > 100


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(500, k) for k in range(501, 560)] + [(k, k + 1) for k in range(700, 740)] + [(9, 9)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.vertex: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in got}
    assert set(got) >= {x for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def _want(rows):
    return Counter((i, n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest())
                   for (i, *_), (n, gone, kept) in zip(rows, samples.repeated_windows(rows)))


def test_substrings_match_brute_force(spark):
    rows = samples.hard_texts() + samples.many_near_copies(30)
    assert _rows(substrings.report(samples.frame(spark, rows), filter_bits=20)) == _want(rows)


def test_substrings_with_a_filter_that_excludes_nothing(spark):
    rows = samples.hard_texts()
    assert _rows(substrings.report(samples.frame(spark, rows), filter_bits=9)) == _want(rows)


def test_substrings_of_nothing(spark):
    assert substrings.report(samples.frame(spark, [])).collect() == []
