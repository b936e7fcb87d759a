"""The prefix trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from hirelens.llm import prefixtrie
from hirelens.llm.prefixtrie import WIDTH, Art, Few, Full, Indexed

SCHEMA = "conv_id long, turn int, role string, text string, conv string, place int, d0 long, depth string, least int, n int, one int, salt string"


def _frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3, 4, 5, "z") for r in rows], SCHEMA).repartition(parts)


def _tid(turn):
    return hashlib.sha256(f"{len(turn[0])}:{turn[0]}{turn[1]}".encode()).digest()[:16]


def _rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, _tid((role or "", text or "")), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def _nodes(convs):
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not kids[p]
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def _hard():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 130), 250, 251, 399, -5, -100, -101, 7000]:
        n = rng.choice([1, 1, 2, 4, 6, 8])
        rows += [(c, t, rng.choice(["user", "assistant"]) if t else "user", rng.choice(["hi", "there é", "中文 x", "", "longer text " * 9])) for t in range(n)]
    rows += [(1000 + k, t, "user", f"same {t}") for k in range(60) for t in range(7)]                     # copies
    rows += [(2000 + k, t, "user", f"same {t}" if t < 6 else f"other {k}") for k in range(40) for t in range(8)]
    rows += [(3000, t, "user", f"turn {t % 50}") for t in range(260)] + [(3001, t, "user", f"turn {t % 50}") for t in range(240)]
    rows += [(40, None, None, None), (40, None, "user", None), (41, 0, "user", "hi"), (41, 0, "user", "hi"), (41, 0, "a", "b" * 100_000), (None, 1, "user", "lost")]
    return rows


@pytest.mark.parametrize("chunk, parts, piece", [(32_000, 4, 16_000), (97, 9, 40)])
def test_trie_matches_brute_force(spark, monkeypatch, chunk, parts, piece):
    monkeypatch.setattr(prefixtrie, "CHUNK", chunk)
    monkeypatch.setattr(prefixtrie, "PIECE", piece)
    rows = _hard()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts < 5).lower())
    try:
        paths = prefixtrie.paths_of(prefixtrie.rebuilt(prefixtrie.turns_of(_frame(spark, rows))))
        got = Counter(tuple(r) for r in prefixtrie.trie(paths).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == _nodes(_rebuilt(rows))


def test_trie_without_conversations(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        assert prefixtrie.trie(prefixtrie.paths_of(prefixtrie.rebuilt(prefixtrie.turns_of(_frame(spark, rows))))).collect() == []
    one = [(-7, None, None, None)]
    assert Counter(tuple(r) for r in prefixtrie.trie(prefixtrie.paths_of(prefixtrie.rebuilt(prefixtrie.turns_of(_frame(spark, one))))).collect()) == _nodes(_rebuilt(one))


def test_radix_tree_layouts_and_depths():
    rng = random.Random(1)
    tree, strings = Art(), []
    turns = [bytes([b]) + bytes(WIDTH - 1) for b in range(256)] + [bytes([5] * 9 + [b] + [0] * (WIDTH - 10)) for b in range(60)]
    for k in range(900):
        strings.append(b"".join(rng.choice(turns) for _ in range(rng.randint(0, 3))) if k % 3 else turns[k % 316])
    kinds = set()
    for k, s in enumerate(strings):
        tree.insert(s, k, (1, k), k)

    def walk(node):
        if node.children:
            kinds.add((type(node.children).__name__, getattr(node.children, "room", 0)))
            assert all(n.prefix for n in node.children.all())
            for n in node.children.all():
                walk(n)

    walk(tree.root)
    assert kinds >= {("Few", 4), ("Full", 0)}
    want = Counter(s[:d * WIDTH] for s in strings for d in range(len(s) // WIDTH + 1))
    got = Counter((d, n.least, *n.total) for d, n in tree.turns())
    least, weight = {}, Counter()
    for k, s in enumerate(strings):
        for d in range(len(s) // WIDTH + 1):
            least.setdefault(s[:d * WIDTH], k)
            weight[s[:d * WIDTH]] += k
    assert got == Counter((len(p) // WIDTH, least[p], n, weight[p]) for p, n in want.items())


def test_children_grow_through_all_layouts():
    order = list(range(256))
    random.Random(2).shuffle(order)
    children, seen = Few(), set()
    for k, b in enumerate(order):
        children = children.put(b, b)
        seen.add((type(children), getattr(children, "room", 0)))
        assert children.get(b) == b and len(children.all()) == k + 1
        assert all(children.get(c) == (c if c in order[:k + 1] else None) for c in order)
        children = children.put(b, b)
    assert seen == {(Few, 4), (Few, 16), (Indexed, 0), (Full, 0)}
