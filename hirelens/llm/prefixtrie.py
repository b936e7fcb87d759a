"""The prefix trie of conversations, built from adaptive radix trees in the tasks.

A turn (role, text) becomes a turn id of 16 bytes (of its SHA-256), a conversation the string of its turn ids. Tasks insert
these strings into adaptive radix trees (``Art``): nodes of 4, 16, 48 or 256 children that grow as needed, common bytes
compressed into a node's prefix. Only depths that are whole turns emit trie nodes, also those inside a compressed prefix.
A task emits each node once, with sums over the strings that pass it, so that a first turn or a whole conversation that a
third of all have in common leaves each task as a few rows; the sums of the tasks meet in a grouped aggregation.

Across tasks a node is known by its depth and a digest of its turns: two 64-bit sums of hashes of (place, turn id), which
can be carried on along a conversation that lies over several tasks (``running``): a piece of a conversation that starts
at turn k is inserted below the root (k, digest so far). No conversation, subtree or member list is ever in one place.

Sums over subtrees come from a second pass of the same trees. A node's own value belongs to its smallest member, whose
nodes are a path that runs to its end. So a node's subtree holds what its members own, but for what its smallest member
owns above it: members' totals are summed like counts, and ``running`` gives the part above.

Defined cases: turns are ordered by turn (null first), then turn id; equal rows are turns of their own. A null role or text
is the empty text. Rows with a null conversation id are left out. Other columns are ignored. No conversations: no nodes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hirelens.llm.common import map_batches, stored, table
from hirelens.llm.running import _added, running

#: Bytes of a turn id.
WIDTH = 16
#: Rows that one set of trees takes before its nodes are emitted.
CHUNK = 32_000
#: Bytes of member ids that go on together to their hash.
PIECE = 16_000
#: Turns that a rebuilt conversation can take from its base.
HEAD = 5


class Few:
    """Children of a node with up to 4 or 16: sorted bytes beside the nodes."""

    __slots__ = ("room", "keys", "nodes")

    def __init__(self, room: int = 4, keys: bytes = b"", nodes: list | None = None):
        self.room, self.keys, self.nodes = room, bytearray(keys), nodes or []

    def get(self, b: int):
        at = self.keys.find(b)
        return self.nodes[at] if at >= 0 else None

    def put(self, b: int, node):
        at = bisect_left(self.keys, b)
        if at < len(self.keys) and self.keys[at] == b:
            self.nodes[at] = node
        elif len(self.keys) < self.room:
            self.keys.insert(at, b)
            self.nodes.insert(at, node)
        else:
            grown = Few(16, self.keys, self.nodes) if self.room < 16 else Indexed(self.keys, self.nodes)
            return grown.put(b, node)
        return self

    def all(self) -> list:
        return self.nodes


class Indexed:
    """Up to 48 children: a byte's place among the nodes."""

    __slots__ = ("index", "nodes")

    def __init__(self, keys, nodes: list):
        self.index, self.nodes = bytearray(256), list(nodes)
        for at, b in enumerate(keys):
            self.index[b] = at + 1

    def get(self, b: int):
        at = self.index[b]
        return self.nodes[at - 1] if at else None

    def put(self, b: int, node):
        at = self.index[b]
        if at:
            self.nodes[at - 1] = node
        elif len(self.nodes) < 48:
            self.nodes.append(node)
            self.index[b] = len(self.nodes)
        else:
            full = Full()
            for c in range(256):
                if self.index[c]:
                    full.put(c, self.nodes[self.index[c] - 1])
            return full.put(b, node)
        return self

    def all(self) -> list:
        return self.nodes


class Full:
    """Up to 256 children: a node for each byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, b: int):
        return self.nodes[b]

    def put(self, b: int, node):
        self.nodes[b] = node
        return self

    def all(self) -> list:
        return [n for n in self.nodes if n is not None]


class Node:
    """``prefix``: the bytes from the parent to here; ``row``: of some string below, the row of its first turn."""

    __slots__ = ("prefix", "children", "least", "total", "row")

    def __init__(self, prefix: bytes, least: int, total: list[int], row: int):
        self.prefix, self.children, self.least, self.total, self.row = prefix, None, least, total, row

    def add(self, least: int, weights: tuple[int, ...]) -> None:
        if least < self.least:
            self.least = least
        self.total = [a + b for a, b in zip(self.total, weights)]


class Art:
    """Strings with a number (of which nodes keep the least) and weights (of which nodes keep the sums)."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, least: int, weights: tuple[int, ...], row: int) -> None:
        if self.root is None:
            self.root = Node(b"", least, [0] * len(weights), row)
        node, at, end = self.root, 0, len(key)
        node.add(least, weights)
        while at < end:
            below = node.children.get(key[at]) if node.children else None
            if below is None:
                node.children = (node.children or Few()).put(key[at], Node(key[at:], least, list(weights), row))
                return
            prefix = below.prefix
            same = len(prefix) if key.startswith(prefix, at) else common(prefix, key, at)
            if same < len(prefix):      # a new node where the strings part
                mid = Node(prefix[:same], below.least, below.total, below.row)
                below.prefix = prefix[same:]
                mid.children = Few().put(below.prefix[0], below)
                node.children = node.children.put(key[at], mid)
                below = mid
            below.add(least, weights)
            node, at = below, at + same

    def turns(self) -> Iterator[tuple[int, Node]]:
        """(depth in turns, node that holds its numbers) of every depth that is a whole number of turns, root included."""
        if self.root is None:
            return
        yield 0, self.root
        open_ = [(0, n) for n in (self.root.children.all() if self.root.children else ())]
        while open_:
            at, node = open_.pop()
            end = at + len(node.prefix)
            for depth in range(at // WIDTH + 1, end // WIDTH + 1):
                yield depth, node
            if node.children:
                open_.extend((end, n) for n in node.children.all())


def common(prefix: bytes, key: bytes, at: int) -> int:
    """Length of the longest common prefix of ``prefix`` and ``key[at:]``."""
    low, high = 0, min(len(prefix), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if prefix[:mid] == key[at:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def partial_nodes(paths: DataFrame, weights: list[str]) -> DataFrame:
    """Nodes of the trees that tasks make of ``paths`` (``paths_of``), with sums of the weights over strings.

    (depth, d0, d1, p0, p1, least, chars, weights): digest of the node and of its parent, smallest conversation, length of
    the last text. A node comes once a tree. Rows of a conversation that lie apart only make more pieces.
    """
    schema = "depth long, d0 long, d1 long, p0 long, p1 long, least long, chars long" + "".join(f", {w} long" for w in weights)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def nodes(rows: pa.Table) -> pa.RecordBatch:
        conv, place, chars, p0, p1, w0, w1 = (np.asarray(rows[c]).astype(np.int64) for c in ("conv", "place", "chars", "p0", "p1", "w0", "w1"))
        d0, d1 = p0 + w0, p1 + w1
        each = [np.asarray(rows[w]).astype(np.int64) for w in weights]
        ids = rows["tid"].combine_chunks().fill_null(b"")
        data, offs = ids.buffers()[2], np.frombuffer(ids.buffers()[1], np.int32)[ids.offset: ids.offset + len(ids) + 1]
        data = memoryview(data) if data else memoryview(b"")
        cut = np.flatnonzero((conv[1:] != conv[:-1]) | (place[1:] != place[:-1] + 1)) + 1
        trees: dict[tuple, Art] = {}
        for a, b in zip([0, *cut], [*cut, len(conv)]):
            start = (int(place[a]), int(p0[a]), int(p1[a]))     # from -1: whole conversations, which count at the root
            first = a + 1 if place[a] < 0 else a
            trees.setdefault(start, Art()).insert(bytes(data[offs[first]:offs[b]]), int(conv[a]), tuple(int(w[a]) for w in each), first)
        depth, row, least, total = [], [], [], []
        for (start, *_), tree in trees.items():
            for turns, node in tree.turns():
                if turns or start < 0:
                    depth.append(max(start, 0) + turns)
                    row.append(node.row + turns - 1)
                    least.append(node.least)
                    total.append(node.total)
        depth, row = np.array(depth, np.int64), np.array(row, np.int64)
        inner = depth > 0
        row = np.where(inner, row, 0)
        cols = [depth, *[np.where(inner, x[row], 0) for x in (d0, d1, p0, p1)], np.array(least, np.int64), np.where(inner, chars[row], 0),
                *np.array(total, np.int64).reshape(len(depth), len(weights)).T]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, n = [], 0
        for batch in batches:
            if batch.num_rows:
                have.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield nodes(pa.Table.from_batches(have))
                have, n = [], 0
        if have:
            yield nodes(pa.Table.from_batches(have))

    return map_batches(paths.select("conv", "place", "tid", "chars", "p0", "p1", "w0", "w1", *weights), run, schema)


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place, tid, chars) of every turn; places count from 0 in each conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turn_id = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), turn_id.alias("tid"), F.length(text).cast("long").alias("chars"),
        F.lit(1).cast("long").alias("one"), F.monotonically_increasing_id().alias("salt"))
    return running(rows, "conv", [F.col("turn").asc_nulls_first(), "tid", "salt"], ["one"], "trie-turns").select(
        "conv", F.col("one_before").alias("place"), "tid", "chars")


def taken_from_base(conv: Column) -> Column:
    """How many turns a rebuilt conversation takes from its base: crc32 of the decimal id, modulo 6."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(HEAD + 1))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, place, tid, chars) of the rebuilt conversations, with a row of place -1 (no turn) for each.

    The first h turns of conversation c - c % 100, then the own turns after the first h; h: ``taken_from_base``.
    """
    heads = (turns.where((F.col("conv") % 100 == 0) & (F.col("place") < HEAD)).groupBy(F.col("conv").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("place", "tid", "chars"))).alias("head")))       # 5 at most
    convs = turns.where("place = 0").select("conv", (F.col("conv") - F.col("conv") % 100).alias("base"), taken_from_base(F.col("conv")).cast("int").alias("h"))
    links = convs.join(heads, "base", "left").select("conv", "h", F.when(F.col("head").isNull(), F.array().cast("array<struct<place:bigint,tid:binary,chars:bigint>>"))
                                                     .otherwise(F.slice("head", 1, F.col("h"))).alias("head"))
    none = F.struct(F.lit(-1).cast("long").alias("place"), F.lit(None).cast("binary").alias("tid"), F.lit(0).cast("long").alias("chars"))
    first = links.select("conv", F.inline(F.concat(F.array(none), F.col("head"))))
    short = links.where(F.size("head") < F.col("h")).select("conv", (F.size("head") - F.col("h")).alias("shift"))
    own = turns.where(F.col("place") >= taken_from_base(F.col("conv"))).join(short, "conv", "left")
    return first.unionByName(own.select("conv", (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"), "tid", "chars"))


def paths_of(turns: DataFrame) -> DataFrame:
    """``turns`` (conv, place, tid, chars; place -1 for the start of each) with hashes w0, w1 and the digests p0, p1 before each."""
    hashed = turns.select("*", *[F.when(F.col("place") < 0, F.lit(0).cast("long")).otherwise(w).alias(n) for n, w in
                                 (("w0", F.xxhash64("place", "tid")), ("w1", F.xxhash64("tid", "place", F.lit(1))))])
    return running(hashed, "conv", ["place"], ["w0", "w1"], "trie-paths").withColumnsRenamed({"w0_before": "p0", "w1_before": "p1"})


def hashed_members(ends: DataFrame) -> DataFrame:
    """(depth, d0, d1, sha) of ends (depth, d0, d1, conv): SHA-256 of the ascending decimal ids, joined by commas.

    Ids are sorted over all tasks and joined to pieces there. A hash takes its text in order, so the pieces of one end go
    to one task, which reads them as a stream and holds one at a time.
    """
    key = ["d0", "d1", "depth"]

    def join(batches):
        now, ids, size = None, [], 0

        def piece():
            return pa.RecordBatch.from_pydict({"d0": [now[0]], "d1": [now[1]], "depth": [now[2]], "first": [ids[0]], "text": [",".join(map(str, ids))]},
                                              schema=pieces)

        for batch in batches:
            for a, b, c, conv in zip(*(batch[k].to_pylist() for k in (*key, "conv"))):
                if (a, b, c) != now or size > PIECE:
                    if ids:
                        yield piece()
                    now, ids, size = (a, b, c), [], 0
                ids.append(conv)
                size += 8
        if ids:
            yield piece()

    def digest(batches):
        now, h = None, None
        for batch in batches:
            out = []
            for a, b, c, text in zip(*(batch[k].to_pylist() for k in (*key, "text"))):
                if (a, b, c) == now:
                    h.update(b"," + text.encode())
                else:
                    if now:
                        out.append((*now, h.hexdigest()))
                    now, h = (a, b, c), hashlib.sha256(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], schema=hashes)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, h.hexdigest())], schema=hashes)

    joined, hashed = "d0 long, d1 long, depth long, first long, text string", "d0 long, d1 long, depth long, sha string"
    pieces, hashes = (to_arrow_schema(StructType.fromDDL(s)) for s in (joined, hashed))
    sorted_ = ends.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    return map_batches(map_batches(sorted_, join, joined).repartition(*key).sortWithinPartitions(*key, "first"), digest, hashed)


def trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of ``paths`` (``paths_of``).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), all but the last long.
    """
    key = ["depth", "d0", "d1"]
    nodes = stored(partial_nodes(paths.withColumn("n", F.lit(1).cast("long")), ["n"]).groupBy(*key).agg(
        F.max("p0").alias("p0"), F.max("p1").alias("p1"), F.min("least").alias("least"), F.max("chars").alias("chars"), F.sum("n").alias("n")), "trie-nodes")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p0").alias("d0"), F.col("p1").alias("d1")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d0").alias("p0"), F.col("d1").alias("p1"), F.col("least").alias("parent_conv_id"))
    known = (nodes.join(kids, key, "left").join(parents, ["depth", "p0", "p1"], "left")
             .select(*key, "least", "parent_conv_id", "n", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                     ((F.col("n") - 1) * F.col("chars")).alias("own")))
    known = running(known, "least", ["depth"], ["own"], "trie-known")
    shares = known.groupBy(F.col("least").alias("conv")).agg(F.sum("own").alias("saves"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    shared = paths.join(shares.where("saves <> 0 or leaves <> 0"), "conv")
    sums = partial_nodes(shared, ["saves", "leaves"]).groupBy(*key).agg(F.sum("saves").alias("saves"), F.sum("leaves").alias("leaves"))
    last = paths.groupBy("conv").agg(F.max(F.struct("place", "p0", "p1", "w0", "w1")).alias("end"))
    ends = last.select((F.col("end.place") + 1).alias("depth"), _added(F.col("end.p0"), F.col("end.w0")).alias("d0"),
                       _added(F.col("end.p1"), F.col("end.w1")).alias("d1"), "conv")
    return (known.join(sums, key).join(hashed_members(ends), key, "left")
            .select(F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
                    (F.col("saves") - F.col("own_before")).alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("ends_sha256")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return trie(paths_of(rebuilt(turns_of(table(spark, sf_dir, "conversations")))))
