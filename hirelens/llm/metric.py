"""Exact top-k search by inner product with a paged M-tree, visited best first.

Vectors are the integers floor(256 * x). With one more component sqrt(M**2 - |x|**2) (M: the largest norm; 0 for a
query) all candidates have the norm M, so Euclidean distance, a metric, ranks them as the inner product does. The tree:
a bounded, seeded sample of the rows gives the pivots (``pivots``); ``sqrt(pivots)`` of them are the root's routing
objects, every pivot hangs on its nearest one, and every row on the nearest pivot below its nearest routing object.
A pivot's rows fill pages of about ``page_rows``, dealt by a seeded hash, so that one vector that a third of all rows
repeat fills many pages. Nodes store covering radii and distances to their parents, pages each row's distance to its
pivot.

A query first goes to one page of the node that is nearest by its lower bound, which bounds its k-th distance. Then it
visits, best first, every pivot whose lower bound (through the routing object's radius and parent distance before any
own distance is computed) doesn't exceed that; in a page, rows whose stored distance alone excludes them are skipped for
all queries of a block. Queries go in blocks of ``block_rows``. Lower bounds that can't exclude anything only cost time:
every page that may hold a result is read, so results are exact, ties included (to the smaller id).

Defined cases: a vector that is null or has a null or non-finite component takes no part, nor a row with a null id;
shorter vectors count as filled up with 0. Of several rows with one id the one with the smallest vector counts. Scores
must fit 64 bits. A query whose only candidate is itself has no result. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import arrow_map, stored, table

SCALE = 256


def vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x array<long>) of the rows that take part, one for each id."""
    def run(batch: pa.RecordBatch):
        out = []
        for v in batch["v"].to_pylist():
            ok = v is not None and all(c is not None and math.isfinite(c) for c in v)
            out.append([math.floor(SCALE * c) for c in v] if ok else None)
        return {"id": batch["id"], "x": pa.array(out, pa.list_(pa.int64()))}

    got = arrow_map(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")), run, "id long, x array<long>")
    return got.where("id is not null and x is not null").groupBy("id").agg(F.min("x").alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an integer list column, filled up with 0; whole numbers of any size as Python integers."""
    sizes = np.asarray(column.value_lengths())
    out = np.zeros((len(sizes), width), np.int64)
    flat = np.asarray(column.flatten())
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and b."""
    if not len(a) or not len(b) or not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if bound < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


class Tree:
    """The inner nodes: routing objects and pivots with radii and parent distances; bounded by the number of pivots."""

    def __init__(self, pivots: np.ndarray, norm2: float):
        self.pivots = pivots
        self.norm2 = norm2
        self.extra = self.fill(pivots)
        routes = max(1, math.isqrt(len(pivots)))
        self.routes = np.arange(routes)
        near = self.between(pivots, self.extra)[:, :routes]
        self.parent = near.argmin(axis=1)
        self.to_parent = near[np.arange(len(pivots)), self.parent]
        self.radius = np.zeros(len(pivots))    # around each pivot
        self.cover = np.zeros(routes)          # around each routing object
        self.pages = np.zeros(len(pivots), np.int64)

    def fill(self, x: np.ndarray) -> np.ndarray:
        """The added component of candidates."""
        return np.sqrt(np.maximum(0, self.norm2 - (x.astype(float) ** 2).sum(axis=1)))

    def between(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Distances of rows with added component ``extra`` to all pivots."""
        x = x.astype(float)
        own = (x**2).sum(axis=1) + extra**2
        return np.sqrt(np.maximum(0, own[:, None] + self.norm2 - 2 * (x @ self.pivots.T.astype(float) + extra[:, None] * self.extra)))

    def hang(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pivot, distance to it, distance to its routing object) of candidates."""
        d = self.between(x, self.fill(x))
        route = d[:, : len(self.routes)].argmin(axis=1)
        below = np.where(self.parent == route[:, None], d, np.inf)
        pivot = below.argmin(axis=1)
        rows = np.arange(len(x))
        return pivot, d[rows, pivot], d[rows, route]

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower bounds, distances) of queries to the rows of each pivot; the bound of a routing object holds below it."""
        d = self.between(x, np.zeros(len(x)))
        route = d[:, : len(self.routes)]
        above = np.maximum(route - self.cover, 0)[:, self.parent]
        stored_ = np.abs(route[:, self.parent] - self.to_parent) - self.radius
        return np.maximum.reduce([above, stored_, d - self.radius, np.zeros_like(d)]), d


def search(rows: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = 64,
           page_rows: int = 512, block_rows: int = 256, seed: int = 7) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best other rows of each row for whose id ``is_query(column)`` holds."""
    spark = rows.sparkSession
    empty = "query_id long, rank int, id long, score long"
    data = stored(vectors(rows, id_col, vec_col), "metric-vectors")
    width, norm2, most, least = data.agg(F.max(F.size("x")), F.max(F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)),
                                         F.max(F.array_max("x")), F.min(F.array_min("x"))).first()
    if width is None:
        return spark.createDataFrame([], empty)
    kind = np.int32 if max(most or 0, -(least or 0)) < 2**31 else np.int64  # of components in pages
    sample = data.orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id").limit(pivots).select("x").toArrow()["x"].combine_chunks()
    tree = Tree(_matrix(sample, width), norm2)

    def hang(batch: pa.RecordBatch):
        pivot, near, far = tree.hang(_matrix(batch["x"], width))
        return {"id": batch["id"], "x": batch["x"], "pivot": pivot.astype(np.int32), "near": near, "far": far}

    hung = stored(arrow_map(data, hang, "id long, x array<long>, pivot int, near double, far double"), "metric-hung")
    for r in hung.groupBy("pivot").agg(F.count("*").alias("n"), F.max("near").alias("near"), F.max("far").alias("far")).collect():
        p = r["pivot"]
        tree.pages[p] = -(-r["n"] // page_rows)
        tree.radius[p] = r["near"]
        route = tree.parent[p]
        tree.cover[route] = max(tree.cover[route], r["far"])
    slack = 1e-6 * (1 + math.sqrt(norm2))
    counts = F.element_at(F.array(*[F.lit(int(n)) for n in tree.pages]), F.col("pivot") + 1)
    dealt = hung.withColumn("page", F.pmod(F.xxhash64("id", F.lit(seed)), counts).cast("int"))

    def pack(page: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(page["near"]), kind="stable")
        x = _matrix(page["x"].combine_chunks(), width)[order]
        return pa.table({"pivot": page["pivot"].slice(0, 1), "page": page["page"].slice(0, 1),
                         "ids": pa.array([np.asarray(page["id"])[order].tobytes()], pa.binary()),
                         "near": pa.array([np.asarray(page["near"])[order].tobytes()], pa.binary()),
                         "x": pa.array([x.astype(kind).tobytes()], pa.binary())})

    pages = stored(dealt.groupBy("pivot", "page").applyInArrow(pack, "pivot int, page int, ids binary, near binary, x binary"), "metric-pages")

    def unpack(ids, near, x):
        return (np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(near.as_buffer(), float),
                np.frombuffer(x.as_buffer(), kind).reshape(-1, width).astype(np.int64))

    def best(scores: np.ndarray, ids: np.ndarray, own: int) -> np.ndarray:
        """Places of the k best rows but the query's own."""
        some = np.flatnonzero(ids != own)
        if len(some) > 4 * k:
            edge = np.partition(scores[some], len(some) - k)[len(some) - k]
            some = some[scores[some] >= edge]
        return some[np.lexsort((ids[some], -scores[some]))[:k]]

    # first visit: one page of the nearest node
    queries = data.where(is_query(F.col("id")))

    def first(batch: pa.RecordBatch):
        x, ids = _matrix(batch["x"], width), np.asarray(batch["id"])
        low, d = tree.bounds(x)
        at = np.lexsort((d, np.where(tree.pages > 0, low, np.inf)), axis=1)[:, 0]
        page = ids // 7 % tree.pages[at]
        for p, g in np.unique(np.stack([at, page]), axis=1).T:
            some = (at == p) & (page == g)
            yield {"pivot": [int(p)], "page": [int(g)], "q_ids": pa.array([ids[some].tobytes()]), "q": pa.array([x[some].tobytes()])}

    def reach(batch: pa.RecordBatch):
        for row in range(batch.num_rows):
            ids, _, x = unpack(batch["ids"][row], batch["near"][row], batch["x"][row])
            own = np.frombuffer(batch["q_ids"][row].as_buffer(), np.int64)
            q = np.frombuffer(batch["q"][row].as_buffer(), np.int64).reshape(-1, width)
            norms, limit = (q.astype(float) ** 2).sum(axis=1), np.full(len(q), np.inf)
            for i, scores in enumerate(inner(q, x)):
                top = best(scores, ids, own[i])
                if len(top) == k:
                    limit[i] = math.sqrt(max(0.0, norms[i] + norm2 - 2 * float(scores[top[-1]])))
            yield {"id": own, "q": pa.array([v.tobytes() for v in q], pa.binary()), "limit": limit}

    started = arrow_map(queries, first, "pivot int, page int, q_ids binary, q binary")
    limited = stored(arrow_map(started.join(pages, ["pivot", "page"]), reach, "id long, q binary, limit double"), "metric-limits")

    def visits(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, block_rows):
            block = batch.slice(at, block_rows)
            x = np.frombuffer(b"".join(block["q"].to_pylist()), np.int64).reshape(-1, width)
            ids, limit = np.asarray(block["id"]), np.asarray(block["limit"])
            low, d = tree.bounds(x)
            needed = (low <= limit[:, None] + slack) & (tree.pages > 0)
            order = np.argsort(np.where(needed, low, np.inf).min(axis=0), kind="stable")  # best first
            for p in order[needed.any(axis=0)[order]]:
                some = needed[:, p]
                yield {"pivot": [int(p)], "q_ids": pa.array([ids[some].tobytes()]), "q": pa.array([x[some].tobytes()]),
                       "limit": pa.array([limit[some].tobytes()]), "far": pa.array([d[some, p].tobytes()])}

    def compare(batch: pa.RecordBatch):
        for row in range(batch.num_rows):
            ids, near, x = unpack(batch["ids"][row], batch["near"][row], batch["x"][row])
            own, limit, far = (np.frombuffer(batch[c][row].as_buffer(), kind) for c, kind in (("q_ids", np.int64), ("limit", float), ("far", float)))
            q = np.frombuffer(batch["q"][row].as_buffer(), np.int64).reshape(-1, width)
            # rows that the stored distances exclude for every query of the block are not looked at
            lo, hi = (far - limit).min() - slack, (far + limit).max() + slack
            some = slice(np.searchsorted(near, lo), np.searchsorted(near, hi, side="right"))
            scores = inner(q, x[some])
            out = [(int(o), best(s, ids[some], o), s) for o, s in zip(own, scores)]
            yield {"query_id": np.repeat([o for o, _, _ in out], [len(t) for _, t, _ in out]).astype(np.int64),
                   "id": np.concatenate([ids[some][t] for _, t, _ in out]), "score": np.concatenate([s[t] for _, t, s in out])}

    asked = stored(arrow_map(limited, visits, "pivot int, q_ids binary, q binary, limit binary, far binary"), "metric-visits")
    found = arrow_map(asked.join(pages.drop("page"), "pivot"), compare, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op4_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all other rows for each row whose vec_id is divisible by 50."""
    return search(table(spark, sf_dir, "embeddings"), lambda c: c % 50 == 0).withColumnRenamed("id", "vec_id")


SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as x from embeddings
           where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2]))::bigint as score
      from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
