"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles; two link when their Jaccard similarity reaches ``num / den``. Equal sets form one
class. A counter table of fixed size estimates how many documents hold a shingle and orders shingles from rare to
frequent. A set of n shingles needs an overlap of t = ceil(n * num / den) at least; its l-prefix is the first n - t + l
in that order. Each set chooses its own l: the higher the estimated number of postings in its plain prefix, the longer
its prefix. Two sets whose sizes ask for an overlap of o, of lengths l and m, share at least min(l, m) shingles that
stand among the first n - o + min(l, m) of either: the more a document's postings cost, the more of them must agree
before a pair is verified.

Postings of shingles that only one class holds are dropped. Candidates are taken in two ways. First each class meets
one class of each of its posting lists: the one that shares most of its prefix, as the common source of copies does;
verified links give components. Then every pair of classes of a posting list that aren't in one component yet is a
candidate, so no link between components is lost, while a large group of near copies never becomes all its pairs.
Verification compares whole sets. Shingles are compared by 64-bit hashes.

Defined cases: null and empty texts, and texts without words, have an empty set and link with nothing; so has a row with
a null id (its component is null). Repeated rows fall into one class. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.bitmaps import bitmap, counters, has_bits
from hirelens.llm.common import arrow_map, forget, map_batches, stored, table, unused
from hirelens.llm.components import components
from hirelens.llm.textops import Words, mix, signed, window_hashes, words_of

NUM, DEN = 75, 100
SHINGLE = 5
#: A prefix is lengthened by at most so many shingles.
MOST_EXTRA = 2
SKETCH_BITS = 22
#: Logarithm of the bits that mark the shingles which several classes hold.
HELD_BITS = 24


def sets(w: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, without words none."""
    at = w.window_starts(size)
    h = window_hashes(w.hashes, size)[at]
    cut = np.searchsorted(at, w.first)
    counts = w.counts()
    out = []
    for r in range(len(counts)):
        if counts[r] >= size:
            own = np.sort(h[cut[r]: cut[r + 1]])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif counts[r]:
            own = w.hashes[w.first[r]: w.first[r + 1]]
            out.append(mix(np.array([np.bitwise_xor.reduce(mix(own + np.arange(1, len(own) + 1, dtype=np.uint64))) + np.uint64(len(own))])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(own: np.ndarray) -> int:
    """64-bit hash of a set."""
    return int(signed(mix(np.array([mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum() + np.uint64(len(own))])))[0])


def needed(n: int) -> int:
    return -(-n * NUM // DEN)


def prefix(own: np.ndarray, sketch: np.ndarray, mean: float) -> tuple[np.ndarray, int]:
    """(shingles of the chosen prefix, its l)."""
    n = len(own)
    t = needed(n)
    count = sketch[own >> np.uint64(64 - SKETCH_BITS)]
    order = np.lexsort((own, count))
    plain = n - t + 1
    cost = np.maximum(count[order[:plain]] - 2 * mean, 0).sum()
    l = min(t, 1 + min(MOST_EXTRA - 1, int(np.log2(1 + cost / plain))))
    return own[order[: n - t + l]], l


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def classes(texts: DataFrame) -> DataFrame:
    """(id, n, class) of every row."""
    def run(batch: pa.RecordBatch):
        for i, j, w in words_of(batch["text"], lower=True):
            own = sets(w)
            yield {"id": batch["id"].slice(i, j - i), "n": [len(s) for s in own], "class": [class_of(s) for s in own]}

    return arrow_map(texts, run, "id long, n long, class long")


def sketched(texts: DataFrame):
    """Broadcast (counter table, its mean): at least how many texts hold the shingles of each counter."""
    def shingles(batch: pa.RecordBatch):
        for _, _, w in words_of(batch.column(0), lower=True):
            yield np.concatenate(sets(w))

    sketch = counters(texts.select("text"), shingles, SKETCH_BITS)
    return texts.sparkSession.sparkContext.broadcast((sketch, float(sketch.mean())))


def postings(texts: DataFrame, sent, only=None) -> DataFrame:
    """(token, class, l, place) of every prefix shingle; places count from 1, rare shingles first.

    ``only``: a broadcast bitmap; shingles that aren't in it stay in their task.
    """
    def run(batch: pa.RecordBatch):
        for _, _, w in words_of(batch.column(0), lower=True):
            token, cls, l, place = [], [], [], []
            for own in sets(w):
                if len(own):
                    p, k = prefix(own, *sent.value)
                    token.append(p)
                    cls.append(np.full(len(p), class_of(own)))
                    l.append(np.full(len(p), k, np.int8))
                    place.append(np.arange(1, len(p) + 1, dtype=np.int32))
            if token:
                token, cls, l, place = (np.concatenate(x) for x in (token, cls, l, place))
                some = has_bits(only.value, mix(token), HELD_BITS) if only else slice(None)
                yield {"token": signed(token[some]), "class": cls[some], "l": l[some], "place": place[some]}

    return arrow_map(texts.select("text"), run, "token long, class long, l tinyint, place int")


def _counts() -> Column:
    """Whether a shingle at places pa, pb counts for a pair of sets (na, la), (nb, lb) whose sizes allow a link."""
    overlap = F.ceil((F.col("na") + F.col("nb")) * NUM / (NUM + DEN))
    match = F.least("la", "lb")
    return ((DEN * F.least("na", "nb") >= NUM * F.greatest("na", "nb"))
            & (F.col("pa") <= F.col("na") - overlap + match) & (F.col("pb") <= F.col("nb") - overlap + match))


def _side(lists: DataFrame, x: str) -> DataFrame:
    names = {"class": x, "n": f"n{x}", "l": f"l{x}", "place": f"p{x}", "root": f"r{x}"}
    return lists.select("token", *[F.col(c).alias(name) for c, name in names.items() if c in lists.columns])


def _matched(met: DataFrame, *also: str) -> DataFrame:
    """Pairs (a, b) with enough counting shingles, from rows of one shingle each."""
    return (met.groupBy("a", "b", *also).agg(F.count("*").alias("shared"), F.first(F.least("la", "lb")).alias("match"))
            .where(F.col("shared") >= F.col("match")).drop("match"))


def _linked(both: int, n: int, m: int) -> bool:
    return DEN * both >= NUM * (n + m - both)


def _at_most(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted arrays of 16-bit ends of hashes, each as often as both have it."""
    (u, c), (v, d) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    return int(np.minimum(c[i], d[j]).sum())


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted sets."""
    return int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())


def _compared(pairs: DataFrame, held: DataFrame, column: str, kind: type, common) -> DataFrame:
    """The pairs whose arrays in ``column`` of ``held`` (class) have enough in common."""
    of = lambda x: held.select(F.col("class").alias(x), F.col(column).alias(f"own_{x}"))

    def compare(batch: pa.RecordBatch):
        good = []
        for x, y in zip(batch["own_a"], batch["own_b"]):
            x, y = np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind)
            good.append(_linked(common(x, y), len(x), len(y)))
        good = pa.array(good, pa.bool_())
        return {"a": batch["a"].filter(good), "b": batch["b"].filter(good)}

    return arrow_map(pairs.join(of("a"), "a").join(of("b"), "b"), compare, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, sizes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The pairs (a, b) of classes whose sets reach the similarity, and the stored tables that they are read from.

    Two bytes of each hash bound the overlap from above; only pairs that pass so are compared by their whole sets.
    """
    pairs = stored(pairs.select("a", "b").distinct(), "join-pairs")
    wanted = stored(pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
                    .join(sizes.select("class", "id"), "class"), "join-wanted")

    def keys(batch: pa.RecordBatch):
        yield mix(np.asarray(batch["class"]).astype(np.uint64) ^ mix(np.asarray(batch["id"]).astype(np.uint64)))

    bits = texts.sparkSession.sparkContext.broadcast(bitmap(wanted.select("class", "id"), keys, 24))

    def whole(batch: pa.RecordBatch):
        for i, j, w in words_of(batch["text"], lower=True):
            own = sets(w)
            cls = np.array([class_of(s) for s in own], np.int64)
            ids = np.asarray(batch["id"].slice(i, j - i).fill_null(0))
            hit = has_bits(bits.value, mix(cls.astype(np.uint64) ^ mix(ids.astype(np.uint64))), 24)
            some = [own[k] for k in np.flatnonzero(hit)]
            yield {"id": ids[hit], "class": cls[hit], "own": pa.array([s.tobytes() for s in some], pa.binary()),
                   "ends": pa.array([np.sort(s.astype(np.uint16)).tobytes() for s in some], pa.binary())}

    found = stored(arrow_map(texts.where("id is not null"), whole, "id long, class long, own binary, ends binary").join(wanted, ["class", "id"], "left_semi")
                   .dropDuplicates(["class", "id"]).select("class", "own", "ends"), "join-sets")
    likely = stored(_compared(pairs, found, "ends", np.uint16, _at_most), "join-likely")
    return _compared(likely, found, "own", np.uint64, _common), [pairs, wanted, found, likely]


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row: the smallest id that links lead to, itself included."""
    texts = _narrow(docs, id_col, text_col)
    rows = stored(classes(texts), "join-classes")
    usable = rows.where("n > 0 and id is not null")
    known = texts.where("id is not null")
    sent = sketched(known)
    # written, so that the join reads both sides through shuffles of its own and Spark can split a hot shingle
    shared = stored(postings(known, sent).select("token", "class").groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
                    .where("lo != hi").select("token"), "join-shared")

    def tokens(batch: pa.RecordBatch):
        yield mix(np.asarray(batch["token"]).astype(np.uint64))

    # the second time, shingles that one class alone holds leave their task by a false hit of the bitmap at most
    held = texts.sparkSession.sparkContext.broadcast(bitmap(shared, tokens, HELD_BITS))
    plain = stored(postings(known, sent, held).join(shared, "token").distinct(), "join-lists")
    lists = plain
    own = lists.groupBy("class").agg(F.first("l").alias("l"), F.count("*").alias("kept"))
    sizes = stored(usable.groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n")).join(own, "class"), "join-sizes")
    lists = stored(lists.join(sizes.select("class", "n", (F.col("kept") / (F.col("n") - F.ceil(F.col("n") * NUM / DEN) + F.col("l"))).alias("common")),
                              "class"), "join-postings")
    forget(plain, shared)
    # each class with the class of most common shingles in its lists
    centre = stored(lists.groupBy("token").agg(F.max(F.struct("common", "class", "n", "l", "place")).alias("c")).select("token", "c.*"), "join-centres")
    near = _side(lists, "a").join(_side(centre, "b"), "token").where((F.col("a") != F.col("b")) & _counts())
    best = _matched(near).groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    found, used = verified(best, texts, sizes)
    links = stored(found, "join-links")
    forget(centre, *used)
    roots = stored(components(links), "join-roots")
    # all pairs of one list that are not in one component yet
    rest = _apart(lists, roots)
    pairs = (_side(rest, "a").join(_side(rest, "b"), "token").where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & _counts()))
    found, used = verified(_matched(pairs), texts, sizes)
    links = stored(links.union(found), "join-all-links")
    forget(lists, rest, *used)
    roots = components(links)
    first = usable.groupBy("class").agg(F.min("id").alias("first"))
    # the smallest id of each class, then of each component
    rooted = first.join(roots, F.col("class") == F.col("vertex"), "left").select(
        "class", F.coalesce("root", "class").alias("root"), "first")
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "join-least")
    named = rooted.join(least, "root").select("class", "component_id")
    out = rows.join(named, "class", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))).alias("component_id"))


def _apart(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """``lists`` with each class's ``root``, only tokens that classes of several components hold."""
    rooted = lists.join(roots, F.col("class") == F.col("vertex"), "left").withColumn("root", F.coalesce("root", "class")).drop("vertex")
    several = rooted.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 != r2").select("token")
    several = stored(several, "join-several")
    out = stored(rooted.join(several, "token"), "join-apart")
    forget(several)
    return out


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, with all columns, less all but one document of each component: the one whose id is the component's.

    Of rows with one id one stays; rows with a null id all stay. Rows whose id may be concerned (by a bitmap of fixed
    size) are decided by a join, all others pass without a shuffle.
    """
    found = stored(join(docs, id_col, text_col).where(F.col(id_col).isNotNull())
                   .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col("component_id") == F.col(id_col)).alias("stays"), F.count("*").alias("rows"))
                   .where("not stays or rows > 1"), "join-concerned")

    def keys(batch: pa.RecordBatch):
        yield mix(np.asarray(batch["id"]).astype(np.uint64))

    bits = docs.sparkSession.sparkContext.broadcast(bitmap(found.select("id"), keys, 24))
    at = docs.columns.index(id_col)

    def only(inside: bool):
        def run(batches):
            for batch in batches:
                ids = batch.column(at)
                hit = has_bits(bits.value, mix(np.asarray(ids.cast(pa.int64()).fill_null(0)).astype(np.uint64)), 24) & ~np.asarray(ids.is_null())
                yield batch.filter(pa.array(hit == inside))
        return map_batches(docs, run, docs.schema)

    name = f"{unused(docs.columns)}gone"
    gone = found.where(~F.col("stays")).select(F.col("id").alias(name))
    concerned = only(True)
    kept = concerned.join(gone, concerned[id_col] == F.col(name), "left_anti").dropDuplicates([id_col])
    return only(False).unionByName(kept)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 5-word shingles at a Jaccard similarity of 0.75."""
    return join(table(spark, sf_dir, "documents"))
