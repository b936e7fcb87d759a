"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sizes are words. Sources share all words by weight; no target exceeds ``most`` times its source's size, what is left over
is shared again by weight. Every source is dealt into shards by a seeded hash (so many that a shard has about
``shard_words`` words), and blocks of ``block`` words go to the shards by highest quotients target / (2 * quota + 1): the
divisor that gives all blocks is searched with a few aggregations over the shards, equal quotients at the end go by
source and shard. Within a shard the documents follow one another in seeded order as a ring of words; its quota is taken
as whole passes over the ring and, for the rest, the blocks that follow a seeded starting block. So a document's taken
words are passes * size plus the words of at most two pieces of it, and never above ``most`` times its size.

Defined cases: a null text has size 0; a null source is one source, the last. Rows equal in id, text and source are
treated alike (each takes the same words). Extra columns are ignored by ``plan`` and kept by ``apply``. An empty table
gives an empty result; without words nothing is taken. Where the limits leave fewer blocks than there are, or shards
smaller than half a block make the divisor leave its range, quotas are the rounded targets.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import arrow_map, map_batches, maybe_broadcast, stored, table, unused
from hirelens.llm.textops import words_of

WEIGHTS = (5, 2, 1)


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, text_key, source, size) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch):
        for i, j, w in words_of(batch["text"], hashed=False):
            yield {**{c: batch[c].slice(i, j - i) for c in ("id", "text_key", "source")}, "size": w.counts()}

    return arrow_map(rows, run, f"id {docs.schema[id_col].dataType.simpleString()}, text_key long, source string, size long")


def weighed(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """``sources`` with ``weight``: the weights in turn along the order by code point, null last; no task sees all sources."""
    parted = stored(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix-sources")
    counts = {r["part"]: r["n"] for r in parted.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for part in sorted(counts):  # as many as there are partitions
        offsets += [F.lit(part), F.lit(before)]
        before += counts[part]
    if not offsets:
        return parted.select("source", "size", F.lit(0).alias("weight"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + F.create_map(*offsets)[F.col("part")]
    turn = F.pmod(place, F.lit(len(weights)))
    return parted.select("source", "size", F.element_at(F.array(*map(F.lit, weights)), turn + 1).alias("weight"))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, size, weight, target): shares of all words, limited to ``most`` times the size, the excess shared again."""
    sources = stored(weighed(sources, weights), "mix-weighed")
    total = sources.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    level, limit = 0.0, F.col("size") * most
    while total:
        above = F.col("weight") * F.lit(level) >= limit
        weight, fixed = sources.agg(F.sum(F.when(~above, F.col("weight"))), F.sum(F.when(above, limit))).first()
        new = (total - (fixed or 0)) / weight if weight else level
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), limit.cast("double")))


def _quota(divisor: Column, block: int) -> Column:
    """Blocks of a shard at a divisor: the nearest whole number to target / (block * divisor), below the limit."""
    return F.least(F.floor(F.col("target") / (F.lit(float(block)) * divisor) + 0.5), F.col("limit")).cast("long")


def apportion(shards: DataFrame, blocks: int, block: int) -> DataFrame:
    """``shards`` (source, shard, words, target, limit) with ``quota``, by Sainte-Lague for ``blocks`` blocks."""
    ask = 32
    low, high = 0.5, 2.0  # more blocks than wanted at low, fewer at high
    got = shards.agg(*[F.coalesce(F.sum(_quota(F.lit(x), block)), F.lit(0)) for x in (low, high)]).first()
    if not got[0] >= blocks >= got[1]:
        return shards.withColumn("quota", _quota(F.lit(1.0), block))
    at = {low: got[0], high: got[1]}
    while blocks not in at.values() and high - low > 1e-13 * high:
        grid = [float(x) for x in np.linspace(low, high, ask + 2)[1:-1]]
        at |= dict(zip(grid, shards.agg(*[F.sum(_quota(F.lit(x), block)) for x in grid]).first()))
        low, high = max(x for x in at if at[x] > blocks), min(x for x in at if at[x] <= blocks)
        if at[high] == blocks:
            break
    high = next((x for x in sorted(at) if at[x] == blocks), high)
    quota = shards.withColumn("quota", _quota(F.lit(high), block))
    if at[high] == blocks:
        return quota
    # shards whose quotients are equal at the end: the first ones by source and shard get a block more
    tied = quota.where(_quota(F.lit(low), block) > F.col("quota")).orderBy(F.col("source").asc_nulls_last(), "shard").limit(blocks - at[high])
    more = tied.select(F.col("source").alias("s"), F.col("shard").alias("h"), F.lit(1).alias("more"))
    return (quota.join(more, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")), "left")
            .withColumn("quota", F.col("quota") + F.coalesce("more", F.lit(0))).drop("s", "h", "more"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
         most: int = 3, block: int = 4, shard_words: int = 1_000_000, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(rows, taken): sizes of all rows, and for each distinct (id, text_key, source) what the mix takes of it.

    ``taken`` has source_size, target, passes and two pieces as word places: from1, words1, from2, words2.
    """
    rows = stored(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    wanted = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("size")), weights, most), "mix-targets").select(
        F.col("source").alias("s"), F.col("size").alias("source_size"), "target")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    distinct = rows.groupBy("id", "text_key", "source", "size").agg(F.count("*").alias("copies"))
    spread = (distinct.join(maybe_broadcast(wanted), F.col("source").eqNullSafe(F.col("s"))).drop("s")
              .withColumn("key", F.xxhash64(F.lit(seed), "id", "text_key"))
              .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "id", "text_key"), pieces)))
    spread = stored(spread, "mix-spread")
    shards = stored(spread.groupBy("source", "shard").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("whole"))
        .select("source", "shard", "words", F.when(F.col("source_size") > 0, F.col("whole") * F.col("words") / F.col("source_size")).otherwise(0.0).alias("target"),
                F.floor(F.col("words") * most / block).alias("limit")), "mix-shards")
    total = shards.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    quotas = apportion(shards, round(total / block), block).select(
        F.col("source").alias("s"), F.col("shard").alias("h"), "words", (F.col("quota") * block).alias("wanted"))
    placed = spread.join(maybe_broadcast(stored(quotas, "mix-quotas")), F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")))
    ring = Window.partitionBy("source", "shard").orderBy("key", "id", "text_key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("size") * F.col("copies")
    start = F.expr(f"pmod(xxhash64({seed + 2}, source, shard), greatest(words, 1)) div {block} * {block}")
    placed = (placed.withColumn("stop", F.sum(own).over(ring)).withColumn("begin", F.col("stop") - own)
              .withColumn("passes", F.expr("case when words > 0 then wanted div words else 0L end"))
              .withColumn("rest", F.col("wanted") - F.col("passes") * F.col("words")).withColumn("a", start))

    def piece(lo: Column, hi: Column, k: int) -> list[Column]:
        first = F.greatest(F.col("begin"), lo)
        length = F.greatest(F.lit(0), F.least(F.col("stop"), hi) - first)
        return [F.when(length > 0, F.floor((first - F.col("begin")) / F.col("copies"))).otherwise(0).cast("long").alias(f"from{k}"),
                F.floor(length / F.col("copies")).cast("long").alias(f"words{k}")]

    taken = placed.select(
        "id", "text_key", "source", "size", "source_size", "target", "passes",
        *piece(F.col("a"), F.col("a") + F.col("rest"), 1), *piece(F.lit(0), F.col("a") + F.col("rest") - F.col("words"), 2))
    return rows, taken.withColumn("taken", F.col("passes") * F.col("size") + F.col("words1") + F.col("words2"))


def mix_report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, size, source_size, target, taken) of every row."""
    rows, taken = plan(docs, id_col, **options)
    t = taken.select(F.col("id").alias("i"), F.col("text_key").alias("k"), F.col("source").alias("s"), "source_size", "target", "taken")
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")) & F.col("source").eqNullSafe(F.col("s"))
    return rows.join(t, same).select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = None,
          **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row with the whole text for each pass, one for each piece.

    A piece's text goes from its first to its last word; ``length_col``, if given, is set to each text's length.
    """
    _, taken = plan(docs, id_col, text_col, source_col, **options)
    own = unused(docs.columns)
    t = taken.where(F.col("taken") > 0).select(
        F.col("id").alias(f"{own}i"), F.col("text_key").alias(f"{own}k"), F.col("source").alias(f"{own}s"), F.col("passes").alias(f"{own}passes"),
        *[F.col(c).alias(f"{own}{c}") for c in ("from1", "words1", "from2", "words2")])
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    joined = docs.join(t, F.col(id_col).eqNullSafe(F.col(f"{own}i")) & (key == F.col(f"{own}k"))
                       & F.col(source_col).cast("string").eqNullSafe(F.col(f"{own}s"))).drop(f"{own}i", f"{own}k", f"{own}s")
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            whole = np.repeat(np.arange(batch.num_rows), np.asarray(batch[f"{own}passes"]))
            out = [batch.take(pa.array(whole)).select(names)]
            for k in (1, 2):
                begin, size = np.asarray(batch[f"{own}from{k}"]), np.asarray(batch[f"{own}words{k}"])
                some = np.flatnonzero(size > 0)
                texts, base = [], 0
                for i, j, w in words_of(batch.column(at), hashed=False):
                    for r in some[np.searchsorted(some, i): np.searchsorted(some, j)] - i:
                        first = w.first[r] + begin[i + r]
                        texts.append(w.raw[w.starts[first]: w.ends[first + size[i + r] - 1]].tobytes().decode("utf-8"))
                got = batch.take(pa.array(some)).select(names)
                out.append(got.set_column(at, names[at], pa.array(texts, got.schema.field(at).type)))
            for part in out:
                if part.num_rows:
                    yield part

    mixed = map_batches(joined, run, docs.schema)
    return mixed.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col else mixed


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, sources weighing 5, 2, 1 in turn."""
    return mix_report(table(spark, sf_dir, "documents"))
