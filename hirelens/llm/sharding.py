"""Weighted rendezvous hashing of stable record keys to shards.

A record's key and each shard's number give a hash u in (0, 1); the record goes to the shard with the largest
-weight / ln(u) (ties to the smaller number). So shards get records in proportion to their weights, nothing but key and
weights decides, and when a shard is added the others' scores stay: records move only into the new one.

``assign`` is one pass over the rows without a shuffle. ``numbered`` gives the rows of each shard gapless slots, in the
order of (key, size, crc32): a sort over all tasks with sums carried between them (``running``), for which no text is
shuffled. ``write`` puts whole records into files by (shard, slot range), so that no task writes a whole shard.

Defined cases: a null key hashes as the empty text; a null text has 0 bytes and the crc32 of none (0). Records with equal
keys share a shard, whatever their text; repeated rows each get a slot of their own. Extra columns stay (``assign``) and
may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import table
from hirelens.llm.running import running

#: Hexadecimal digits of md5 that make u: 52 bits, exact as double.
DIGITS = 13
#: Bytes that a record takes besides its text.
OVERHEAD = 16


def score(key: Column, shard: Column, weight: Column) -> Column:
    """-weight / ln(u) of a key (text) for a shard; larger is nearer."""
    digits = F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary")), 1, DIGITS)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**DIGITS))
    return -weight / F.log(u)


def nearest(key: Column, weights: Sequence[float]) -> Column:
    """struct(score, back) of the best shard of a key; the shard is -back. A weight of 0 gets nothing; one is above 0."""
    live = [(j, float(w)) for j, w in enumerate(weights) if w > 0]
    if not live or not all(math.isfinite(w) and w >= 0 for w in weights):
        raise ValueError("weights are finite, not negative, and one is above 0")
    shards = F.array(*[F.struct(F.lit(j).alias("shard"), F.lit(w).alias("weight")) for j, w in live])
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.array_max(F.transform(shards, lambda s: F.struct(score(text, s["shard"], s["weight"]).alias("score"), (-s["shard"]).alias("back"))))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard (0 ..) of a key by the weights of the shards."""
    return -nearest(key, weights)["back"]


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with column ``name``: the shard of each record."""
    return docs.withColumn(name, shard_of(F.col(key), weights))


def numbered(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", grow: float | None = None) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) of each record; ``grow``: weight of one more shard."""
    utf8 = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), (F.octet_length(utf8) + OVERHEAD).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32"))
    rows = rows.withColumn("best", nearest(F.col("key"), weights)).withColumn("shard", -F.col("best.back"))
    new = score(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(len(weights)), F.lit(float(grow or 0)))
    grown = F.when(new > F.col("best.score"), F.lit(len(weights))).otherwise(F.col("shard")) if grow else F.lit(None).cast("int")
    rows = rows.withColumn("grown_shard", grown)
    # equal rows may be a third of all: their number in the input lets the sort deal them over tasks
    rows = rows.drop("best").select("*", F.col("shard").cast("long").alias("of"), F.lit(1).cast("long").alias("slot"), F.monotonically_increasing_id().alias("at"))
    got = running(rows, "of", [F.col("key").asc_nulls_first(), "size", "text_crc32", "at"], ["slot"], "shard-slots")
    return got.select("key", "size", "text_crc32", "shard", F.col("slot_before").alias("slot"), "grown_shard")


def write(docs: DataFrame, weights: Sequence[float], path: str, key: str = "doc_id", files_per_shard: int = 8) -> None:
    """Whole records as Parquet, a folder a shard, in up to ``files_per_shard`` files each; a rerun replaces the folder."""
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_shard))
    name = "shard"
    if name in docs.columns:
        raise ValueError(f"{name} is the name of the partition column")
    placed = assign(docs, weights, key, name)
    placed.repartition(len(weights) * files_per_shard, name, spread).write.mode("overwrite").partitionBy(name).parquet(path)


def op12_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 equal shards, and over 41."""
    got = numbered(table(spark, sf_dir, "documents"), [1.0] * 40, grow=1.0)
    return got.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


SQL = """
with shards as (select range::int as shard from range(41)),
d as (select row_number() over () as rid, doc_id, coalesce(doc_id::varchar, '') as key, strlen(coalesce(text, ''))::bigint + 16 as size,
             coalesce(text, '') as text from documents),
-- crc32: the table of byte steps, then one step a byte of the text
steps as (select list(c order by b) as t from (select b, list_reduce(list_prepend(b::bigint, range(8)), lambda c, x:
          case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as c from range(256) r(b)) s),
bytes as (select rid, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint) as y from d),
crc as (select rid, xor(list_reduce(list_prepend(4294967295::bigint, y), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::bigint) as text_crc32
        from bytes, steps),
scores as (select rid, shard, -1.0 / ln((('0x' || substr(md5(key || ':' || shard), 1, 13))::bigint::double + 0.5) / 4503599627370496.0) as score from d, shards),
best as (select rid, arg_min(shard, struct_pack(a := -score, b := shard)) filter (where shard < 40) as shard,
                arg_min(shard, struct_pack(a := -score, b := shard)) as grown_shard from scores group by rid)
select doc_id, size, text_crc32, 'key' as law, shard, grown_shard,
       row_number() over (partition by shard order by doc_id nulls first, size, text_crc32) - 1 as slot
from d join best using (rid) join crc using (rid)
"""
