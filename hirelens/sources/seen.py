"""A store of seen keys that a run reads in proportion to its own keys.

Keys lie in ``buckets`` folders by hash. Beside them lies a bitmap of ``bits`` bits a bucket, of fixed size however many
keys there are: a key whose bit isn't set was never seen. A run tests its keys against the bitmaps, and only buckets in which
some key may be are read at all. Appends add small files; ``compact`` rewrites the keys, each once, in one sorted file a
bucket (with more buckets and bits where the store has outgrown them). Builds of the store and of its bitmaps are folders of
their own that count once Spark has committed them, so a reader never sees half of one, and an append that dies half-way
is done again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import strip_ws
from .store import _filesystem, _listed, _path_of

#: Bits of one stored bitmap row.
ROW_BITS = 32_768


class SeenStore:
    """Seen keys under ``root``, a folder that all executors share. A store that exists keeps its buckets and bits."""

    def __init__(self, spark: SparkSession, root: str, key: str = "url", buckets: int = 256, bits: int = 2**20):
        if buckets < 1 or bits < ROW_BITS or bits % ROW_BITS:
            raise ValueError(f"bits are a multiple of {ROW_BITS}, buckets at least 1")
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.buckets, self.bits = buckets, bits
        have = self._version()
        if have:
            self.version, self.buckets, self.bits = have
        else:
            self.version = 0

    # folders: v=<version>-<buckets>-<bits>/keys/bucket=<n>, …/maps/m=<number>

    def _version(self) -> tuple[int, int, int] | None:
        found = []
        for e in _listed(self.spark, self.root):
            m = re.search(r"/v=(\d+)-(\d+)-(\d+)$", _path_of(e))
            if m and self._maps(_path_of(e)):
                found.append(tuple(int(x) for x in m.groups()))
        return max(found, default=None)

    def _maps(self, path: str) -> str | None:
        """The newest committed bitmaps of a version."""
        found = [(int(m[1]), _path_of(e)) for e in _listed(self.spark, f"{path}/maps") if (m := re.search(r"/m=(\d+)$", _path_of(e)))]
        for _, p in sorted(found, reverse=True):
            _, mark, fs = _filesystem(self.spark, f"{p}/_SUCCESS")
            if fs.exists(mark):
                return p
        return None

    @property
    def path(self) -> str:
        return f"{self.root}/v={self.version}-{self.buckets}-{self.bits}"

    def _placed(self, keys: DataFrame) -> DataFrame:
        """Distinct stripped keys that aren't blank, with their bucket and bit."""
        k = keys.select(strip_ws(self.key).alias(self.key)).where(F.col(self.key).isNotNull() & (F.col(self.key) != "")).distinct()
        return k.select(self.key, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket"),
                        F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(self.bits)).alias("_bit"))

    def _read_maps(self, path: str | None = None) -> DataFrame:
        have = self._maps(path or self.path)
        schema = "bucket int, part int, map binary"
        return self.spark.read.schema(schema).parquet(have) if have else self.spark.createDataFrame([], schema)

    def _map_of(self, placed: DataFrame) -> DataFrame:
        return placed.groupBy("bucket", F.expr(f"cast(_bit div {ROW_BITS} as int) as part")).agg(
            F.expr(f"bitmap_construct_agg(_bit % {ROW_BITS}) as map"))

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets in which some of ``keys`` may be (at most ``buckets`` numbers)."""
        placed = self._placed(keys)
        maps = self._read_maps().withColumnRenamed("bucket", "_of")
        own = placed.join(maps, (F.col("bucket") == F.col("_of")) & (F.col("part") == F.expr(f"_bit div {ROW_BITS}")))
        byte: Column = F.conv(F.hex(F.expr(f"substring(map, cast((_bit % {ROW_BITS}) div 8 as int) + 1, 1)")), 16, 10).cast("int")
        hit = own.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 as int))")) != 0)
        return sorted(r.bucket for r in hit.select("bucket").distinct().collect())

    def keys(self, buckets: list[int] | None = None) -> DataFrame:
        """The seen keys (of some buckets); a key may come more than once until ``compact``. Other buckets aren't listed."""
        have = {int(m[1]): _path_of(e) for e in _listed(self.spark, f"{self.path}/keys") if (m := re.search(r"/bucket=(\d+)$", _path_of(e)))}
        paths = [p for b, p in sorted(have.items()) if buckets is None or b in set(buckets)]
        schema = f"`{self.key}` string"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def relevant(self, keys: DataFrame) -> DataFrame:
        """The seen keys among which all of ``keys`` that were seen are; the seen side of an anti-join (``dedupe.unseen``)."""
        return self.keys(self.touched(keys))

    def add(self, keys: DataFrame) -> None:
        """Add keys that the store doesn't hold yet. The bitmaps follow once the keys are written, so they never miss one:
        until then a key counts as unseen, and adding it again is harmless."""
        fresh = self._placed(keys)
        if self._version():
            fresh = fresh.join(self.relevant(keys), self.key, "left_anti")
        fresh.drop("_bit").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/keys")
        self._write_maps(self._read_maps().unionByName(self._map_of(fresh)))

    def _write_maps(self, maps: DataFrame, path: str | None = None) -> None:
        path = path or self.path
        have = self._maps(path)
        number = int(have.rpartition("=")[2]) + 1 if have else 0
        merged = maps.groupBy("bucket", "part").agg(F.expr("bitmap_or_agg(map) as map"))
        merged.write.mode("overwrite").parquet(f"{path}/maps/m={number}")
        self._drop([f"{path}/maps/m={n}" for n in range(max(0, number - 2), number - 1)])

    def compact(self, buckets: int | None = None, bits: int | None = None) -> None:
        """Each key once, one sorted file a bucket, in a new version; the version before the old one goes."""
        every, gone = self.keys(), self.version - 1
        self.buckets, self.bits, self.version = buckets or self.buckets, bits or self.bits, self.version + 1
        placed = self._placed(every)
        placed.drop("_bit").repartition(self.buckets, "bucket").sortWithinPartitions("bucket", self.key).write.mode("overwrite").partitionBy(
            "bucket").parquet(f"{self.path}/keys")
        self._write_maps(self._map_of(self._placed(self.keys())))
        self._drop([_path_of(e) for e in _listed(self.spark, self.root) if re.search(rf"/v={gone}-", _path_of(e))])

    def _drop(self, paths: list[str]) -> None:
        for path in paths:
            _, p, fs = _filesystem(self.spark, path)
            fs.delete(p, True)
