"""Marts built once and read until they are old.

A store keeps each mart as Parquet under a shared folder, a folder a build, whose name holds the load time and a digest of
what it was built from. ``read`` gives the newest build that is neither older than ``max_age`` nor built from other
sources; where there is none, it builds the mart and keeps it. So many reports scan one small table, and none of them
computes a mart. Folders are listed and removed through the path's Hadoop filesystem; a build counts once Spark has
committed it, so readers never see half of one, and two builders at once only make two builds.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Seconds for which a mart is fresh.
MAX_AGE = 3600.0
#: Builds kept besides the newest, for readers that are still at them.
OLDER = 1


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list[str]:
    """What Hadoop says of each entry of a folder (path, length, times)."""
    _, p, fs = _filesystem(spark, path)
    return [f.toString() for f in fs.listStatus(p)] if fs.exists(p) else []


def _path_of(entry: str) -> str:
    return re.search(r"\{path=([^;]*)", entry)[1]


def source_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of the tables in the folders ``paths``: for each entry its name, its modification time, and its length or, of a
    folder, the files and bytes below it (a few calls an entry, however many files it has)."""
    found = []
    for path in paths:
        entries = _listed(spark, path)
        found.append(f"{path} {len(entries)}")
        for e in entries:
            found.append(" ".join(re.findall(r"(?:path|length|modification_time)=[^;]*", e)))
            if "isDirectory=true" in e:
                _, p, fs = _filesystem(spark, _path_of(e))
                found[-1] += fs.getContentSummary(p).toString()
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


class MartStore:
    """Builds of marts under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, max_age: float = MAX_AGE):
        self.spark, self.root, self.max_age = spark, root.rstrip("/"), max_age

    def builds(self, name: str) -> list[tuple[float, str, str]]:
        """(load time, state, path) of a mart's builds, newest first, also of those that aren't committed."""
        out = []
        for entry in _listed(self.spark, f"{self.root}/{name}"):
            path = _path_of(entry)
            at, _, state = path.rpartition("/")[2].removeprefix("at=").partition("-")
            if at.isdigit():
                out.append((int(at) / 1000, state, path))
        return sorted(out, reverse=True)

    def committed(self, path: str) -> bool:
        _, p, fs = _filesystem(self.spark, f"{path}/_SUCCESS")
        return fs.exists(p)

    def read(self, name: str, build: Callable[[], DataFrame], now: float | None = None, state: str = "") -> DataFrame:
        """The mart ``name`` as of ``now`` (seconds; the clock's by default): a fresh build of the same ``state``, or a new one.

        ``state`` says what it is built from (``source_state``). A build that lies in the future of ``now`` doesn't count.
        """
        now = time.time() if now is None else now
        for at, of, path in self.builds(name):
            if of == state and 0 <= now - at < self.max_age and self.committed(path):
                return self.spark.read.parquet(path)
        path = f"{self.root}/{name}/at={int(now * 1000)}-{state}"
        build().write.mode("overwrite").parquet(path)
        self._drop_old(name, now)
        return self.spark.read.parquet(path)

    def _drop_old(self, name: str, now: float) -> None:
        """Builds that can't be read any more go, but for the newest of them."""
        for at, _, path in self.builds(name)[1 + OLDER:]:
            if now - at >= self.max_age:
                _, p, fs = _filesystem(self.spark, path)
                fs.delete(p, True)
