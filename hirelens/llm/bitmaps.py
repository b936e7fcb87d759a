"""Fixed-size tables over hashes, summed by Spark: a bounded filter or sketch that a broadcast may carry.

Their size is a parameter and does not follow the data. They only save work: what they let through wrongly is decided
exactly afterwards, so results never depend on them.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hirelens.llm.common import map_batches

SEGMENTS = 64


def counters(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log2_size: int) -> np.ndarray:
    """Counts of hashes by their ``log2_size`` upper bits, over all rows of ``df``; 2**log2_size values of 32 bits.

    Each task sends one row per segment that it has counts for; the segments are summed separately.
    """
    width = 1 << (log2_size - 6)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << log2_size, np.uint32)
        for batch in batches:
            for h in hashes(batch):
                slots, n = np.unique(h >> np.uint64(64 - log2_size), return_counts=True)
                total[slots] += n.astype(np.uint32)
        parts = [(k, total[k * width: (k + 1) * width]) for k in range(SEGMENTS)]
        parts = [(k, p) for k, p in parts if p.any()]
        # counts are small in a task: each is sent in one byte, larger ones once more as (place, rest)
        rows = []
        for k, p in parts:
            big = np.flatnonzero(p > 255).astype(np.uint32)
            rows.append((k, np.minimum(p, 255).astype(np.uint8).tobytes(), big.tobytes(), (p[big] - 255).astype(np.uint32).tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                             ["segment", "low", "place", "rest"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.uint64)
        for batch in batches:
            for low, place, rest in zip(*(batch.column(c).to_pylist() for c in ("low", "place", "rest"))):
                total += np.frombuffer(low, np.uint8)
                total[np.frombuffer(place, np.uint32)] += np.frombuffer(rest, np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()),
                                          pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())], ["segment", "total"])

    parts = map_batches(df, count, "segment int, low binary, place binary, rest binary")
    got = parts.groupBy("segment").applyInArrow(add, "segment int, total binary").toArrow()
    out = np.zeros(1 << log2_size, np.uint32)
    for k, total in zip(got["segment"].to_pylist(), got["total"].to_pylist()):
        out[k * width: (k + 1) * width] = np.frombuffer(total, np.uint32)
    return out


def bitmap(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log2_size: int) -> np.ndarray:
    """The bits (packed, 2**log2_size of them) at the two slots of each hash of all rows of ``df``.

    Each task sends its set slots as sorted lists by segment; the segments are united separately.
    """
    width = 1 << (log2_size - 6)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (log2_size - 3), np.uint8)
        for batch in batches:
            for h in hashes(batch):
                set_bits(bits, h, log2_size)
        step = width // 8
        rows = [(k, bits[k * step: (k + 1) * step]) for k in range(SEGMENTS)]
        rows = [(k, _packed(b)) for k, b in rows if b.any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["segment", "bits"])

    def unite(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width // 8, np.uint8)
        for batch in batches:
            for data in batch.column("bits").to_pylist():
                total |= _unpacked(data, width // 8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([_packed(total)], pa.binary())], ["segment", "bits"])

    got = map_batches(df, mark, "segment int, bits binary").groupBy("segment").applyInArrow(unite, "segment int, bits binary").toArrow()
    out = np.zeros(1 << (log2_size - 3), np.uint8)
    step = width // 8
    for k, data in zip(got["segment"].to_pylist(), got["bits"].to_pylist()):
        out[k * step: (k + 1) * step] = _unpacked(data, step)
    return out


def _packed(bits: np.ndarray) -> bytes:
    """The bytes that aren't 0, as gaps and values where that is shorter."""
    at = np.flatnonzero(bits)
    if 3 * len(at) < len(bits):
        gaps = np.diff(at, prepend=-1) - 1
        if not len(gaps) or gaps.max() < 2**16:
            return b"g" + gaps.astype(np.uint16).tobytes() + bits[at].tobytes()
    return b"b" + bits.tobytes()


def _unpacked(data: bytes, size: int) -> np.ndarray:
    if data[:1] == b"b":
        return np.frombuffer(data, np.uint8, offset=1)
    n = (len(data) - 1) // 3
    out = np.zeros(size, np.uint8)
    out[np.cumsum(np.frombuffer(data, np.uint16, n, 1).astype(np.int64) + 1) - 1] = np.frombuffer(data, np.uint8, n, 1 + 2 * n)
    return out


def _slots(hashes: np.ndarray, log2_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two slots of each hash: by its upper bits, and by the upper bits of a multiple."""
    shift = np.uint64(64 - log2_size)
    return hashes >> shift, (hashes * np.uint64(0xD1342543DE82EF95)) >> shift


def set_bits(bits: np.ndarray, hashes: np.ndarray, log2_size: int) -> None:
    for slot in _slots(hashes, log2_size):
        np.bitwise_or.at(bits, (slot >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8)))


def has_bits(bits: np.ndarray, hashes: np.ndarray, log2_size: int) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for slot in _slots(hashes, log2_size):
        out &= (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out
