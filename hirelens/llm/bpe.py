"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Every match of the split pattern is merged on its own. Adjacent pairs that form a vocabulary entry wait in one bucket
per merge rank, which holds the positions of their left parts in a linked list of parts. Two levels of bitmaps tell
which buckets hold anything, so the next rank is found by two find-first-set steps however long the match is. Entries
made stale by a merge next to them are skipped when they come up. Equal matches are merged once per worker.

A null text encodes like an empty one: no ids. Repeated rows and repeated ids are encoded row by row; extra columns are
not carried. A vocabulary must hold all 256 single bytes, as rank files do.
"""

from __future__ import annotations

import base64
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import arrow_map, spans_to_list, table
from hirelens.llm.textops import CHUNK_BYTES, runs, span_hashes, text_bytes

#: A worker forgets its merged matches when it holds so many, or four times as many ids of them.
CACHE_ENTRIES = 1_000_000
#: Code points that are classed at once; memory beside the JVM is scarce, and a list of all of them takes 100 MB.
CLASS_BLOCK = 1 << 12
# The split pattern of the public byte-level vocabularies, and the endings in it. It is applied to whole
# columns of code points at once; any other pattern goes through the regex library.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def read_ranks(path: str) -> bytes:
    """The rank file's bytes (read on the driver, sent to the tasks; about a megabyte)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    ranks = {}
    for line in data.splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
    return ranks


class RankQueue:
    """Positions by merge rank under two levels of bitmaps; the lowest rank's smallest position comes first.

    Words of the bitmaps are Python integers of ``WORD`` bits, so find-first-set is ``(x & -x).bit_length() - 1``.
    """

    WORD = 256

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // self.WORD + 1)
        self.top = 0
        self.buckets: list[list[int] | None] = [None] * (ranks + 1)


class Encoder:
    """Merges by rank: ``merge`` gives the ids of one match, ``encode_batch`` those of many texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = pattern
        self.queue = RankQueue(max(ranks.values()) + 1)
        self._forget()

    def merge(self, piece: bytes) -> tuple[int, ...]:
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return (whole,)
        n, none = len(piece), 1 << 40
        low, buckets, top = self.queue.low, self.queue.buckets, 0
        # parts are linked by their starts; place n (also reached as -1) ends the list on both sides
        after, before = [*range(1, n + 1), n], [*range(-1, n)]
        # rank of the pair whose left part starts here. Only pairs that rank below their left and not above their right
        # neighbour wait in the queue: no other can be the next one
        want = [get(piece[i: i + 2], none) for i in range(n - 1)]
        want += (none, none)
        push, left = [], none
        for i in range(n - 1):
            r = want[i]
            if r < left and r <= want[i + 1]:
                push.append((r, i))
            left = r
        while True:
            for r, i in push:
                bucket = buckets[r]
                if bucket is None:
                    buckets[r] = [i]
                    j = r >> 8
                    low[j] |= 1 << (r & 255)
                    top |= 1 << j
                else:
                    heappush(bucket, i)
            if not top:
                break
            j = (top & -top).bit_length() - 1
            word = low[j]
            r = (j << 8) + (word & -word).bit_length() - 1
            bucket = buckets[r]
            if len(bucket) == 1:
                i = bucket[0]
                buckets[r] = None
                word &= word - 1
                low[j] = word
                if not word:
                    top ^= 1 << j
            else:
                i = heappop(bucket)
            push = []
            if want[i] != r:
                continue  # stale: a merge beside it came first
            j = after[i]
            k = after[j]
            after[i] = k
            before[k] = i
            old_right, want[j] = want[j], none
            right = want[i] = get(piece[i: after[k]], none) if k < n else none
            p = before[i]
            if p >= 0:
                old_left = want[p]
                pair = want[p] = get(piece[p:k], none)
                q = before[p]
                if pair <= right and pair < want[q]:
                    if pair < none:
                        push.append((pair, p))
                elif want[q] <= pair and want[q] > old_left and q >= 0 and want[q] < want[before[q]]:
                    push.append((want[q], q))
            else:
                pair = none
            if right < pair and right <= want[k]:
                push.append((right, i))
            elif old_right <= want[k] < right and want[k] <= want[after[k]]:
                push.append((want[k], k))
        ranks, out, i = self.ranks, [], 0
        while i < n:
            j = after[i]
            out.append(ranks[piece[i:j]])
            i = j
        return tuple(out)

    def encode_batch(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per text) of texts given as bytes and offsets."""
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(offs) - 1, np.int64)
        starts = match_starts(raw, offs, self.pattern)
        ends = np.append(starts[1:], len(raw))
        hashes, index, inverse = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_ENTRIES or len(self.ids) > 4 * CACHE_ENTRIES:
            self._forget()
        at = np.searchsorted(self.keys, hashes)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != hashes)
        if len(new):
            data, ids, counts = raw.tobytes(), [], []
            for a, b in zip(starts[index[new]].tolist(), ends[index[new]].tolist()):
                got = self.merge(data[a:b])
                ids += got
                counts.append(len(got))
            counts = np.array(counts, np.int64)
            first = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate((self.ids, np.array(ids, np.int32)))
            self.keys = np.insert(self.keys, at[new], hashes[new])
            self.first = np.insert(self.first, at[new], first)
            self.count = np.insert(self.count, at[new], counts)
            at = np.searchsorted(self.keys, hashes)
        which = at[inverse]
        flat = gather(self.ids, self.first, self.count, which)
        total = np.concatenate(([0], np.cumsum(self.count[which])))
        return flat, np.diff(total[np.searchsorted(starts, offs)])

    def _forget(self) -> None:
        """Start the table of merged matches: sorted hashes, and where each one's ids lie; the last entry is a stop."""
        self.keys = np.array([~np.uint64(0)])
        self.first, self.count = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)


class Decoder:
    """The bytes of every id as flat arrays: a worker that only decodes holds neither the vocabulary's dict nor a queue."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        by_rank = [b""] * size
        for token, rank in ranks.items():
            lengths[rank] = len(token)
            by_rank[rank] = token
        self.lengths = lengths
        self.offsets = np.cumsum(lengths) - lengths
        self.flat = np.frombuffer(b"".join(by_rank), np.uint8)
        self.valid = lengths > 0

    def decode_batch(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat bytes, byte end of each id)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.valid) or not self.valid[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return gather(self.flat, self.offsets, self.lengths, ids), np.cumsum(self.lengths[ids])


def gather(values: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenation of values[offsets[w]: offsets[w] + lengths[w]] over w in ``which``."""
    n = lengths[which]
    ends = np.cumsum(n)
    return values[np.repeat(offsets[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


@cache
def _classes() -> np.ndarray:
    """Class of every code point: 0 white space, 1 letter, 2 number, 3 other."""
    import regex

    out = np.full(0x110000, 3, np.uint8)
    kinds = [(k, regex.compile(kind)) for k, kind in enumerate((r"\s+", r"\p{L}+", r"\p{N}+"))]
    for first in range(0, 0x110000, CLASS_BLOCK):  # the classes of single code points, so blocks don't change them
        points = [c for c in range(first, first + CLASS_BLOCK) if not 0xD800 <= c < 0xE000]
        text, at = "".join(map(chr, points)), np.array(points, np.int64)
        for k, kind in kinds:
            for m in kind.finditer(text):
                out[at[m.start(): m.end()]] = k
    return out


def match_starts(raw: np.ndarray, offs: np.ndarray, pattern: str) -> np.ndarray:
    """Byte offset of every match of ``pattern`` in texts given as bytes and offsets; its matches cover the texts."""
    if pattern != SPLIT:
        return _regex_starts(raw, offs, pattern)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    if n == len(raw):
        at = np.arange(n + 1)
    else:
        at = np.zeros(n + 1, np.int64)
        np.cumsum(1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000), out=at[1:])
    edge = np.zeros(n + 3, bool)  # a text starts here, or all texts have ended
    edge[np.searchsorted(at, offs)] = True
    edge[n:] = True
    kind = _classes()[points]
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white space before something else belongs to it if it is a blank, and stands alone otherwise
    after = np.flatnonzero(start[1:] & (kind[1:] != 0) & (kind[:-1] == 0) & ~edge[1:n]) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 0x20]] = False
    # a match that starts with an apostrophe and goes on with one of the endings
    i = np.flatnonzero(start & (points == 0x27))
    i = i[~edge[i + 1]]
    padded = np.append(points, [0, 0])
    one, two = padded[i + 1], np.where(edge[i + 2], 0, padded[i + 2])
    size = np.zeros(len(i), np.int64)
    for ending in ENDINGS:
        hit = one == ord(ending[0])
        if len(ending) == 2:
            hit &= two == ord(ending[1])
        size[hit] = len(ending)
    i, size = i[size > 0], size[size > 0]
    rest = i + 1 + size
    start[i + 1] = False
    start[rest[rest < n]] = True
    return at[np.flatnonzero(start)]


def _regex_starts(raw: np.ndarray, offs: np.ndarray, pattern: str) -> np.ndarray:
    import regex

    split, data, out = regex.compile(pattern), raw.tobytes(), []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        at = a
        for m in split.finditer(data[a:b].decode("utf-8")):
            out.append(at)
            at += len(m[0].encode("utf-8"))
        if at != b:
            raise ValueError("the pattern must cover every text")
    return np.array(out, np.int64)


_encoders: dict[tuple[int, str], Encoder] = {}
_decoders: dict[int, Decoder] = {}


def _encoder(data: bytes, pattern: str) -> Encoder:
    key = (hash(data), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(parse_ranks(data), pattern)
    return _encoders[key]


def _decoder(data: bytes) -> Decoder:
    key = hash(data)
    if key not in _decoders:
        _decoders.clear()
        _decoders[key] = Decoder(parse_ranks(data))
    return _decoders[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str = SPLIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text; special tokens are ordinary text."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batch: pa.RecordBatch):
        encoder = _encoder(sent.value, pattern)
        raw, offs = text_bytes(batch.column(1))
        for i, j in runs(offs, CHUNK_BYTES):
            flat, counts = encoder.encode_batch(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
            yield {"id": batch.column(0).slice(i, j - i), "ids": spans_to_list(flat, counts, pa.int32())}

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run,
                     f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The input with the bytes of its ids in ``out_col`` (a null list: null); an id outside the vocabulary fails.

    An input column of that name is replaced.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    encoded = encoded.drop(out_col) if out_col != ids_col else encoded
    names = encoded.columns
    at = names.index(ids_col)

    def run(batch: pa.RecordBatch):
        decoder = _decoder(sent.value)
        column = batch.column(at)
        flat = np.asarray(column.flatten())
        ends = np.concatenate(([0], np.cumsum(np.asarray(column.value_lengths().fill_null(0)), dtype=np.int64)))
        for i, j in runs(ends, CHUNK_BYTES):
            data, stops = decoder.decode_batch(flat[ends[i]: ends[j]])
            offs = np.concatenate(([0], stops))[ends[i: j + 1] - ends[i]].astype(np.int32)
            valid = np.asarray(column.slice(i, j - i).is_valid())
            made = pa.Array.from_buffers(pa.binary(), j - i, [pa.array(valid).buffers()[1], pa.py_buffer(offs.tobytes()), pa.py_buffer(data.tobytes())])
            yield {**{c: batch.column(k).slice(i, j - i) for k, c in enumerate(names)}, out_col: made}

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + f", `{out_col}` binary"
    return arrow_map(encoded, run, ddl)


def digests(encoded: DataFrame, decoded_col: str = "decoded", ids_col: str = "ids", id_col: str = "doc_id",
            keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows; the ids too, if asked for."""
    return encoded.select(
        id_col, *[F.col(ids_col)] * keep_ids,
        F.size(ids_col).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(ids_col).cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded_col), 256).alias("decoded_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under the public 50k byte-level vocabulary, and the round trip back to bytes."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digests(decode(encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path))
