"""Substring de-duplication with fixed-block anchors.

A window is ``window`` consecutive words of one document; the words of a window whose sequence also starts in a document
with a smaller id are removed. Reference blocks are the non-overlapping runs of ``window // 2`` words of every document,
so a window holds at least one whole block wherever it lies. Every rolling run of that many words of every document
probes the blocks: a bitmap of fixed size (``filter_bits``) drops most probes that hit nothing before they are shuffled,
the rest meet the blocks in one aggregation by hash. Hits between different documents are extended: every window around
a hit is looked up among the windows around all hits, and the runs of windows that start in a smaller document form the
maximal exact repeats. Documents whose whole word sequence is that of a smaller one are removed first, as one hash.

Only hashes with places are shuffled, aggregated before they are joined back, so neither a block that a third of all
documents share nor a large group of copies meets in one task. Sequences are compared by 64-bit hashes.

Defined cases: ids are integers; rows with a null id take no part (nothing is removed, nothing refers to them). A null
text has no words. Repeated rows don't remove each other, as their ids are equal. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.bitmaps import bitmap, has_bits
from hirelens.llm.common import arrow_map, map_batches, stored, table
from hirelens.llm.textops import Words, mix, signed, window_hashes, words_of

_KEYS = "id long, text_key long"


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                       F.col(text_col).alias("text"))


def _windows(w: Words, size: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the text, hash) of every run of ``size`` words in texts of ``least`` or more; and the rows' word counts."""
    counts = w.counts()
    at = w.window_starts(size)
    rows = w.rows()[at]
    keep = counts[rows] >= least
    at, rows = at[keep], rows[keep]
    return rows, at - w.first[rows], window_hashes(w.hashes, size)[at], counts


def _sequence_hash(w: Words) -> np.ndarray:
    """Hash of each text's whole word sequence."""
    n = len(w.hashes)
    place = np.arange(n) - np.repeat(w.first[:-1], w.counts())
    each = mix(w.hashes + mix(place.astype(np.uint64)))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(each, out=total[1:])
    return mix(total[w.first[1:]] - total[w.first[:-1]] + w.counts().astype(np.uint64))


def _row_hashes(batch: pa.RecordBatch):
    yield mix(np.asarray(batch["id"]).astype(np.uint64) ^ mix(np.asarray(batch["text_key"]).astype(np.uint64)))


def _only(texts: DataFrame, bits: np.ndarray, log2_size: int, inside: bool) -> DataFrame:
    """The rows whose (id, text_key) may be among those of the bitmap, or surely isn't; a null id isn't."""
    sent = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            keys = pa.record_batch([batch["id"].fill_null(0), batch["text_key"]], ["id", "text_key"])
            hit = has_bits(sent.value, next(_row_hashes(keys)), log2_size) & ~np.asarray(batch["id"].is_null())
            yield batch.filter(pa.array(hit == inside))

    return map_batches(texts, run, texts.schema)


def copies(texts: DataFrame, window: int) -> DataFrame:
    """(id, text_key) of the documents whose whole word sequence, of a window at least, is that of a smaller document."""
    def run(batch: pa.RecordBatch):
        for i, j, w in words_of(batch["text"]):
            keep = pa.array(np.flatnonzero(w.counts() >= window))
            yield {"id": batch["id"].slice(i, j - i).take(keep), "text_key": batch["text_key"].slice(i, j - i).take(keep),
                   "sequence": pa.array(signed(_sequence_hash(w))).take(keep), "n": pa.array(w.counts()).take(keep)}

    whole = stored(arrow_map(texts.where(F.col("id").isNotNull()), run, _KEYS + ", sequence long, n long"), "substrings-whole")
    first = stored(whole.groupBy("sequence", "n").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last"),
                   "substrings-first")
    return whole.join(first, ["sequence", "n"]).where("id > first").select("id", "text_key").distinct()


def anchors(texts: DataFrame, window: int, filter_bits: int) -> DataFrame:
    """(id, text_key, places): where runs of half a window hit a reference block of another document, or are one that is hit."""
    size = window // 2
    texts = texts.where(F.col("id").isNotNull())

    def blocks(batch: pa.RecordBatch):
        for _, _, w in words_of(batch.column(0)):
            _, place, h, _ = _windows(w, size, window)
            yield h[place % size == 0]

    bits = texts.sparkSession.sparkContext.broadcast(bitmap(texts.select("text"), blocks, filter_bits))

    def probe(batch: pa.RecordBatch):
        for i, j, w in words_of(batch["text"]):
            rows, place, h, _ = _windows(w, size, window)
            block = place % size == 0
            keep = block | has_bits(bits.value, h, filter_bits)
            at = pa.array(rows[keep] + i)
            yield {"h": signed(h[keep]), "id": batch["id"].take(at), "text_key": batch["text_key"].take(at),
                   "place": place[keep].astype(np.int32), "block": block[keep]}

    met = stored(arrow_map(texts, probe, "h long, " + _KEYS + ", place int, block boolean"), "substrings-probes")
    # written, so that the join reads both sides through shuffles of its own and Spark can split a hot hash
    shared = stored(met.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.max("block").alias("block"))
                    .where("lo < hi and block").select("h"), "substrings-shared")
    return (met.select("h", "id", "text_key", "place").join(shared, "h").groupBy("id", "text_key")
            .agg(F.collect_set("place").alias("places")))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, filter_bits: int = 27) -> tuple[DataFrame, DataFrame]:
    """(copies, spans): whole copies of smaller documents; and of the others (id, text_key, spans) to remove.

    Spans are [start, end) in words, sorted, apart from each other.
    """
    texts = _narrow(docs, id_col, text_col)
    size = window // 2
    whole = stored(copies(texts, window), "substrings-copies")
    hit = stored(anchors(texts, window, filter_bits).join(whole, ["id", "text_key"], "left_anti"), "substrings-anchors")
    near = _only(texts, bitmap(hit.select("id", "text_key"), _row_hashes, 24), 24, True).join(hit, ["id", "text_key"])

    def extend(batch: pa.RecordBatch):
        places = batch["places"]
        ends = np.concatenate(([0], np.cumsum(np.asarray(places.value_lengths()))))
        flat = np.asarray(places.flatten())
        for i, j, w in words_of(batch["text"]):
            rows, place, h, counts = _windows(w, window, window)
            first = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=j - i))))
            edge = np.zeros(len(rows) + 1, np.int64)
            for r in range(i, j):
                # windows that hold the anchor at p start at p - (window - size) .. p
                p, n = flat[ends[r]: ends[r + 1]], first[r - i + 1] - first[r - i]
                if n > 0:
                    lo, hi = np.clip(p - (window - size), 0, n), np.clip(p + 1, 0, n)
                    np.add.at(edge, first[r - i] + lo, 1)
                    np.add.at(edge, first[r - i] + hi, -1)
            keep = np.cumsum(edge)[:-1] > 0
            at = pa.array(rows[keep] + i)
            yield {"h": signed(h[keep]), "id": batch["id"].take(at), "text_key": batch["text_key"].take(at), "place": place[keep].astype(np.int32)}

    around = stored(arrow_map(near, extend, "h long, " + _KEYS + ", place int"), "substrings-windows")
    first = stored(around.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("h", "first"),
                   "substrings-earliest")
    later = (around.join(first, "h").where("id > first").groupBy("id", "text_key").agg(F.collect_set("place").alias("places")))

    def unite(batch: pa.RecordBatch):
        spans = []
        for places in batch["places"]:
            p = np.sort(np.asarray(places.values))
            new = np.append(True, np.diff(p) > window)
            last = np.append(np.flatnonzero(new)[1:] - 1, len(p) - 1)
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(p[new], p[last] + window)])
        return {"id": batch["id"], "text_key": batch["text_key"], "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))}

    return whole, stored(arrow_map(later, unite, _KEYS + ", spans array<struct<start:int,end:int>>"), "substrings-spans")


def _kept_digest(w: Words, gone: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """(words removed, sha256 of the kept words joined by one blank) of each text."""
    keep = ~gone
    rows = w.rows()
    n = len(w.raw)
    edge = np.zeros(n + 1, np.int8)
    edge[w.starts[keep]] += 1
    edge[w.ends[keep]] -= 1
    mask = np.cumsum(edge, dtype=np.int8)[:-1] > 0
    out = w.raw.copy()
    kept = np.flatnonzero(keep)
    # the separator after a kept word stays, as a blank, if another kept word of its text follows
    more = kept[:-1][rows[kept[:-1]] == rows[kept[1:]]] if len(kept) else kept
    mask[w.ends[more]] = True
    out[w.ends[more]] = 0x20
    data = out[mask].tobytes()
    offs = np.concatenate(([0], np.cumsum(mask)))[w.offs].tolist()
    removed = np.bincount(rows[gone], minlength=len(w.offs) - 1)
    return removed, [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offs[:-1], offs[1:])]


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, filter_bits: int = 27) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row."""
    whole, spans = repeats(docs, id_col, text_col, window, filter_bits)
    texts = _narrow(docs, id_col, text_col)
    bits = bitmap(spans.select("id", "text_key"), _row_hashes, 24)
    schema = _KEYS + ", n_words long, n_removed long, kept_sha256 string"

    def untouched(batch: pa.RecordBatch):
        for i, j, w in words_of(batch["text"], hashed=False):
            removed, digest = _kept_digest(w, np.zeros(len(w.starts), bool))
            yield {"id": batch["id"].slice(i, j - i), "text_key": batch["text_key"].slice(i, j - i), "n_words": w.counts(),
                   "n_removed": removed, "kept_sha256": pa.array(digest)}

    def cut(batch: pa.RecordBatch):
        lists = batch["spans"].to_pylist()
        for i, j, w in words_of(batch["text"], hashed=False):
            gone = np.zeros(len(w.starts), bool)
            for r in range(i, j):
                for s in lists[r] or ():
                    gone[w.first[r - i] + s["start"]: w.first[r - i] + s["end"]] = True
            removed, digest = _kept_digest(w, gone)
            yield {"id": batch["id"].slice(i, j - i), "text_key": batch["text_key"].slice(i, j - i), "n_words": w.counts(),
                   "n_removed": removed, "kept_sha256": pa.array(digest)}

    touched = _only(texts, bits, 24, True).join(spans, ["id", "text_key"], "left")
    rows = arrow_map(_only(texts, bits, 24, False), untouched, schema).unionByName(arrow_map(touched, cut, schema))
    gone = F.col("copy").isNotNull()
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.join(whole.withColumn("copy", F.lit(True)), ["id", "text_key"], "left").select(
        F.col("id").alias(id_col), "n_words", F.when(gone, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, F.lit(nothing)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat 50-word passages of smaller documents."""
    return report(table(spark, sf_dir, "documents"))
