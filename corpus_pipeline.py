"""Corpus pipeline: drop toxic documents, keep one of each group of near copies, mask live secrets, mix the sources to
their weights, and encode to token ids. Each stage is written as Parquet under the shared folder and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import bpe, mixing, secrets, simjoin, toxicity
from hirelens.llm.common import crc_mod, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; it learns from labels with crc32(doc_id) mod 4 other than 2."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 4) != 2)
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shared 5-word shingles (Jaccard 0.75), the one with the smallest id stays."""
    return simjoin.representatives(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that look live (few owners hold them) are masked; widely copied examples and all documents stay."""
    masked = secrets.mask_live(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and the pieces of them, as the mix of sources takes them."""
    return mixing.apply(docs, length_col="n_chars")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the bytes decoded from them."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return bpe.digests(coded, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

#: SQL can't express the classifier, the join's components at this size, the mix and the merges; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
