"""Corpus pipeline: STAGES over ``documents``, each written and read again.

=============  ==========================================  =====================
stage          operator                                    effect
=============  ==========================================  =====================
quality        quality rules with host verdicts (2)        rejected rows go
near_dedup     SimHash near-duplicates (5)                 one row of each group
                                                           stays
decontaminate  benchmark windows by SimHash (6)            rows with a benchmark
                                                           passage go
pii            weak-supervision spans (8)                  spans become <KIND>,
                                                           n_chars follows
bpe            byte-level BPE (7)                          ids of each text, and
                                                           a digest of what they
                                                           decode to
=============  ==========================================  =====================

Every stage works on all rows that the one before it kept; nulls, repeated
rows and extra columns have the results stated by the stage's operator.  An
empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import bpe, decontaminate, host_quality, pii, simhash
from rivulet.llm.util import stage


def _ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return host_quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)``; ids are little-endian
    unsigned 32-bit integers."""
    out = bpe.encode(docs, _ranks_path(), decoded=True)
    return out.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
                      F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("pii", pii_redacted),
    ("bpe", tokenized),
]

#: SimHash components, the label model and BPE have no SQL form; the tests
#: compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
