"""A corpus from raw documents to token ids, one operator of ``socigrain.llm`` per stage.

Every stage takes (spark, docs, sf_dir) and sees what its predecessor kept, written as Parquet and
read again.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from socigrain.llm import byte_bpe, decontamination, line_dedup, near_copies, quality, simhash
from socigrain.llm.common import cut, ready, release, scratch_path, table

#: Near copies, calibration and byte-level BPE can't be stated in SQL; tests hold them to brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the cutoffs certified on the labels."""
    ready(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that repeat an earlier one up to a word."""
    ready(spark)
    return line_dedup.rewrite(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints at two bits, then of each linked by shingles at 0.8.

    Both take five-word shingles and keep the least id.  Fingerprints take the copies and the closest variants, so
    that only one of each comes to the exact comparison, which finds what is further than two bits apart.
    """
    release(ready(spark))
    first = cut(simhash.keep_first(docs, words=5), "fingerprinted", "zstd")
    release(spark)
    return near_copies.keep_first(first, words=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    release(ready(spark))
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    release(ready(spark))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN).drop("text")
    return byte_bpe.decode(coded, ranks).select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
