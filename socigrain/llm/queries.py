"""Registered queries of this subpackage: thin digests of what its operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import byte_bpe, chat, decontamination, line_dedup, lm_score, merkle, periodic, quality, secrets, simhash, sql, substring_dedup, suffix_dedup, token_files
from .common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every text and the bytes that they decode to, as digests."""
    return byte_bpe.digests(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every text, the base rule and the verdict of the certified cutoffs."""
    scored = quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.select("doc_id", *quality.STATS, "base_failed", "kept")


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of word triples and the components of those within two bits."""
    return simhash.digests(table(spark, sf, "documents"), words=3)


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Texts without the words of windows that occur twice or more."""
    return substring_dedup.digests(table(spark, sf, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that occur twice or more."""
    return suffix_dedup.digests(table(spark, sf, "documents"))


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of every text: the base patterns and strings that pass for random."""
    return secrets.digests(table(spark, sf, "documents"))


def op8_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every text, written to Huffman-coded files and read back."""
    docs = table(spark, sf, "documents")
    return token_files.digests(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "token-files"))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and where it is."""
    return decontamination.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Texts without lines that repeat an earlier line, up to one word."""
    return line_dedup.digests(table(spark, sf, "documents"))


def op2_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    """Every text scored by a bigram trie that nine tenths of the documents train."""
    return lm_score.score(table(spark, sf, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf, roots and proof of every row, and the root that a row tampered with leads to."""
    docs = table(spark, sf, "documents")
    return merkle.manifest(docs, F.crc32(docs.doc_id.cast("string").cast("binary")) % 5 == 0)


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of every text, one in ten of which is made to repeat itself."""
    return periodic.digests(periodic.find_runs(periodic.looped(table(spark, sf, "documents"))))


def op13_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    told = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(turns.unionByName(told)))


QUERIES.update(
    op1_substring_dedup=op1_substring_dedup, op2_lm_score=op2_lm_score, op3_suffix_dedup=op3_suffix_dedup, op4_secret_scan=op4_secret_scan,
    op5_byte_bpe=op5_byte_bpe, op6_quality_rules=op6_quality_rules, op7_simhash=op7_simhash, op8_token_files=op8_token_files,
    op9_line_dedup=op9_line_dedup, op10_decontamination=op10_decontamination, op11_merkle_manifest=op11_merkle_manifest, op12_periodic_runs=op12_periodic_runs,
    op13_chat_format=op13_chat_format,
)
SQL.update(op1_substring_dedup=sql.SUBSTRING_DEDUP, op9_line_dedup=sql.LINE_DEDUP, op10_decontamination=sql.DECONTAMINATION,
           op11_merkle_manifest=sql.MERKLE_MANIFEST, op13_chat_format=sql.CHAT_FORMAT)
