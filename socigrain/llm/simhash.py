"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint becomes the vector of the bit counts of its 4-bit segments.  The Manhattan
distance of two vectors is never over the Hamming distance of the fingerprints, so near
fingerprints lie in near cells of the integer grid.  For radius 2 both sides visit the cells within
distance 1 of their own: vectors at distance 2 or less share such a cell, and candidates meet by an
equality join on it.  Hamming distance is then verified exactly.

Only distinct fingerprints take part, so copies cost nothing.  A cell with more than ``CELL_LIMIT``
distinct fingerprints is not paired: its fingerprints emit themselves and their 64 one-bit
variants, and those that share a variant (all within 2 of each other) are linked to the least one,
which keeps the components exact with a linear number of rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.graph.stars import star_components
from .common import cut, keyed, map_batches, raw_texts, text_of

SEED = 42
SEGMENT_BITS = 4
CELL_LIMIT = 64
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(raw: bytes, words: int) -> int:
    """Unsigned fingerprint of one UTF-8 text: a bit is set if over half the shingles' hashes have it."""
    tokens = raw.lower().split()
    n = len(tokens)
    if n == 0:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, n)
    spans = zip(starts[: n - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.fromiter((_hash(joined[s:e]) for s, e in spans), np.uint64, n - width + 1)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _print, _fp): one row per row of ``docs``; texts without words have fingerprint 0."""

    def work(batch):
        values = [fingerprint(x, words) for x in raw_texts(batch.column("_text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc"), batch.column("_print"), pa.array(np.array(values, np.uint64).view(np.int64))], ["_doc", "_print", "_fp"]
        )

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(keyed(docs, doc_id, text), f"_doc {kind}, _print long, _fp long", work)


def segment_counts(fp: Column) -> list[Column]:
    """Bit counts of the segments of a fingerprint."""
    return [F.bit_count(F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))).cast("long") for s in range(0, 64, SEGMENT_BITS)]


def _cells(counts: list[Column]) -> Column:
    """The grid cells within Manhattan distance 1, a cell being its counts packed 3 bits each."""
    own = counts[0]
    for i, count in enumerate(counts[1:], 1):
        own = own + F.shiftleft(count, 3 * i)
    up = [F.when(c < SEGMENT_BITS, own + F.lit(1 << 3 * i).cast("long")) for i, c in enumerate(counts)]
    down = [F.when(c > 0, own - F.lit(1 << 3 * i).cast("long")) for i, c in enumerate(counts)]
    return F.array_compact(F.array(own, *up, *down))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``_fp`` whose closure is that of all pairs within 2 bits.

    Spark sizes rows after an explode, and repetitive stored ones, far too low: none of these tables is broadcast.
    """
    counted = distinct.select("_fp", *[c.alias(f"_s{i}") for i, c in enumerate(segment_counts(F.col("_fp")))])
    visits = counted.select("_fp", F.explode(_cells([F.col(f"_s{i}") for i in range(64 // SEGMENT_BITS)])).alias("_cell"))
    shared = visits.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    met = cut(visits.hint("merge").join(shared.hint("merge"), "_cell"), "cells")
    light = met.filter(F.col("_n") <= CELL_LIMIT).select("_cell", "_fp")
    pairs = (
        light.select("_cell", F.col("_fp").alias("a")).hint("merge")
        .join(light.select("_cell", F.col("_fp").alias("b")).hint("merge"), "_cell")
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
        .select("a", "b")
    )
    crowded = met.filter(F.col("_n") > CELL_LIMIT).select("_fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(np.uint64(1 << b).astype(np.int64).item()) for b in range(64)])
    variants = crowded.select("_fp", F.explode(flips).alias("_flip")).select("_fp", F.col("_fp").bitwiseXOR(F.col("_flip")).alias("_variant"))
    least = variants.groupBy("_variant").agg(F.min("_fp").alias("b"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    stars = variants.hint("merge").join(least.hint("merge"), "_variant").filter("_fp <> b").select(F.col("_fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def groups(docs: DataFrame, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _print, _fp, _root, _component): fingerprints at 2 or fewer differing bits are linked.

    _component is the least id reachable, itself included; null ids never name a component (one
    made of null ids only has null).  Texts without words share fingerprint 0 and are linked like
    any other.  Every row comes back, repeated rows too; an empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, words, doc_id, text), "fingerprints")
    distinct = prints.groupBy("_fp").agg(F.min("_doc").alias("_first"))
    roots = star_components(links(distinct.select("_fp")))
    placed = distinct.join(roots.withColumnRenamed("id", "_fp").hint("merge"), "_fp", "left").withColumn("_root", F.coalesce("component", "_fp"))
    least = placed.groupBy("_root").agg(F.min("_first").alias("_component"))
    # a row of these per different fingerprint: they grow with the documents, not for the driver
    named = placed.select("_fp", "_root").join(least.hint("merge"), "_root")
    return prints.join(named.hint("merge"), "_fp").select("_doc", "_print", "_fp", "_root", "_component")


def keep_first(docs: DataFrame, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per group, with its own columns: that of the least id (nulls last), then text.

    Groups are told apart by their root fingerprint, so that groups of null ids only stay apart.
    """
    return first_rows(docs, groups(docs, words, doc_id, text), doc_id, text)


def first_rows(docs: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row of ``docs`` per ``_root`` of found (_doc, _print, _root), with its own columns."""
    own = docs.columns
    order = F.struct(F.col("_doc").isNull().alias("n"), F.col("_doc").alias("d"), F.col("_print").alias("p"))
    first = found.groupBy("_root").agg(F.min(order).alias("_o")).select(F.col("_o.d").alias("_doc"), F.col("_o.p").alias("_print"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), F.col(doc_id).alias("_doc"), F.xxhash64(text_of(text)).alias("_print"))
    match = F.col("l._doc").eqNullSafe(F.col("r._doc")) & (F.col("l._print") == F.col("r._print"))
    kept = packed.alias("l").join(first.alias("r"), match, "left_semi")
    return kept.dropDuplicates(["_doc", "_print"]).select("_row.*")


def digests(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id)."""
    return groups(docs, words).select(
        F.col("_doc").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_component").alias("component_id")
    )
