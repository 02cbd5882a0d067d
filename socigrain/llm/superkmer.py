"""Super-k-mers: the windows of a text that share one minimiser, as one unit of work.

A window is ``length`` consecutive units (words or bytes).  Its minimiser is the leftmost unit
position with the least hash of ``gram`` units among those inside the window; equal windows have
it at the same place.  Consecutive windows with one minimiser position form a super-k-mer, which
travels to the bucket of its minimiser's hash.  Hashes only route: what counts as equal is decided
on the units themselves.

Two filters lose nothing.  A minimiser hash that occurs once in the corpus can't hold a repeated
window, so its super-k-mer is never shipped.  A minimiser with very many different super-k-mers
(a passage in a large part of the corpus) is dealt out window by window over as many slots as it
needs, a window's slot being a hash of its own content.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bytes_of, chunks, cut, keyed, map_batches, partitions, raw_texts

#: Different super-k-mers, or single windows, of one minimiser that a task takes together.
SLOT_ROWS = 2000
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_WORD_BASE, _WORD_INVERSE = 0xD1B54A32D192ED03, pow(0xD1B54A32D192ED03, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Hashes of any unit range, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, units: np.ndarray, base: int, inverse: int):
        n = len(units)
        self.inverse, self.n = inverse, n
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((units.astype(np.uint64) + np.uint64(1)) * powers(base, n), out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * powers(self.inverse, self.n + 1)[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        m = max(0, self.n - k + 1)
        return mixed((self.sums[k : k + m] - self.sums[:m]) * powers(self.inverse, self.n + 1)[:m])


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost position of the least value in each run of ``width`` values."""
    best, place, span = values, np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        later = best[step:] < best[:-step]
        place = np.where(later, place[step:], place[:-step])
        best = np.where(later, best[step:], best[:-step])
        span += step
    return place


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[Rolling, np.ndarray]:
    return Rolling(data, _BASE, _INVERSE), offsets


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the word number at which each text starts."""
    n = len(data)
    space = np.empty(n + 2, bool)
    space[0] = space[-1] = True
    np.take(_SPACE, data, out=space[1:-1])
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # texts follow each other without white space between
    starts = np.flatnonzero(~space[1:-1] & (space[:-2] | edge[:-1]))
    ends = np.flatnonzero(~space[1:-1] & (space[2:] | edge[1:])) + 1
    return Rolling(data, _BASE, _INVERSE).ranges(starts, ends), np.searchsorted(starts, offsets)


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[Rolling, np.ndarray]:
    """A rolling hash over word hashes, and the word offset at which each text starts."""
    hashes, first = word_hashes(data, offsets)
    return Rolling(hashes, _WORD_BASE, _WORD_INVERSE), first


def super_kmers(rolling: Rolling, offsets: np.ndarray, length: int, gram: int):
    """(text, first window, windows, minimiser offset, its hash, content hash) of every super-k-mer."""
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(windows.sum())
    if not total:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = rolling.grams(gram)
    text = np.repeat(np.arange(len(windows)), windows)
    first = np.cumsum(windows) - windows
    at = np.arange(total) - np.repeat(first - offsets[:-1], windows)
    anchor = sliding_argmin(grams, length - gram + 1)[at]
    heads = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    count = np.diff(np.append(heads, total))
    start = at[heads]
    content = rolling.ranges(start, start + count + length - 1)
    return text[heads], start - offsets[text[heads]], count, anchor[heads] - start, grams[anchor[heads]], content


@dataclass(frozen=True)
class Windows:
    """How texts are cut: ``units`` hashes them, ``split`` gives a text's units and ``join`` packs some."""

    length: int
    gram: int
    units: Callable
    split: Callable[[bytes], list[bytes] | bytes]
    join: Callable[[list[bytes] | bytes], bytes]


def word_windows(length: int, gram: int) -> Windows:
    return Windows(length, gram, word_units, bytes.split, b" ".join)


def byte_windows(length: int, gram: int) -> Windows:
    return Windows(length, gram, byte_units, bytes, bytes)


def shared_super_kmers(rows: DataFrame, cutting: Windows, kind: str) -> DataFrame:
    """(_m, _c, _doc, _print, _at, _n, _off): super-k-mers whose minimiser occurs elsewhere too.

    (_m, _c) names a super-k-mer's content: 64 bits for the minimiser, and 64 for the whole, which
    only has to tell apart what shares the minimiser.
    """

    def find(batch):
        column = batch.column("_text")
        for low, high in chunks(column):
            part = column.slice(low, high - low)
            text, start, count, offset, least, content = super_kmers(*cutting.units(*bytes_of(part)), cutting.length, cutting.gram)
            pick = pa.array(text + low)
            columns = [pa.array(least.view(np.int64)), pa.array(content.view(np.int64)), batch.column("_doc").take(pick), batch.column("_print").take(pick)]
            columns += [pa.array(start.astype(np.int32)), pa.array(count.astype(np.int16)), pa.array(offset.astype(np.int16))]
            yield pa.RecordBatch.from_arrays(columns, ["_m", "_c", "_doc", "_print", "_at", "_n", "_off"])

    supers = map_batches(rows, f"_m long, _c long, _doc {kind}, _print long, _at int, _n short, _off short", find)
    # stored, so that the join below has plain shuffles on both sides and a hot minimiser's can be split
    again = cut(supers.groupBy("_m").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select("_m"), "again")
    return cut(supers.join(again, "_m"), "shared")


def different_super_kmers(rows: DataFrame, shared: DataFrame, cutting: Windows) -> DataFrame:
    """(_m, _slot, _c, _j, _off, _packed, _count): each different super-k-mer once, packed, with its occurrences.

    It is packed from the text in which it comes first.  Minimisers with more than SLOT_ROWS
    different super-k-mers come window by window (_j: which one) with a slot over 0.
    """
    place = F.struct(F.col("_doc").alias("d"), F.col("_print").alias("p"), F.col("_at").alias("a"))
    kinds = shared.groupBy("_m", "_c").agg(F.min(place).alias("_first"), F.min("_n").alias("_n"), F.min("_off").alias("_off"), F.count(F.lit(1)).alias("_count"))
    width = cutting.length - cutting.gram + 1
    many = (
        kinds.groupBy("_m").agg(F.count(F.lit(1)).alias("_kinds")).filter(F.col("_kinds") > SLOT_ROWS)
        .select("_m", F.ceil(F.col("_kinds") * width / SLOT_ROWS).cast("int").alias("_slots"))
    )
    listed = F.collect_list(F.struct("_m", "_c", "_first.a", "_n", "_off", "_count", F.coalesce("_slots", F.lit(0)).alias("s")))
    lists = kinds.join(many, "_m", "left").groupBy(F.col("_first.d").alias("_doc"), F.col("_first.p").alias("_print")).agg(listed.alias("_supers"))

    def pack(batches):
        last = None
        for batch in batches:
            out: list[tuple] = []
            keys = zip(*[batch.column(c).to_pylist() for c in ("_doc", "_print")])
            for key, text, supers in zip(keys, raw_texts(batch.column("_text")), batch.column("_supers").to_pylist()):
                if key == last:  # rows that repeat id and text follow each other; one is enough to pack from
                    continue
                last, units = key, cutting.split(text)
                for m, c, at, n, off, count, slots in (s.values() for s in supers):
                    for j in range(n if slots else 1):
                        packed = cutting.join(units[at + j : at + (j + 1 if slots else n) + cutting.length - 1])
                        out.append((m, 1 + zlib.crc32(packed) % slots if slots else 0, c, j, off - j, packed, count))
                if len(out) > 4000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    def batch_of(out):
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["_m", "_slot", "_c", "_j", "_off", "_packed", "_count"])

    schema = "_m long, _slot int, _c long, _j int, _off int, _packed binary, _count long"
    return same_text(rows, lists, "inner").mapInArrow(pack, schema)


def same_text(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``rows`` with what was found for their key; null ids meet too."""
    other = found.withColumnsRenamed({"_doc": "_d", "_print": "_p"})
    return rows.join(other, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_print") == F.col("_p")), how).drop("_d", "_p")


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of equal keys in sorted rows, across batches; a run has at most SLOT_ROWS rows or so."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple([row[k] for k in keys])
            if key != now and rows:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows


def covered(docs: DataFrame, cutting: Windows, resolve: Callable[[DataFrame], DataFrame], doc_id: str, text: str) -> tuple[DataFrame, str]:
    """Every row of ``docs`` as (_doc, _print, _text, _spans): unit ranges [f, t) of repeated windows, or null.

    ``resolve`` takes ``different_super_kmers``, bucketed as it likes, and returns (_m, _c, _f, _t):
    ranges of window offsets in them that occur twice or more.
    """
    rows, kind = keyed(docs, doc_id, text), docs.schema[doc_id].dataType.simpleString()
    shared = shared_super_kmers(rows, cutting, kind)
    repeated = resolve(different_super_kmers(rows, shared, cutting))
    spans = (
        shared.select("_m", "_c", "_doc", "_print", "_at").join(repeated, ["_m", "_c"])
        .groupBy("_doc", "_print")
        .agg(F.collect_set(F.struct((F.col("_at") + F.col("_f")).alias("f"), (F.col("_at") + F.col("_t") + cutting.length - 1).alias("t"))).alias("_spans"))
    )
    return same_text(rows, spans, "left"), kind


def removed_mask(n: int, spans: list[dict] | None) -> np.ndarray:
    """Which of n units some span covers."""
    edges = np.zeros(n + 1, np.int32)
    if spans:
        np.add.at(edges, [s["f"] for s in spans], 1)
        np.add.at(edges, [s["t"] for s in spans], -1)
    return np.cumsum(edges[:n]) > 0


def runs_of(flags: list[bool] | np.ndarray) -> Iterator[tuple[int, int]]:
    """[from, to) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], np.asarray(flags, np.int8), [0]))))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist())


def in_buckets(different: DataFrame, work: Callable, schema: str) -> DataFrame:
    spark = different.sparkSession
    placed = different.repartition(partitions(spark), "_m", "_slot").sortWithinPartitions("_m", "_slot")
    return placed.mapInArrow(work, schema)
