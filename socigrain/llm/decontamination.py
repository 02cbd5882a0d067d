"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming look-up, exact check.

Words are runs of letters, digits and underscores, lower-cased.  A window of a text matches an item
of n words if its n words (all words of a shorter text) have multiset-weighted Jaccard similarity of
``SIMILARITY`` or more on five-word shingles.  Such a window shares most shingles with the item, so
windows are only taken where enough of an item's shingles occur; that drops nothing.  Window
fingerprints come from prefix sums of their shingles' signed hash bits.  The fingerprint index has
``BLOCKS`` tables: two fingerprints within ``RADIUS`` bits differ by at most RADIUS // BLOCKS in
some block, and each table lists, for every value of its block, the items that near.  Everything
within the radius is found, and is then compared exactly.

The benchmark is the query set: it goes over all documents in blocks of about ``BLOCK_WORDS``
words, each small enough to be sent to every task.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import map_batches, packed, text_of

WORDS, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 24, 8
BLOCK_WORDS = 1_000_000
_WORD = re.compile(r"\w+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]) <= RADIUS // BLOCKS


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingle_bits(words: list[str]) -> np.ndarray:
    """+1 or -1 for the 64 hash bits of every shingle."""
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + WORDS]).encode(), seed=42) for i in range(len(words) - WORDS + 1)]
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """8 bytes for each row of summed signs."""
    return np.packbits(sums > 0, axis=1, bitorder="little")


def weighted_jaccard(a: Counter, b: Counter) -> float:
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def shingles(words: list[str]) -> Counter:
    return Counter(zip(*(words[i:] for i in range(WORDS))))


class ItemIndex:
    """One block of benchmark items."""

    def __init__(self, items: list[tuple[object, str]]):
        split = [(name, words_of(text)) for name, text in items]
        split = [(name, words) for name, words in split if len(words) >= WORDS]
        self.names = [name for name, _ in split]
        self.sizes = [len(words) for _, words in split]
        self.shingles = [shingles(words) for _, words in split]
        self.ids: dict[str, int] = {}
        for _, words in split:
            for word in words:
                self.ids.setdefault(word, len(self.ids) + 1)
        self.items_of: dict[int, list[int]] = defaultdict(list)
        for j, (_, words) in enumerate(split):
            for code in set(self.codes(words)[1].tolist()):
                self.items_of[code].append(j)
        self.known = np.array(sorted(self.items_of), np.uint64)
        prints = [fingerprints(shingle_bits(words).sum(axis=0, keepdims=True)) for _, words in split]
        self.prints = np.concatenate(prints) if prints else np.zeros((0, 8), np.uint8)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(positions, codes) of the shingles that consist of item words."""
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.uint64, len(words))
        m = len(ids) - WORDS + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        here = np.flatnonzero(np.logical_and.reduce([ids[i : i + m] > 0 for i in range(WORDS)]))
        code = np.zeros(len(here), np.uint64)
        for i in range(WORDS):
            code = (code + ids[here + i]) * _STEP
            code ^= code >> np.uint64(29)
        return here, code

    def near(self, prints: np.ndarray, j: int) -> np.ndarray:
        """Which fingerprints lie within the radius of item j: some block is near, then all bits are counted."""
        own = self.prints[j]
        hit = np.zeros(len(prints), bool)
        for block in range(BLOCKS):
            hit |= _NEAR[own[block]][prints[:, block]]
        some = np.flatnonzero(hit)
        return some[np.bitwise_count(prints[some] ^ own).sum(axis=1) <= RADIUS]

    def search(self, text: str) -> list[tuple[object, int, int, float]]:
        """(item, first word, words, similarity) of the best window for each matching item."""
        words = words_of(text)
        where, codes = self.codes(words)
        if not len(where) or not len(self.known):
            return []
        at = np.searchsorted(self.known, codes)
        at[at == len(self.known)] = 0
        found = self.known[at] == codes
        hits: dict[int, list[int]] = defaultdict(list)
        for position, code in zip(where[found].tolist(), codes[found].tolist()):
            for j in self.items_of[code]:
                hits[j].append(position)
        out = []
        for j, places in sorted(hits.items()):
            wanted = sum(self.shingles[j].values())
            if len(places) < SIMILARITY * wanted:  # any matching window shares at least that many shingles
                continue
            size = min(self.sizes[j], len(words))
            best = self.best_window(words, j, size, places)
            if best:
                out.append((self.names[j], best[1], size, best[0]))
        return out

    def best_window(self, words: list[str], j: int, size: int, places: list[int]) -> tuple[float, int] | None:
        last = len(words) - size
        edges = np.zeros(last + 2, np.int32)
        for p in places:
            edges[max(0, p - size + WORDS)] += 1
            edges[min(p, last) + 1] -= 1
        starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        best = None
        # stretches of windows, each over its own words
        for group in np.split(starts, np.flatnonzero(np.diff(starts) > size) + 1):
            low, high = int(group[0]), int(group[-1]) + size
            part = words[low:high]
            sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(shingle_bits(part), axis=0)])
            begin = group - low
            for k in self.near(fingerprints(sums[begin + size - WORDS + 1] - sums[begin]), j).tolist():
                window = part[begin[k] : begin[k] + size]
                similarity = weighted_jaccard(shingles(window), self.shingles[j])
                if similarity >= SIMILARITY and (best is None or similarity > best[0]):
                    best = (similarity, low + int(begin[k]))
        return best


@lru_cache(maxsize=2)
def _index(items: tuple) -> ItemIndex:
    return ItemIndex(list(items))


def item_blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> list:
    """The benchmark as broadcast blocks of about ``block_words`` words; null texts hold no words."""
    rows = items.select(F.col(item_id).alias("item"), text_of(text).alias("text"))
    total = rows.agg(F.sum(F.size(F.split("text", "\\s+")))).first()[0] or 0
    n = -(-total // block_words)
    spark = items.sparkSession
    blocks = []
    for b in range(n):
        block = rows.filter(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == b).collect()  # bounded by block_words
        blocks.append(spark.sparkContext.broadcast(tuple(sorted(((r.item, r.text) for r in block), key=repr))))
    return blocks


def matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): the best window of each document for each item that it holds.

    One row per row of ``docs`` and item; ties go to the first window.  Items of fewer than five
    words can't match.  Null and empty texts match nothing; null ids come back as null; repeated
    rows and items answer each for itself; empty tables give an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("_doc"), text_of(text).alias("_text"))
    names = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("item_id", items.schema[item_id].dataType),
        T.StructField("start", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("similarity", T.DoubleType()),
    ])
    out = docs.sparkSession.createDataFrame([], names)
    for block in item_blocks(items, item_id, item_text, block_words):

        def work(batch, block=block):
            index = _index(block.value)
            found = [(i, *m) for i, text in enumerate(batch.column("_text").to_pylist()) for m in index.search(text)]
            if found:
                rows_at, item, start, size, similarity = zip(*found)
                columns = [batch.column("_doc").take(pa.array(rows_at)), pa.array(item), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(similarity)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start", "n_words", "similarity"])

        out = out.unionByName(map_batches(rows, names, work))
    return out


def keep_clean(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that match no item, with their own columns."""
    rows = packed(docs, doc_id, text).select("_row", "_text")
    for block in item_blocks(items, item_id, item_text, block_words):

        def work(batch, block=block):
            index = _index(block.value)
            clean = pa.array([not index.search(text) for text in batch.column("_text").to_pylist()], pa.bool_())
            yield batch.filter(clean)

        rows = map_batches(rows, rows.schema, work)
    return rows.select("_row.*")
