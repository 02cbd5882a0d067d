"""Periodic runs of words: maximal stretches that repeat with a smallest period.

A run of period q is a stretch of words in which words q apart are equal and that no neighbouring word
extends; runs of ``EXPONENT`` periods and ``LEAST`` words or more are reported.  Every such run has, under
one of the two orders of the alphabet, its period as the longest Lyndon word at one of its positions.  So
for each position and order the longest Lyndon word, told by the next smaller suffix, is extended to the
right by the longest common extension of its two ends and to the left by that of the reversal.  Both come
from a suffix tree (Ukkonen's) of the words and of their reversal: the depth of the lowest common ancestor
of two leaves, the shallowest node between them on the Euler tour, found in constant time in a table of
minima over powers of two.

Trees are only built where a run can be: inside a run every three consecutive words occur three times or
more, so a run lies inside a stretch of such triples.  Neither a run nor its neighbours' fit is lost by
that, since what would extend a run belongs to its stretch.

Documents are processed one by one, whole; a task holds some 2 KB per word of the longest stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import keyed, map_batches, raw_texts

LEAST, EXPONENT = 6, 4


class SuffixTree:
    """Ukkonen's tree of a sequence of positive integers, closed by 0, with its Euler tour.

    ``rank`` and ``flipped`` number the suffixes in order of the alphabet and of its reversal; the closing
    0 comes first in both.
    """

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        start, end, children = self._build(self.text)
        self._tour(start, end, children)

    @staticmethod
    def _build(text):
        n = len(text)
        start, end, link, children = [0], [0], [0], [{}]  # node 0 is the root; the end of a leaf is n
        node, edge, length, pending = 0, 0, 0, 0
        for i, symbol in enumerate(text):
            pending += 1
            last = 0  # inner node of this phase that still lacks its link
            while pending:
                if not length:
                    edge = i
                child = children[node].get(text[edge])
                if child is None:
                    children[node][text[edge]] = len(start)
                    start.append(i), end.append(n), link.append(0), children.append(None)
                    if last:
                        link[last], last = node, 0
                else:
                    span = min(end[child], i + 1) - start[child]
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if text[start[child] + length] == symbol:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(start)
                    start.append(start[child]), end.append(start[child] + length), link.append(0)
                    children.append({symbol: split + 1, text[start[child] + length]: child})
                    children[node][text[edge]] = split
                    start.append(i), end.append(n), link.append(0), children.append(None)
                    start[child] += length
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if node == 0 and length:
                    length -= 1
                    edge = i - pending + 1
                elif node:
                    node = link[node]
        return start, end, children

    def _tour(self, start, end, children):
        n = len(self.text)
        tour, first = [], [0] * n
        rank, flipped = [0] * n, [0] * n
        count = 0
        stack = [(0, 0, None)]  # node, its depth, children still to visit
        while stack:
            node, depth, todo = stack.pop()
            if todo is None:
                below = children[node]
                if below is None:
                    suffix = n - depth
                    first[suffix] = len(tour)
                    tour.append(depth)
                    rank[suffix] = count
                    count += 1
                    continue
                todo = iter([below[s] for s in sorted(below)])
            tour.append(depth)
            child = next(todo, None)
            if child is not None:
                stack.append((node, depth, todo))
                stack.append((child, depth + end[child] - start[child], None))
        count = 0
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            below = children[node]
            if below is None:
                flipped[n - depth] = count
                count += 1
                continue
            # pushed in ascending order, so popped from the greatest; 0 is pushed last
            stack.extend((below[s], depth + end[below[s]] - start[below[s]]) for s in sorted(below) if s)
            if 0 in below:
                stack.append((below[0], depth + end[below[0]] - start[below[0]]))
        self.rank, self.flipped, self.first = rank, flipped, np.array(first, np.int64)
        table = [np.array(tour, np.int32)]
        while 2 << len(table) - 1 <= len(tour):
            above, half = table[-1], 1 << len(table) - 1
            table.append(np.minimum(above[:-half], above[half:]))
        self.minima = table

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How long the suffixes at i and j agree; positions differ pairwise and none is past the closing 0."""
        a, b = self.first[i], self.first[j]
        low, high = np.minimum(a, b), np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - (1 << int(k))])
        return out


def lyndon_ends(rank: list[int]) -> np.ndarray:
    """Where the longest Lyndon word at each position ends: at the next smaller suffix."""
    n = len(rank) - 1
    out, stack = np.empty(n, np.int64), []
    for i in range(n + 1):
        while stack and rank[stack[-1]] > rank[i]:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of(symbols: list[int], least: int = LEAST, exponent: int = EXPONENT) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence of positive integers; the exponent is 2 or more."""
    n = len(symbols)
    if n < max(2, least):
        return set()
    ahead, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    found = set()
    at = np.arange(n)
    for rank in (ahead.rank, ahead.flipped):
        end = lyndon_ends(rank)
        right = ahead.common(at, end)
        left = np.zeros(n, np.int64)
        # suffixes of the reversal at n - i and n - end: what stands before i and before end
        inner = np.flatnonzero(at > 0)
        left[inner] = back.common(n - at[inner], n - end[inner])
        period, length = end - at, end + right - at + left
        hit = np.flatnonzero((length >= least) & (length >= exponent * period))
        found.update(zip((at - left)[hit].tolist(), length[hit].tolist(), period[hit].tolist()))
    return found


def stretches(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Ranges of words in which every triple occurs three times or more in the document."""
    if len(ids) < least:
        return []
    size = int(ids.max()) + 1
    pairs = ids[:-1].astype(np.int64) * size + ids[1:]
    if size > 1 << 20:  # three ids don't fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, which, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    often = np.concatenate(([0], (counts[which] >= 3).astype(np.int8), [0]))
    edges = np.diff(often)
    return [(a, b + 2) for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()) if b + 2 - a >= least]


def runs_of_words(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a document, by start, then period."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.int64)
    found = set()
    for a, b in stretches(ids):
        found.update((a + s, n, p) for s, n, p in runs_of(ids[a:b].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): runs as (start, length, period) in words, by start, then period.

    ``collapsed`` has the words that no run contains after its first period, joined by one space.  One row
    per row of ``docs``, repeated rows and null ids included; null and empty texts have no runs and an empty
    collapsed text.  Other columns are ignored, whatever they are called; an empty table gives an empty result.
    """
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batch):
        sizes, runs, collapsed = [], [], []
        for raw in raw_texts(batch.column("_text")):
            words = raw.split()
            found = runs_of_words(words)
            if found:
                gone = np.zeros(len(words) + 1, np.int64)
                for start, length, period in found:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                words_left = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            else:
                words_left = words
            sizes.append(len(words))
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            collapsed.append(b" ".join(words_left).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc"), pa.array(sizes, pa.int64()), pa.array(runs, runs_type), pa.array(collapsed, pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_batches(keyed(docs, doc_id, text).select("_doc", "_text"), schema, work)


def digests(found: DataFrame) -> DataFrame:
    """The run of the greatest exponent and digests of all runs and of the collapsed text."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # runs come by start and period, so the first of the greatest is kept
    best = F.aggregate("runs", none, lambda acc, r: F.when(acc.isNull() | (r["length"] * acc["period"] > acc["length"] * r["period"]), r).otherwise(acc))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    told = found.withColumn("best", best)
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): documents of which one in ten repeats its own words from a place on.

    With h the crc32 of the id in decimal and g = h // 10: if 10 divides h, word i >= a of the n words becomes
    word a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) // (3 + g mod 8).  A null id changes nothing.
    """

    def work(batch):
        texts = []
        for h, raw in zip(batch.column("_h").to_pylist(), raw_texts(batch.column("_text"))):
            words = raw.split() if h is not None and h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words[a:] = [words[a + (i - a) % p] for i in range(a, n)]
                raw = b" ".join(words)
            texts.append(raw.decode())
        yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = keyed(docs).select("_doc", F.crc32(F.col("_doc").cast("string").cast("binary")).alias("_h"), "_text")
    return map_batches(own, f"doc_id {kind}, text string", work)
