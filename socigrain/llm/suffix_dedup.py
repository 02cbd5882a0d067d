"""Suffix-array dedup over bytes: sampled suffixes, merged by a distributed, prefix-aware merge sort.

Every 200-byte string contains its minimiser position (see ``superkmer``), so it is enough to sort
the suffixes that start at minimiser positions, each with the bytes of its windows left of it.
Tasks sort what they hold and exchange it as front-coded runs: the length of the prefix shared
with the run's previous suffix, and the rest.  A bucket merges its runs with a loser tree that
keeps, for every suffix in it, the prefix length shared with the last output: suffixes with
different lengths are ordered by these alone, and equal ones are compared beyond the known prefix.

The merge yields the sorted suffixes with their common prefix lengths R.  A window with d bytes
left of the minimiser is repeated if another suffix shares R >= length - d bytes to the right and
d bytes to the left, or if the same suffix and left side were counted more than once.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, partitions, raw_texts
from .superkmer import byte_windows, covered, removed_mask, runs_of

LENGTH, GRAM = 200, 64
#: Bytes of suffixes in a sorted run, and of an exchanged piece of a run.
RUN_BYTES, PIECE_BYTES = 8 << 20, 1 << 18
#: Up to so many different contexts of one minimiser are compared one by one.
FEW = 16
HEAD = ">qi"  # minimiser hash and slot precede the suffix
HEAD_SIZE = struct.calcsize(HEAD)
ENTRY = "<HHHQqI"  # shared prefix, rest, left side, count, content name, window number
ENTRY_SIZE = struct.calcsize(ENTRY)

#: Prefix shared with the one before, head and suffix, reversed left side, count, content name, window number.
Entry = tuple[int, bytes, bytes, int, int, int]


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of a and b, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_coded(entries: list[tuple[bytes, bytes, int, int, int]]) -> Iterator[bytes]:
    """Pieces of a sorted run of entries without their prefix lengths."""
    before, piece, size = b"", [], 0
    for key, left, *rest in entries:
        lcp = shared_prefix(before, key)
        piece += [struct.pack(ENTRY, lcp, len(key) - lcp, len(left), *rest), key[lcp:], left]
        size += len(key) - lcp + len(left) + ENTRY_SIZE
        before = key
        if size > PIECE_BYTES:
            yield b"".join(piece)
            piece, size = [], 0
    if piece:
        yield b"".join(piece)


def decoded(pieces: list[bytes]) -> Iterator[Entry]:
    before = b""
    for piece in pieces:
        at = 0
        while at < len(piece):
            lcp, rest, left, *names = struct.unpack_from(ENTRY, piece, at)
            at += ENTRY_SIZE
            before = before[:lcp] + piece[at : at + rest]
            at += rest
            yield lcp, before, piece[at : at + left], *names
            at += left


class LoserTree:
    """Merge of sorted runs of Entry; each output carries the prefix shared with the output before it."""

    def __init__(self, runs: list[Iterator[Entry]]):
        self.size = 1
        while self.size < max(2, len(runs)):
            self.size *= 2
        self.runs = [*runs, *(iter(()) for _ in range(self.size - len(runs)))]
        self.entries: list[Entry | None] = [next(run, None) for run in self.runs]
        self.known = [0] * self.size  # prefix of each run's head shared with the last output
        self.losers = [0] * self.size

    def _first_wins(self, a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; the loser's known prefix is brought up to date."""
        x, y = self.entries[a], self.entries[b]
        if x is None or y is None:
            return y is None
        if self.known[a] != self.known[b]:
            return self.known[a] > self.known[b]  # the one that shares more with the last output is less
        lcp = shared_prefix(x[1], y[1], self.known[a])
        wins = x[1][lcp:] <= y[1][lcp : lcp + 1] if lcp == len(x[1]) else x[1][lcp : lcp + 1] <= y[1][lcp : lcp + 1]
        self.known[b if wins else a] = lcp
        return wins

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        wins = self._first_wins(a, b)
        self.losers[node] = b if wins else a
        return a if wins else b

    def __iter__(self) -> Iterator[Entry]:
        winner = self._build(1)
        while (entry := self.entries[winner]) is not None:
            yield self.known[winner], *entry[1:]
            fresh = self.entries[winner] = next(self.runs[winner], None)
            self.known[winner] = fresh[0] if fresh else 0
            node = (winner + self.size) // 2
            while node:
                rival = self.losers[node]
                if not self._first_wins(winner, rival):
                    self.losers[node], winner = winner, rival
                node //= 2


def repeated_offsets(rights: list[bytes], lcps: list[int], lefts: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """Per suffix of one minimiser, in sorted order, flags over its windows d = length - len(right) .. len(left).

    lcps[i]: prefix that rights[i] shares with rights[i - 1].
    """
    least = [length - len(r) for r in rights]
    flags = [np.full(len(left) - low + 1, count > 1) for left, low, count in zip(lefts, least, counts)]
    n = len(rights)
    if n <= FEW:
        for i in range(n):
            right = length
            for j in range(i + 1, n):
                right = min(right, lcps[j])
                if right < length - len(lefts[i]):
                    break
                low, high = length - right, shared_prefix(lefts[i], lefts[j])
                if low <= high:
                    flags[i][low - least[i] : high - least[i] + 1] = True
                    flags[j][low - least[j] : high - least[j] + 1] = True
        return flags
    # many: at each d, suffixes fall in classes of equal right sides and of equal left sides
    by_left = sorted(range(n), key=lefts.__getitem__)
    left_lcp = np.array([0] + [shared_prefix(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:])])
    order, right_lcp = np.array(by_left), np.array(lcps)
    right_lcp[0] = 0
    low_d, high_d, weight = np.array(least), np.array([len(x) for x in lefts]), np.array(counts)
    left_class = np.empty(n, np.int64)
    for d in range(int(low_d.min()), int(high_d.max()) + 1):
        here = np.flatnonzero((low_d <= d) & (d <= high_d))
        if not len(here):
            continue
        right_class = np.cumsum(right_lcp < length - d)
        left_class[order] = np.cumsum(left_lcp < d)
        _, group = np.unique(right_class[here] * (n + 1) + left_class[here], return_inverse=True)
        total = np.bincount(group, weights=weight[here])
        for i in here[total[group] > 1]:
            flags[i][d - least[i]] = True
    return flags


def merged(different: DataFrame, length: int) -> DataFrame:
    """Sort the suffixes of all super-k-mers and find the repeated windows in them."""
    buckets = 4 * partitions(different.sparkSession)
    bucketed = different.withColumn("_bucket", F.pmod(F.hash("_m", "_slot"), F.lit(buckets)))

    def sort_runs(batches):
        held: list[tuple] = []
        size = run = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("_bucket", "_m", "_slot", "_off", "_packed", "_count", "_c", "_j")]
            for bucket, m, slot, off, packed, *names in zip(*columns):
                held.append((bucket, struct.pack(HEAD, m, slot) + packed[off:], packed[:off][::-1], *names))
                size += len(packed)
            if size > RUN_BYTES:
                yield coded(held, run)
                held, size, run = [], 0, run + 1
        if held:
            yield coded(held, run)

    def coded(held, run):
        held.sort()
        out: list[tuple] = []
        for bucket, entries in groupby(held, key=lambda e: e[0]):
            pieces = front_coded([e[1:] for e in entries])
            out += [(bucket, run, i, piece) for i, piece in enumerate(pieces)]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["_bucket", "_run", "_piece", "_coded"])

    runs = bucketed.mapInArrow(sort_runs, "_bucket int, _run int, _piece int, _coded binary")
    runs = runs.withColumn("_task", F.spark_partition_id())
    order = ["_bucket", "_task", "_run", "_piece"]
    exchanged = runs.repartition(buckets, "_bucket").sortWithinPartitions(*order)

    def merge(batches):
        bucket, key, found = None, None, []
        runs: list[list[bytes]] = []
        for batch in batches:
            for b, task, run, piece in zip(*[batch.column(c).to_pylist() for c in ("_bucket", "_task", "_run", "_coded")]):
                if b != bucket and runs:
                    yield from resolved(runs)
                    runs, key = [], None
                bucket = b
                if (task, run) != key:
                    runs.append([])
                    key = (task, run)
                runs[-1].append(piece)
        if runs:
            yield from resolved(runs)

    def resolved(runs):
        """Windows of one bucket: the merged order falls into groups of one minimiser and slot."""
        found: list[tuple] = []
        group: list[Entry] = []
        for entry in LoserTree([decoded(pieces) for pieces in runs]):
            if group and entry[0] < HEAD_SIZE:
                found += windows_of(group)
                group = []
                if len(found) > 5000:
                    yield batch_of(found)
                    found = []
            group.append(entry)
        found += windows_of(group)
        if found:
            yield batch_of(found)

    def windows_of(group):
        m, slot = struct.unpack_from(HEAD, group[0][1])
        kept, names, lcp = [], set(), HEAD_SIZE
        for entry in group:
            lcp = min(lcp, entry[0]) if kept else HEAD_SIZE
            if entry[4:] not in names:  # a split join may pack one twice
                names.add(entry[4:])
                kept.append((lcp, *entry[1:]))
                lcp = 1 << 16
        rights, lefts = [e[1][HEAD_SIZE:] for e in kept], [e[2] for e in kept]
        if slot:  # dealt-out single windows: whole rows are equal or not
            total = Counter()
            for right, left, entry in zip(rights, lefts, kept):
                total[right, left] += entry[3]
            flags = [np.array([total[pair] > 1]) for pair in zip(rights, lefts)]
        else:
            flags = repeated_offsets(rights, [max(0, e[0] - HEAD_SIZE) for e in kept], lefts, [e[3] for e in kept], length)
        for (*_, c, j), flag in zip(kept, flags):
            if flag.any():
                # window offsets run against d: the last d belongs to the first window
                yield from ((m, c, j + f, j + t) for f, t in runs_of(flag[::-1]))

    def batch_of(found):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], ["_m", "_c", "_f", "_t"])

    return exchanged.mapInArrow(merge, "_m long, _c long, _f int, _t int")


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _print, _text, _spans): each row with the byte ranges [f, t) that repeated strings cover.

    A string of ``length`` bytes is repeated if it starts at any other place of the corpus, the
    same text (overlapping or not) and repeated rows included.  Null and short texts have none;
    null ids are kept and matched by their text; an empty table stays empty.
    """
    return covered(docs, byte_windows(length, gram), lambda d: merged(d, length), doc_id, text)[0]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each text without the repeated bytes.

    ``kept`` is binary: a cut may fall inside a character.
    """
    marked = repeated_bytes(docs, length, gram, doc_id, text)
    kind = docs.schema[doc_id].dataType.simpleString()

    def rebuild(batch):
        total, gone, runs, kept = [], [], [], []
        for raw, spans in zip(raw_texts(batch.column("_text")), batch.column("_spans").to_pylist()):
            removed = list(runs_of(removed_mask(len(raw), spans))) if spans else []
            ends = [0, *(t for _, t in removed)]
            total.append(len(raw))
            gone.append(sum(t - f for f, t in removed))
            runs.append(len(removed))
            kept.append(b"".join([raw[a:b] for a, b in zip(ends, [*(f for f, _ in removed), len(raw)])]))
        columns = [batch.column("_doc"), *[pa.array(x, pa.int64()) for x in (total, gone, runs)], pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return map_batches(marked, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary", rebuild)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    return remove_repeats(docs).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256")
