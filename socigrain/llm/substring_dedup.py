"""Substring dedup over words: super-k-mers in minimiser buckets, where sorting counts windows."""

from __future__ import annotations

from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, raw_texts
from .superkmer import covered, grouped, in_buckets, removed_mask, runs_of, word_windows

WINDOW, GRAM = 35, 12


def repeated_windows(strings: list[bytes], counts: list[int], window: int) -> list[list[bool]]:
    """Per packed super-k-mer, which of its windows occur twice or more in all of them.

    All windows are sorted, and those of one run of equal windows count together.
    """
    places: list[tuple[bytes, int, int]] = []
    flags = []
    for i, packed in enumerate(strings):
        starts = [0]
        starts += [j + 1 for j, byte in enumerate(packed) if byte == 32]
        ends = [s - 1 for s in starts[1:]] + [len(packed)]
        n = len(starts) - window + 1
        flags.append([False] * n)
        places += [(packed[starts[j] : ends[j + window - 1]], i, j) for j in range(n)]
    places.sort()
    for _, run in groupby(places, key=lambda p: p[0]):
        same = list(run)
        if sum(counts[i] for _, i, _ in same) > 1:
            for _, i, j in same:
                flags[i][j] = True
    return flags


def repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _print, _text, _spans): each row with the word ranges [f, t) that repeated windows cover.

    A window of ``window`` words is repeated if its word sequence starts at any other place of the
    corpus, the same text and repeated rows included.  Null and short texts have no windows; null
    ids are kept and matched by their text; an empty table stays empty.
    """

    def count(batches):
        found: list[tuple] = []
        for (m, slot), rows in grouped(batches, ["_m", "_slot"]):
            rows = list({(r["_c"], r["_j"]): r for r in rows}.values())  # a split join may pack one twice
            strings, counts = [r["_packed"] for r in rows], [r["_count"] for r in rows]
            if len(rows) == 1:  # a lone super-k-mer repeats as a whole
                flags = [[counts[0] > 1] * (strings[0].count(b" ") + 2 - window)]
            else:
                flags = repeated_windows(strings, counts, window)
            found += [(m, r["_c"], r["_j"] + f, r["_j"] + t) for r, flag in zip(rows, flags) for f, t in runs_of(flag)]
            if len(found) > 5000:
                yield batch_of(found)
                found = []
        if found:
            yield batch_of(found)

    def batch_of(found):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], ["_m", "_c", "_f", "_t"])

    cutting = word_windows(window, gram)
    return covered(docs, cutting, lambda d: in_buckets(d, count, "_m long, _c long, _f int, _t int"), doc_id, text)[0]


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without the words that repeated windows cover.

    Kept words are joined by one space.
    """
    marked = repeated_words(docs, window, gram, doc_id, text)
    kind = docs.schema[doc_id].dataType.simpleString()

    def rebuild(batch):
        total, gone, kept = [], [], []
        for raw, spans in zip(raw_texts(batch.column("_text")), batch.column("_spans").to_pylist()):
            words = raw.split()
            mask = removed_mask(len(words), spans)
            total.append(len(words))
            gone.append(int(mask.sum()))
            kept.append(b" ".join([w for w, drop in zip(words, mask.tolist()) if not drop] if spans else words))
        columns = [batch.column("_doc"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    return map_batches(marked, f"doc_id {kind}, n_words long, n_removed long, kept string", rebuild)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return remove_repeats(docs).selectExpr("doc_id", "n_words", "n_removed", "sha2(kept, 256) AS kept_sha256")
