"""LM scoring with a sharded bigram trie in Elias-Fano levels.

The model interpolates p(w | h) = (1 - l(h)) c(h, w) / c(h) + l(h) p(w), where p(w) is the base's
smoothed unigram and l(h) = 1 / (1 + ``SCALE`` * c(h) ** ``POWER``), so that every context sums to
one; a context never seen in training leaves p(w).  A text starts in a begin context.

Steps, all by Spark partitions:

1. Slices of the corpus become a list of their different words (64-bit hashes) and a stream of
   positions in it, so that texts are read and cut once.
2. The training counts of all words meet in word shards, which answer every slice's list with ids
   and counts.  Base scores are known then.
3. Slices send each different bigram once, with its training count, to context shards, the
   successors of a frequent context being dealt out over several; a bigram has one entry per slice.
   A shard adds the counts, builds its part of the trie and asks it for all bigrams; their values
   return to the slices, which sum them per document.

A trie part has two levels in a memory-mapped file: the contexts' ids and pointers, and their
successors with quantised log10 probabilities.  Ids and pointers are Elias-Fano sequences;
successor ids are stored relative to their context (the sequence goes on from the last id of the
context before), and looked up by a successor search inside the context's range.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import bytes_of, chunks, keyed, partitions
from .superkmer import mixed, word_hashes

SCALE, POWER = 1.0, 0.1
ADD = 0.1
#: Text of a slice; tokens of a context shard; bigrams of one context that stay together.
SLICE_BYTES, SHARD_BYTES, TOGETHER = 9 << 20, 12 << 20, 1 << 20
#: Steps of the quantised log10 probabilities, from 0 down.
STEP = 1 / 2048
SAMPLE = 4096
END_HASH = np.uint64(0x5F356495C6A1D2B7)
UNKNOWN, BEGIN = 0, 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class EliasFano:
    """A monotone sequence: low bits packed, high bits as unary gaps, decoded slice by slice."""

    def __init__(self, values: np.ndarray, keep):
        n = len(values)
        top = int(values[-1]) if n else 0
        self.n, self.low = n, max(0, (top // n).bit_length() - 1) if n else 0
        values = values.astype(np.uint64)
        ones = (values >> np.uint64(self.low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, bool)
        bits[ones] = True
        self.high = keep(np.packbits(bits, bitorder="little"))
        self.samples = keep(ones[::SAMPLE])
        low = values & np.uint64((1 << self.low) - 1)
        self.lows = keep(np.packbits((low[:, None] >> np.arange(self.low, dtype=np.uint64) & np.uint64(1)).astype(bool), bitorder="little"))

    def slice(self, start: int, end: int) -> np.ndarray:
        """Values [start, end)."""
        if end <= start:
            return np.zeros(0, np.int64)
        block, last = start // SAMPLE, (end - 1) // SAMPLE + 1
        bit = int(self.samples[block])
        stop = int(self.samples[last]) if last < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[bit // 8 : stop // 8 + 1], bitorder="little")
        ones = np.flatnonzero(bits[bit % 8 :])[start - block * SAMPLE : end - block * SAMPLE] + bit
        values = (ones - np.arange(start, end)) << self.low
        if self.low:
            a, b = start * self.low, end * self.low
            lows = np.unpackbits(self.lows[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a].reshape(-1, self.low)
            values += lows.astype(np.int64) @ (1 << np.arange(self.low))
        return values


class Trie:
    """Contexts and their successors with quantised values, in one memory-mapped file."""

    def __init__(self, context: np.ndarray, word: np.ndarray, log10: np.ndarray):
        """Rows sorted by (context, word), without repeats."""
        self.file = tempfile.TemporaryFile()
        heads = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(context) else np.zeros(0, np.int64)
        ends = np.append(heads[1:], len(context))
        lasts = word[ends - 1] if len(heads) else np.zeros(0, np.int64)
        base = np.concatenate(([0], np.cumsum(lasts + 1)))[: len(heads)]
        self.contexts = EliasFano(context[heads], self._keep)
        self.pointers = EliasFano(np.append(heads, len(context)), self._keep)
        self.bases = EliasFano(base, self._keep)
        self.words = EliasFano(word + np.repeat(base, ends - heads), self._keep)
        self.codes = self._keep(np.minimum(np.round(-log10 / STEP), 65535).astype(np.uint16))

    def _keep(self, values: np.ndarray) -> np.ndarray:
        """The array, moved to the file."""
        if not values.size:
            return values
        at = self.file.seek(0, 2)
        at += self.file.write(b"\0" * (-at % 8))
        self.file.write(np.ascontiguousarray(values).tobytes())
        self.file.flush()
        return np.memmap(self.file, values.dtype, "r", at, values.shape)

    def look_up(self, context: np.ndarray, word: np.ndarray, step: int = 1 << 18) -> np.ndarray:
        """log10 probabilities of bigrams sorted by (context, word); NaN where one isn't stored."""
        out = np.full(len(context), np.nan)
        names = self.contexts.slice(0, self.contexts.n)
        place = np.searchsorted(names, context)
        known = np.flatnonzero(place < len(names))
        known = known[names[place[known]] == context[known]]
        pointers, bases = self.pointers.slice(0, self.pointers.n), self.bases.slice(0, self.bases.n)
        for low in range(0, len(known), step):
            some = known[low : low + step]
            c = place[some]
            first, last = int(pointers[c[0]]), int(pointers[c[-1] + 1])
            for cut in range(first, last, step):
                part = self.words.slice(cut, min(cut + step, last))
                wanted = word[some] + bases[c]
                at = np.searchsorted(part, wanted)
                hit = np.flatnonzero(at < len(part))
                # inside the context's range, not a successor of the next one
                hit = hit[(part[at[hit]] == wanted[hit]) & (at[hit] + cut >= pointers[c[hit]]) & (at[hit] + cut < pointers[c[hit] + 1])]
                out[some[hit]] = self.codes[at[hit] + cut] * -STEP
        return out


def squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def spread(packed: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(packed, n * width, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).reshape(-1).view(kind)


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens with the end of each text, tokens per text)."""
    parts, sizes = [], []
    for low, high in chunks(column):
        data, offsets = bytes_of(column.slice(low, high - low))
        hashes, first = word_hashes(_LOWER[data], offsets)
        parts.append(np.insert(hashes, first[1:], END_HASH))
        sizes.append(np.diff(first) + 1)
    return np.concatenate(parts), np.concatenate(sizes)


def smoothing(count: np.ndarray) -> np.ndarray:
    """Weight of the unigram in a context with that count."""
    return 1 / (1 + SCALE * np.power(np.maximum(count, 1).astype(float), POWER))


def word_slices(docs: DataFrame, shards: int, doc_id: str, text: str) -> DataFrame:
    """One row per slice of the corpus: its documents, different words by shard, counts and token stream."""
    name = F.coalesce(F.col("_doc").cast("string"), F.lit(""))
    rows = keyed(docs, doc_id, text).select("_doc", "_print", (F.crc32(name) % 10 == 0).alias("_held"), "_text")

    def work(batches):
        held: list[pa.RecordBatch] = []
        size = number = 0
        for batch in batches:
            for low, high in chunks(batch.column("_text"), SLICE_BYTES):
                held.append(batch.slice(low, high - low))
                size += held[-1].column("_text").nbytes
                if size >= SLICE_BYTES:
                    yield row(held, number)
                    held, size, number = [], 0, number + 1
        if held:
            yield row(held, number)

    def row(batches, number):
        parts = [token_hashes(b.column("_text")) for b in batches]
        hashes, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        out = np.concatenate([np.asarray(b.column("_held")) for b in batches])
        words, stream = np.unique(hashes, return_inverse=True)
        order = np.argsort(words % np.uint64(shards), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        stream = rank[stream]
        counts = np.bincount(stream[np.repeat(~out, sizes)], minlength=len(words)).astype(np.uint32)
        table = pa.Table.from_batches(batches)
        columns = {
            "_slice": pa.array([(TaskContext.get().partitionId() << 32) + number]),
            "_docs": pa.array([table.column("_doc").to_pylist()], pa.list_(table.schema.field("_doc").type)),
            "_prints": pa.array([table.column("_print").to_pylist()], pa.list_(pa.int64())),
            "_held": pa.array([out.tolist()], pa.list_(pa.bool_())), "_sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
            "_words": pa.array([words[order].tobytes()], pa.binary()), "_counts": pa.array([squeeze(counts)], pa.binary()),
            "_stream": pa.array([squeeze(stream)], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"_slice long, _docs array<{kind}>, _prints array<long>, _held array<boolean>, _sizes array<long>, _words binary, _counts binary, _stream binary"
    return rows.mapInArrow(work, schema)


#: The columns both readers of a slice's words take, so that Spark shuffles them once and uses the files twice.
ASKED = ("_slice", "_words", "_counts")


def vocabulary(slices: DataFrame) -> DataFrame:
    """(_w, _c): training count of every word that occurs in training texts."""

    def work(batches):
        for batch in batches:
            for packed, squeezed in zip(batch.column("_words").to_pylist(), batch.column("_counts").to_pylist()):
                words = np.frombuffer(packed, np.int64)
                counts = spread(squeezed, len(words), np.uint32)
                used = np.flatnonzero(counts)
                for low in range(0, len(used), 1 << 16):
                    some = used[low : low + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(words[some]), pa.array(counts[some].astype(np.int64))], ["_w", "_c"])

    return slices.select(*ASKED).mapInArrow(work, "_w long, _c long").groupBy("_w").agg(F.sum("_c").alias("_c"))


def answers(slices: DataFrame, words: DataFrame, shards: int) -> DataFrame:
    """(_slice, _shard, _ids, _found): ids and counts of each slice's words of one word shard, in their order."""

    def ask(batches):
        for batch in batches:
            for name, packed in zip(batch.column("_slice").to_pylist(), batch.column("_words").to_pylist()):
                asked = np.frombuffer(packed, np.uint64)
                ends = np.searchsorted(asked % np.uint64(shards), np.arange(shards + 1, dtype=np.uint64))
                some = [s for s in range(shards) if ends[s] < ends[s + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([name] * len(some)), pa.array([asked[ends[s] : ends[s + 1]].tobytes() for s in some], pa.binary())],
                    ["_shard", "_slice", "_asked"],
                )

    def answer(batches):
        shard, parts, ready = None, [], False
        names = counts = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("_shard", "_slice", "_asked")]
            known_w, known_c = np.asarray(batch.column("_w").fill_null(0)), np.asarray(batch.column("_c").fill_null(0))
            out: list[tuple] = []
            for i, (s, name, asked) in enumerate(zip(*columns)):
                if s != shard:
                    shard, parts, ready = s, [], False
                if asked is None:
                    parts.append((known_w[i], known_c[i]))
                    continue
                if not ready:
                    pairs = np.array(parts, np.int64).reshape(-1, 2)
                    names, counts, ready = pairs[:, 0].copy().view(np.uint64), pairs[:, 1], True
                    order = np.argsort(names)
                    names, counts, parts = names[order], counts[order], []
                wanted = np.frombuffer(asked, np.uint64)
                at = np.searchsorted(names, wanted)
                hit = at < len(names)
                hit[hit] = names[at[hit]] == wanted[hit]
                found = np.where(hit, counts[np.where(hit, at, 0)] if len(counts) else 0, 0)
                ids = np.where(hit, (at + 1) * shards + s + BEGIN + 1, UNKNOWN)
                out.append((name, s, squeeze(ids.astype(np.int64)), squeeze(found.astype(np.int64)), len(wanted)))
            if out:
                types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["_slice", "_shard", "_ids", "_found", "_n"])

    asked = slices.select(*ASKED).mapInArrow(ask, "_shard int, _slice long, _asked binary")
    # the same residue of the unsigned hash: 2^64 is brought in by halves
    residue = F.expr(f"cast(pmod(pmod(_w, {shards}) + if(_w < 0, {(1 << 64) % shards}, 0), {shards}) AS int)")
    known = words.select(residue.alias("_shard"), F.lit(None).cast("long").alias("_slice"), F.lit(None).cast("binary").alias("_asked"), "_w", "_c")
    both = asked.select("_shard", "_slice", "_asked", F.lit(None).cast("long").alias("_w"), F.lit(None).cast("long").alias("_c")).unionByName(known)
    placed = both.repartition(shards, "_shard").sortWithinPartitions("_shard", F.col("_slice").asc_nulls_first())
    return placed.mapInArrow(answer, "_slice long, _shard int, _ids binary, _found binary, _n long")


def bigrams(slices: DataFrame, answered: DataFrame, totals: DataFrame, contexts: int, kind) -> DataFrame:
    """Rows for context shards: packed bigrams of one slice and shard, and one base row per slice."""
    schema = T.StructType([
        *[T.StructField(n, t) for n, t in (("_slice", T.LongType()), ("_shard", T.IntegerType()), ("_base", T.BooleanType()))],
        T.StructField("_docs", T.ArrayType(kind)), T.StructField("_held", T.ArrayType(T.BooleanType())),
        *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("_sizes", "_known")],
        *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("_basis", "_direct")],
        T.StructField("_train", T.LongType()), T.StructField("_z", T.DoubleType()), T.StructField("_packed", T.ArrayType(T.BinaryType())),
        T.StructField("_lengths", T.ArrayType(T.LongType())),
    ])
    names = schema.fieldNames()

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        slice_ = {c: left.column(c)[0].as_py() for c in left.column_names}
        parts = sorted(right.to_pylist(), key=lambda r: r["_shard"])
        train, z = parts[0]["_train"], parts[0]["_z"]
        word_ids = np.concatenate([spread(p["_ids"], p["_n"], np.int64) for p in parts])
        word_counts = np.concatenate([spread(p["_found"], p["_n"], np.int64) for p in parts])
        sizes = np.array(slice_["_sizes"], np.int64)
        total = int(sizes.sum())
        stream = spread(slice_["_stream"], total, np.uint32).astype(np.int64)
        ids, counts = word_ids[stream], word_counts[stream]
        firsts = np.cumsum(sizes) - sizes
        text = np.repeat(np.arange(len(sizes)), sizes)
        base = np.log10((counts + ADD) / z)
        context, context_count = np.roll(ids, 1), np.roll(counts, 1)
        ends = counts[firsts + sizes - 1]  # every training text has one end, and one beginning
        context[firsts], context_count[firsts] = BEGIN, ends
        # no context, or a word never seen in training: known without the trie
        alone = context_count == 0
        fresh = ~alone & (counts == 0)
        direct = np.where(alone, base, np.where(fresh, base + np.log10(smoothing(context_count)), 0.0))
        sums = lambda v: np.add.reduceat(v, firsts)
        rows = [{
            "_slice": slice_["_slice"], "_shard": int(slice_["_slice"] % contexts), "_base": True, "_docs": slice_["_docs"], "_held": slice_["_held"],
            "_sizes": sizes.tolist(), "_known": sums((counts > 0).astype(np.int64)).tolist(), "_basis": sums(base).tolist(), "_direct": sums(direct).tolist(),
            "_train": train, "_z": z, "_packed": None, "_lengths": None,
        }]
        send = np.flatnonzero(~alone & ~fresh)
        slots = -(-context_count[send] // TOGETHER)
        shard = (mixed((context[send] * 1_000_003 + ids[send] % slots).astype(np.uint64)) % np.uint64(contexts)).astype(np.int64)
        order = np.lexsort((ids[send], context[send], shard))
        send, shard = send[order], shard[order]
        # each different bigram once, with its training count; where it stands stays with the slice
        changes = np.concatenate(([True], (context[send][1:] != context[send][:-1]) | (ids[send][1:] != ids[send][:-1]) | (shard[1:] != shard[:-1]))) if len(send) else np.zeros(0, bool)
        first = np.flatnonzero(changes)
        held = np.array(slice_["_held"], bool)
        trained = np.add.reduceat((~held[text[send]]).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        place = np.zeros(total, np.uint32)  # 0 where the trie isn't asked
        place[send] = np.cumsum(changes)
        rows[0] |= {"_packed": [squeeze(place)], "_lengths": [total]}
        send, shard = send[first], shard[first]
        cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))) if len(send) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = send[a:b]
            heads, which = np.unique(context[at], return_inverse=True)
            tails, to = np.unique(ids[at], return_inverse=True)
            head_count, tail_count = np.zeros(len(heads), np.int64), np.zeros(len(tails), np.int64)
            head_count[which], tail_count[to] = context_count[at], counts[at]
            packed = [
                squeeze(np.diff(heads, prepend=0)), squeeze(head_count), squeeze(np.diff(tails, prepend=0)), squeeze(tail_count),
                squeeze(np.diff(which, prepend=0).astype(np.uint8)), squeeze(to.astype(np.uint32)), squeeze(trained[a:b]),
            ]
            rows.append(dict.fromkeys(names) | {"_slice": slice_["_slice"], "_shard": int(shard[a]), "_base": False, "_z": z, "_packed": packed, "_lengths": [len(heads), len(tails), b - a]})
        return pa.Table.from_pylist([{n: r[n] for n in names} for r in rows], schema=arrow)

    def arrow_kind(t):
        if isinstance(t, T.ArrayType):
            return pa.list_(arrow_kind(t.elementType))
        return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.BooleanType: pa.bool_(), T.DoubleType: pa.float64(), T.BinaryType: pa.binary(), T.StringType: pa.string()}[type(t)]

    arrow = pa.schema([(f.name, arrow_kind(f.dataType)) for f in schema.fields])
    counted = answered.crossJoin(F.broadcast(totals))  # totals: one row
    return slices.drop("_words", "_counts").groupBy("_slice").cogroup(counted.groupBy("_slice")).applyInArrow(work, schema)


def shard_values(rows: list[dict]) -> Iterator[tuple[int, np.ndarray]]:
    """Per slice, the log10 probabilities of its different bigrams in this shard, in their order."""
    heads, head_counts, tails, tail_counts, trained, sizes = [], [], [], [], [], []
    for row in rows:
        n_heads, n_tails, n = row["_lengths"]
        p = row["_packed"]
        which, to = np.cumsum(spread(p[4], n, np.uint8)), spread(p[5], n, np.uint32).astype(np.int64)
        heads.append(np.cumsum(spread(p[0], n_heads, np.int64))[which])
        head_counts.append(spread(p[1], n_heads, np.int64)[which])
        tails.append(np.cumsum(spread(p[2], n_tails, np.int64))[to])
        tail_counts.append(spread(p[3], n_tails, np.int64)[to])
        trained.append(spread(p[6], n, np.int64))
        sizes.append(n)
    context, word = np.concatenate(heads), np.concatenate(tails)
    order = np.lexsort((word, context))
    context, word = context[order], word[order]
    first = np.flatnonzero(np.concatenate(([True], (context[1:] != context[:-1]) | (word[1:] != word[:-1]))))
    pair = np.cumsum(np.bincount(first, minlength=len(context))) - 1
    count = np.add.reduceat(np.concatenate(trained)[order], first)
    context, word = context[first], word[first]
    head_count, tail_count = np.concatenate(head_counts)[order][first], np.concatenate(tail_counts)[order][first]
    unigram, weight = (tail_count + ADD) / rows[0]["_z"], smoothing(head_count)
    seen = np.flatnonzero(count)
    trie = Trie(context[seen], word[seen], np.log10((1 - weight[seen]) * count[seen] / head_count[seen] + weight[seen] * unigram[seen]))
    log10 = trie.look_up(context, word)
    log10 = np.where(np.isnan(log10), np.log10(weight * unigram), log10)
    values = np.empty(len(pair))
    values[order] = log10[pair]
    for row, part in zip(rows, np.split(values, np.cumsum(sizes)[:-1])):
        yield row["_slice"], part


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Texts whose crc32(doc_id as text) mod 10 is not 0 train the model; a null id counts as empty
    text and is held out.  Null and empty texts have the end token only.  Repeated rows train and
    are scored each for itself.  Without any training text every count is 0.
    """
    spark = docs.sparkSession
    shards = partitions(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    contexts = max(1, -(-size // SHARD_BYTES))
    kind = docs.schema[doc_id].dataType
    slices = word_slices(docs, shards, doc_id, text).repartition(shards, "_slice")
    words = vocabulary(slices)
    totals = words.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_train"), F.count(F.lit(1)).alias("_v")).select(
        "_train", (F.col("_train") + ADD * (F.col("_v") + 1)).alias("_z")
    )
    rows = bigrams(slices, answers(slices, words, shards), totals, contexts, kind)
    out_kind = kind.simpleString()

    def ask_trie(batches):
        shard, held = None, []
        for batch in batches:
            base = batch.filter(batch.column("_base"))
            if base.num_rows:
                yield base.select(kept).append_column(pa.field("_values", pa.binary()), pa.nulls(base.num_rows, pa.binary()))
            for row in batch.filter(pa.compute.invert(batch.column("_base"))).select(["_slice", "_shard", "_z", "_packed", "_lengths"]).to_pylist():
                if row["_shard"] != shard and held:
                    yield sums_of(held)
                    held = []
                shard = row["_shard"]
                held.append(row)
        if held:
            yield sums_of(held)

    kept = ["_slice", "_shard", "_base", "_docs", "_held", "_sizes", "_known", "_basis", "_direct", "_train", "_packed", "_lengths"]
    asked = T.StructType([*[rows.schema[n] for n in kept], T.StructField("_values", T.BinaryType())])

    def sums_of(held):
        found = list(shard_values(held))
        none = [None] * len(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in found]), pa.array([held[0]["_shard"]] * len(found), pa.int32()), pa.array([False] * len(found)),
             *[pa.array(none, t) for t in nulls], pa.array([[len(p)] for _, p in found], longs),
             # steps of 1/2048 leave most byte planes of a double empty
             pa.array([squeeze(np.asarray(p, np.float64)) for _, p in found], pa.binary())],
            [*kept, "_values"],
        )

    simple = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[out_kind]
    longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
    nulls = [pa.list_(simple), pa.list_(pa.bool_()), longs, longs, doubles, doubles, pa.int64(), pa.list_(pa.binary())]
    placed = rows.repartition(min(contexts, 4 * shards), "_shard").sortWithinPartitions("_shard", "_slice")
    partial = placed.mapInArrow(ask_trie, asked)
    gathered = partial.repartition(shards, "_slice").sortWithinPartitions("_slice", F.desc("_base"), "_shard")

    def finish(batches):
        now, values = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["_base"]:
                    if now:
                        yield result(now, values)
                    now, values = row, []
                else:
                    values.append(spread(row["_values"], row["_lengths"][0], np.float64))
        if now:
            yield result(now, values)

    def result(row, values):
        # a slice numbers its bigrams in the order of the shards; 0 stands where the trie isn't asked
        found = np.concatenate([np.zeros(1), *values])[spread(row["_packed"][0], row["_lengths"][0], np.uint32)]
        sizes = np.array(row["_sizes"], np.int64)
        sums = np.array(row["_direct"]) + np.add.reduceat(found, np.cumsum(sizes) - sizes)
        n = len(sums)
        columns = [pa.array(row["_docs"], simple), pa.array(row["_held"]), pa.array(row["_sizes"]), pa.array(row["_known"]), pa.array([row["_train"]] * n), pa.array(row["_basis"]), pa.array(sums)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return gathered.mapInArrow(finish, f"doc_id {out_kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
