"""Token ids in files of Huffman-coded blocks.

A table of token files has two parts below its folder: ``code`` (id, length), from which the
canonical code follows, and ``blocks``, one row per block in its own file order.  A block holds
whole documents in ascending id order, each starting at a byte; its checkpoints say at which bit
each run of ``RUN_IDS`` ids starts and how many ids it has, so blocks are decoded independently
and the runs of one block side by side, by one table look-up per id.

Code lengths come from the global counts of all ids by package-merge under ``MAX_BITS``; the
counts and the code have at most as many rows as the vocabulary.
"""

from __future__ import annotations

import os
import sys
from array import array
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from tokenizers import Tokenizer

from .common import cut, drop_cut, keyed, map_batches, partitions, raw_texts

MAX_BITS = 20
BLOCK_IDS, RUN_IDS = 1 << 18, 256
#: White-space separated strings that a task remembers; beyond it the memory is emptied.
REMEMBERED = 350_000
#: Punctuation at which the registered query's tokenizer splits: its pattern takes letters, digits and others apart.
WORD_EDGES = ".,;:!?*#$%&|"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with no length over ``limit``, by package-merge.

    Symbols that never occur get length 0; a single symbol gets 1.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols don't fit in {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n = len(order)
    # level by level: a list holds single symbols (their index) and packages (pairs of the list below)
    below, is_single = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weights, pairs])
        place = np.argsort(merged, kind="stable")
        below = merged[place]
        is_single.append(place < n)
    # the first 2n-2 items of the top level are taken; packages among them take pairs one level down
    take = 2 * n - 2
    depth = np.zeros(n + 1, np.int64)
    for singles in reversed(is_single):
        chosen = int(singles[:take].sum())
        depth[0] += 1
        depth[chosen] -= 1
        take = 2 * (take - chosen)
    lengths[order] = np.cumsum(depth[:n])
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = np.uint64(1) << (np.uint64(MAX_BITS) - lengths[order].astype(np.uint64))
    starts = np.cumsum(spans) - spans
    codes[order] = starts >> (np.uint64(MAX_BITS) - lengths[order].astype(np.uint64))
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and length for every value of the next MAX_BITS bits."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.uint8)
    total = int(spans.sum())
    ids[:total], sizes[:total] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return ids, sizes


def encode_block(docs: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(payload, start bit of each run, ids in each run) of documents' ids."""
    counts = np.array([len(d) for d in docs], np.int64)
    ids = np.concatenate(docs).astype(np.int64)
    bits = lengths[ids].astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(bits)))
    first = np.concatenate(([0], np.cumsum(counts)))
    size = (ends[first[1:]] - ends[first[:-1]] + 7) // 8 * 8
    origin = np.cumsum(size) - size
    start = ends[:-1] + np.repeat(origin - ends[first[:-1]], counts)
    word, shift = start >> 5, start & 31
    value = codes[ids] << (64 - bits - shift).astype(np.uint64)
    out = np.zeros(int(size.sum() + 31) // 32 + 2, np.uint64)
    heads = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    out[word[heads]] += np.add.reduceat(value >> np.uint64(32), heads)
    out[word[heads] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), heads)
    runs = -(-counts // RUN_IDS)
    at = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    head = np.repeat(first[:-1], runs) + at * RUN_IDS
    return out.astype(">u4").tobytes()[: int(size.sum()) // 8], start[head], np.minimum(RUN_IDS, np.repeat(counts, runs) - at * RUN_IDS)


def decode_block(payload: bytes, starts: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """All ids of a block; its runs advance together, one id each per step."""
    padded = payload + b"\0" * 4
    peek = np.ndarray((len(padded) - 3,), ">u4", padded, strides=(1,))
    order = np.argsort(-counts, kind="stable")
    at, left = starts[order].astype(np.int64), counts[order]
    where = (np.cumsum(counts) - counts)[order]
    ids, sizes = table
    out = np.empty(int(counts.sum()), np.uint32)
    for step in range(int(left[0]) if len(left) else 0):
        active = int(np.searchsorted(-left, -step, side="left"))
        now = at[:active]
        bits = ((peek[now >> 3].astype(np.uint32) << (now & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)).astype(np.int64)
        out[where[:active] + step] = ids[bits]
        now += sizes[bits]
    return out


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple[Tokenizer, dict[bytes, bytes], dict[str, bytes]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokenizer.from_file(path), {}, {}


def _packed(tokenizer: Tokenizer, strings: list[str], kind: str) -> list[bytes]:
    code = "H" if kind == "<u2" else "I"
    if sys.byteorder != "little":
        return [np.array(e.ids, kind).tobytes() for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
    return [array(code, e.ids).tobytes() for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]


def _parts(string: str, edges: str) -> tuple[str, str]:
    """A string as what ends in a letter and the punctuation after it; whole if it isn't like that."""
    core = string.rstrip(edges)
    # normalised and lower-cased, too, it must end in a letter
    if not edges or not core or not normalize("NFC", core).lower()[-1].isalpha():
        return string, ""
    # letters alone can't hold an added token, which the tokenizer looks for before it lower-cases
    return (core.lower() if core.isascii() and core.isalpha() else core), string[len(core) :]


def tokenised(texts: list[bytes], path: str, by_word: bool, kind: str, edges: str = "") -> list[bytes]:
    """Ids of each text, packed as ``kind``."""
    tokenizer, known, parts = _tokenizer(path)
    if not by_word:
        return _packed(tokenizer, [t.decode() for t in texts], kind)
    split = [t.split() for t in texts]
    fresh = set().union(*split).difference(known)
    if len(known) + len(fresh) > REMEMBERED:
        known.clear()
        fresh = set().union(*split)
    if len(parts) > REMEMBERED:
        parts.clear()
    pairs = [_parts(w.decode(), edges) for w in fresh]
    missing = list({p for pair in pairs for p in pair if p not in parts})
    parts.update(zip(missing, _packed(tokenizer, missing, kind)))
    known.update((w, parts[core] + parts[tail]) for w, (core, tail) in zip(fresh, pairs))
    return [b"".join([known[w] for w in words]) for words in split]


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1, by_word: bool = False, edges: str = "", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _print, _ids): ids of each whole text with the end id, packed little-endian.

    ``by_word`` promises that the tokenizer drops ASCII white space and joins nothing across it:
    then what stands between white space is encoded once and remembered.  ``edges`` further
    promises that it always splits between a letter and these characters and lower-cases ASCII, so
    that a word is encoded once whatever follows it.  Null and empty texts have the end id only.
    Ids take 2 bytes if the vocabulary allows it, else 4.
    """
    kind = "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size(True) <= 1 << 16 else "<u4"
    end = b"" if end_id is None else np.array([end_id], kind).tobytes()

    def work(batch):
        coded = [ids + end for ids in tokenised(raw_texts(batch.column("_text")), tokenizer_path, by_word, kind, edges)]
        yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_print"), pa.array(coded, pa.binary())], ["_doc", "_print", "_ids"])

    ids = map_batches(keyed(docs, doc_id, text), f"_doc {docs.schema[doc_id].dataType.simpleString()}, _print long, _ids binary", work)
    return ids.withColumn("_width", F.lit(int(kind[-1])))


def count_ids(ids: DataFrame) -> DataFrame:
    """(id, count) over all rows: one array of counts per task, summed by Spark."""

    def work(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for packed, width in zip(batch.column("_ids").to_pylist(), batch.column("_width").to_pylist()):
                counts = np.bincount(np.frombuffer(packed, f"<u{width}"))
                if len(counts) > len(total):
                    total = np.concatenate([total, np.zeros(len(counts) - len(total), np.int64)])
                total[: len(counts)] += counts
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "count"])

    return ids.select("_ids", "_width").mapInArrow(work, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def write(ids: DataFrame, path: str) -> None:
    """Write the rows of ``token_ids`` as token files below ``path``, in ascending document order.

    Null ids come first; rows of one id are ordered by their text's fingerprint.
    """
    spark = ids.sparkSession
    stored = cut(ids, "ids", compression="zstd")
    counted = count_ids(stored).toPandas()  # at most one row per vocabulary entry
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["count"].to_numpy(np.int64)
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    code = spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, length int")
    code.coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(lengths)  # bounded by the vocabulary
    kind = ids.schema["_doc"].dataType.simpleString()
    kind_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind)
    if kind_arrow is None:
        raise TypeError(f"document ids of type {kind} can't be written")

    def work(batches):
        codes = canonical(shared.value)
        docs: list[np.ndarray] = []
        names: list = []
        size = block = 0
        for batch in batches:
            for name, packed, width in zip(*[batch.column(c).to_pylist() for c in ("_doc", "_ids", "_width")]):
                docs.append(np.frombuffer(packed, f"<u{width}"))
                names.append(name)
                size += len(docs[-1])
                if size >= BLOCK_IDS:
                    yield row(block, names, docs, codes)
                    docs, names, size, block = [], [], 0, block + 1
        if docs:
            yield row(block, names, docs, codes)

    def row(block, names, docs, codes):
        payload, starts, counts = encode_block(docs, shared.value, codes)
        total = [len(d) for d in docs]
        columns = [pa.array([block]), pa.array([sum(total)]), pa.array([names], pa.list_(kind_arrow)), pa.array([total], pa.list_(pa.int64()))]
        columns += [pa.array([payload], pa.binary()), pa.array([starts], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["block", "n_ids", "docs", "doc_ids", "payload", "run_starts", "run_ids"])

    order = ["_doc", "_print", "_tie"]  # the tie parts rows of one id and text among tasks
    placed = stored.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    schema = f"block long, n_ids long, docs array<{kind}>, doc_ids array<long>, payload binary, run_starts array<long>, run_ids array<long>"
    blocks = placed.select("_doc", "_ids", "_width").mapInArrow(work, schema).withColumn("part", F.spark_partition_id())
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    drop_cut(stored)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): every document of the token files; start counts the ids of all before it."""
    code = spark.read.parquet(f"{path}/code").toPandas()  # bounded by the vocabulary
    lengths = np.zeros(int(code["id"].max()) + 1 if len(code) else 1, np.uint8)
    lengths[code["id"].to_numpy(np.int64)] = code["length"].to_numpy(np.uint8)
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    # headers only: a sum per file part, then positions inside each part
    headers = blocks.select("part", "block", "n_ids")
    parts = headers.groupBy("part").agg(F.sum("n_ids").alias("_ids"))  # one row per written partition
    parts = parts.select("part", (F.sum("_ids").over(W.orderBy("part")) - F.col("_ids")).alias("_before"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("block")) - F.col("n_ids")
    starts = headers.withColumn("_inside", inside).join(parts, "part").select("part", "block", (F.col("_before") + F.col("_inside")).alias("_start"))

    def work(batches):
        table = decoding_table(shared.value)
        for batch in batches:
            for block in batch.to_pylist():
                ids = decode_block(block["payload"], np.array(block["run_starts"], np.int64), np.array(block["run_ids"], np.int64), table)
                ends = np.cumsum(block["doc_ids"])
                first = ends - block["doc_ids"]
                for low in range(0, len(ends), 1000):
                    some = slice(low, low + 1000)
                    texts = [ids[a:b].astype("<u4").tobytes() for a, b in zip(first[some], ends[some])]
                    columns = [pa.array(block["docs"][some], pa.from_numpy_dtype(np.int64) if kind == "bigint" else None), pa.array(first[some] + block["_start"]), pa.array(texts, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "ids"])

    return blocks.join(starts, ["part", "block"]).mapInArrow(work, f"doc_id {kind}, start long, ids binary")


def digests(docs: DataFrame, tokenizer_path: str, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files written below ``path``."""
    write(token_ids(docs, tokenizer_path, 1, by_word=True, edges=WORD_EDGES), path)
    return read(docs.sparkSession, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
