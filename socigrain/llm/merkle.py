"""Merkle manifest of a dataset: a tree of 16 per source, a tree of their roots, a proof for every row.

Time-forward processing: nodes are labelled (level, number), children before parents, and digests are
messages that a priority queue ordered by label delivers to the parent, which takes all its messages at
once when the sweep reaches its label.  A second sweep in reversed order delivers to every node what its
proof still needs above it (the siblings of its ancestors), down to the leaves.

The queue has two tiers.  A sweep covers a block of ``BLOCK`` = 16^3 nodes of one level and what stands
three levels above them; messages inside it wait in a heap that never holds more.  Messages that leave the
block, up to the next sweep or down to the next lower one, are rows of a stored table that Spark sorts by
label and hands to the sweep in that order: that tier is external, and only Spark's sort holds it.  The
number of rounds is the height of the tallest tree over three; every round's table is 1/4096 of the one
below it.  Blocks are cut by position, so a source with a third of all rows is so many blocks.

Texts are read once and never shuffled: only digests are.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import cut, drop_cut, partitions

ARITY, LEVELS = 16, 3
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows that a sweep hands on at a time.
OUT_ROWS = 2000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class LabelQueue:
    """Messages by label; ``take`` gives the first label and all that was sent to it, in order of sender."""

    def __init__(self):
        self.heap = []

    def send(self, label: tuple, sender: int, message) -> None:
        heapq.heappush(self.heap, (label, sender, message))

    def take(self) -> tuple[tuple, list]:
        label, _, message = heapq.heappop(self.heap)
        messages = [message]
        while self.heap and self.heap[0][0] == label:
            messages.append(heapq.heappop(self.heap)[2])
        return label, messages


def sweep_up(leaves: list[str], levels: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """The digest ``levels`` above a block's nodes, and the digests that each inner node received."""
    if not levels:
        return leaves[0], {}
    queue, received = LabelQueue(), {}
    for i, leaf in enumerate(leaves):
        queue.send((1, i // ARITY), i, leaf)
    while True:
        (level, i), below = queue.take()
        received[level, i] = below
        own = digest(*below)
        if level == levels:
            return own, received
        queue.send((level + 1, i // ARITY), i, own)


def sweep_down(received: dict, levels: int, above: tuple) -> Iterator[tuple[int, tuple]]:
    """(number, proof) of the block's nodes; a proof is (left siblings, right siblings, proof of the parent)."""
    queue = LabelQueue()
    queue.send((-levels, 0), 0, above)
    while queue.heap:
        (level, i), (proof,) = queue.take()
        if not level:
            yield i, proof
            continue
        below = received[-level, i]
        for j in range(len(below)):
            queue.send((level + 1, i * ARITY + j), 0, ("".join(below[:j]), "".join(below[j + 1 :]), proof))


def pairs_of(proof) -> Iterator[tuple[str, str]]:
    while proof:
        yield proof[0], proof[1]
        proof = proof[2]


def chained(pairs: Iterable[tuple[str, str]]) -> tuple:
    proof = ()
    for left, right in reversed(list(pairs)):
        proof = (left, right, proof)
    return proof


def proof_text(proof) -> str:
    return "".join(left + right for left, right in pairs_of(proof))


def fold(leaf: str, proof) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in pairs_of(proof):
        leaf = digest(left, leaf, right)
    return leaf


def _swept(rows: DataFrame, schema: str, work: Callable[[list[tuple]], Iterator[tuple]]) -> DataFrame:
    """``work`` over the rows of each (_tree, _block), sorted by ``_pos``, one block in memory at a time.

    A column of the input that ``schema`` names keeps its type.
    """
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    fields = [f.split() for f in schema.split(", ")]

    def run(batches):
        kinds = {}

        def stream():
            for batch in batches:
                kinds.update((f.name, f.type) for f in batch.schema)
                yield from zip(*[c.to_pylist() for c in batch.columns])

        def flush(out):
            columns = [pa.array(c, kinds.get(name) or types[kind]) for c, (name, kind) in zip(zip(*out), fields)]
            return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])

        out = []
        for _, block in groupby(stream(), key=lambda r: r[:2]):
            for row in work(list(block)):
                out.append(row)
                if len(out) == OUT_ROWS:
                    yield flush(out)
                    out = []
        if out:
            yield flush(out)

    dealt = rows.repartition(partitions(rows.sparkSession), "_tree", "_block").sortWithinPartitions("_tree", "_block", "_pos")
    return dealt.mapInArrow(run, schema)


def positioned(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Nodes, stored, with ``_pos``, 0 first along ``order`` in each tree, and ``_n``, the nodes of the tree.

    Rows are dealt out by range and stored; only counts per (tree, range) are windowed over a tree.
    ``order`` must tell all rows of a tree apart.
    """
    count = partitions(nodes.sparkSession)
    ranged = cut(nodes.repartitionByRange(count, tree, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_c"))
    whole = W.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(tree, "_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(whole).alias("_n"))
    inside = ranged.withColumn("_in", F.row_number().over(W.partitionBy(tree, "_part").orderBy(*order)))
    placed = inside.join(counts, [tree, "_part"]).withColumn("_pos", F.col("_in") + F.col("_before") - 1).drop("_in", "_before", "_part")
    out = cut(placed, "placed")
    drop_cut(ranged)
    return out


def raised(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Sweeps up: the stored nodes of each round, and (_tree, _digest) of the roots.

    ``nodes``: (_tree, _pos, _n, _digest).
    """

    def work(block):
        tree, number, _, n, _ = block[0]
        top, _ = sweep_up([r[4] for r in block], min(LEVELS, height(n)))
        yield tree, number, -(-n // BLOCK), top

    tallest = nodes.agg(F.max("_n")).first()[0] or 0
    rounds = [nodes]
    while tallest > 1:
        below = rounds[-1].select("_tree", F.floor(F.col("_pos") / BLOCK).cast("long").alias("_block"), "_pos", "_n", "_digest")
        rounds.append(cut(_swept(below, "_tree string, _pos long, _n long, _digest string", work), "merkle-up"))
        tallest = -(-tallest // BLOCK)
    return rounds[:-1], rounds[-1].select("_tree", "_digest")


def lowered(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Sweeps down: proofs of the lowest round's nodes.

    ``tops``: (_tree, _pos, _lefts, _rights, _subroot, _root), what stands above each tree, at _pos 0.
    Gives the same columns for every node of the lowest round.
    """

    def work(block):
        tree, _, _, _, _, lefts, rights, subroot, root = block[0]  # what stands above the block, at _pos -1
        nodes = block[1:]
        levels = min(LEVELS, height(nodes[0][3]))
        _, received = sweep_up([r[4] for r in nodes], levels)
        start = nodes[0][2]
        for i, proof in sweep_down(received, levels, chained(zip(lefts, rights))):
            pairs = list(pairs_of(proof))
            yield tree, start + i, [p[0] for p in pairs], [p[1] for p in pairs], subroot, root

    schema = "_tree string, _pos long, _lefts array<string>, _rights array<string>, _subroot string, _root string"
    for nodes in reversed(rounds):
        below = cut(_swept(_with_heads(nodes, tops), schema, work), "merkle-down")
        drop_cut(tops)
        tops = below
    return tops


def _with_heads(nodes: DataFrame, tops: DataFrame, *more: str) -> DataFrame:
    """Blocks of nodes, each behind the row of what stands above it."""
    own = nodes.select(
        "_tree", F.floor(F.col("_pos") / BLOCK).cast("long").alias("_block"), "_pos", "_n", "_digest",
        *[F.lit(None).cast("array<string>").alias(c) for c in ("_lefts", "_rights")],
        *[F.lit(None).cast("string").alias(c) for c in ("_subroot", "_root")], *more)
    heads = tops.select(
        "_tree", F.col("_pos").alias("_block"), F.lit(-1).cast("long").alias("_pos"), F.lit(None).cast("long").alias("_n"),
        F.lit(None).cast("string").alias("_digest"), "_lefts", "_rights", "_subroot", "_root",
        *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in more])
    return own.unionByName(heads)


def leaf_of(columns: dict[str, Column]) -> Column:
    """Digest of a row's fields, each as its length in bytes, a colon and its value, or - if null."""
    def told(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[told(columns[f]) for f in FIELDS]), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, _tree, _row, _digest, changed): digests of all rows; ``changed`` is null where nothing is tampered with.

    ``tampered`` says in which rows the text's A-Z are lower-cased.  ``_row`` numbers the rows of this table.
    """
    own = {f: F.col(f"`{f}`") for f in FIELDS}
    lower = own | {"text": F.translate(own["text"], UPPER, LOWER)}
    changed = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf_of(lower))
    tree = F.coalesce(F.concat(F.lit("s"), own["source"].cast("string")), F.lit(""))
    return docs.select(
        own["doc_id"].alias("doc_id"), tree.alias("_tree"), F.monotonically_increasing_id().alias("_row"), leaf_of(own).alias("_digest"), changed.alias("changed"))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of ``docs``.

    Leaves of a source ascend by doc_id, null ids first, then by digest; rows that repeat one another are
    leaves of their own.  Null sources form one tree, the first.  Null and empty texts differ, as null and
    empty values of any field do.  ``folded_root`` is recomputed from the tampered leaf, where there is one,
    and the original siblings.  Columns other than ``FIELDS`` are ignored, whatever they are called; an
    empty table gives an empty result.
    """
    stored = cut(leaves(docs, tampered), "leaves")
    placed = positioned(stored, "_tree", ["doc_id", "_digest", "_row"])
    drop_cut(stored)
    rounds, subroots = raised(placed.select("_tree", "_pos", "_n", "_digest"))
    forest = positioned(subroots.select(F.lit("").alias("_tree"), F.col("_tree").alias("_source"), "_digest"), "_tree", ["_source"])
    upper, root = raised(forest.select("_tree", "_pos", "_n", "_digest"))
    none = F.array().cast("array<string>")
    start = F.lit(0).cast("long").alias("_pos")
    top = cut(root.select("_tree", start, none.alias("_lefts"), none.alias("_rights"), F.lit("").alias("_subroot"), F.col("_digest").alias("_root")), "top")
    above = lowered(upper, top)
    sources = forest.select("_source", "_tree", "_pos", F.col("_digest").alias("_sub")).join(above, ["_tree", "_pos"])
    tops = cut(sources.select(F.col("_source").alias("_tree"), start, "_lefts", "_rights", F.col("_sub").alias("_subroot"), "_root"), "tops")
    tops = lowered(rounds[1:], tops)
    for step in (root, above, forest, *upper[1:], *rounds[1:], *([subroots] if rounds else [])):
        drop_cut(step)

    def work(block):
        above, subroot, root = chained(zip(*block[0][5:7])), *block[0][7:9]
        nodes = block[1:]
        levels = min(LEVELS, height(nodes[0][3]))
        _, received = sweep_up([r[4] for r in nodes], levels)
        for i, proof in sweep_down(received, levels, above):
            leaf, doc, changed = nodes[i][4], *nodes[i][9:]
            folded = fold(changed or leaf, proof)
            yield doc, leaf, subroot, root, digest(proof_text(proof)), folded, folded == root

    schema = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _swept(_with_heads(placed, tops, "doc_id", "changed"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}", work)
