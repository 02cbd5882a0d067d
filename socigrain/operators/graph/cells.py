"""Triangles by coloured cells, for graphs whose neighbour sets are too large to travel with every edge.

A triangle is found where its three edges meet: vertices are hashed to colours, every multiset of three
colours is a cell, and an edge is sent once to each cell that holds both of its colours.  Cells close
their wedges by themselves, so that no neighbour set travels with an edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ...session import cut
from ..skew import HOT_ROWS, lookup_join
from .core import Network

# Wedges tested at a time inside a cell.
WEDGES = 1_000_000


def triangles_by_cells(net: Network, cell_edges: int = HOT_ROWS) -> DataFrame:
    """(graph_id, a, b, c): every triangle of the undirected simple graph once, a < b < c.

    A graph of m edges gets sqrt(6 m / ``cell_edges``) colours, so that a cell holds some ``cell_edges``
    edges and an edge travels once per colour; graphs of fewer edges are one cell.  Vertices of more than
    m / colours edges, at most twice as many as colours, would crowd their cells: their triangles are
    found from the heavy vertices that both ends of an edge know.
    """
    edges = net.undirected().edges.filter("src <> dst").select("graph_id", "src", "dst")
    m = F.count(F.lit(1))
    large = cut(edges.groupBy("graph_id").agg(
        m.alias("_m"), F.ceil(F.sqrt(F.lit(6.0) * m / F.lit(cell_edges))).cast("int").alias("_colours")
    ).filter("_colours > 1"))
    if large.isEmpty():
        return _closed(edges.select("graph_id", "src", "dst", F.lit(0).cast("bigint").alias("_cell"), F.lit(2).cast("tinyint").alias("_flag")))
    coloured = lookup_join(edges, large, "graph_id")
    ends = coloured.filter("_colours > 1").select("graph_id", F.explode(F.array("src", "dst")).alias("id"), (F.col("_m") / F.col("_colours")).alias("_most"))
    heavy = cut(ends.groupBy("graph_id", "id").agg(F.count(F.lit(1)).alias("_d"), F.max("_most").alias("_most")).filter(
        "_d > _most").select("graph_id", "id", F.lit(True).alias("_heavy")))
    for end in ("src", "dst"):
        named = heavy.select("graph_id", F.col("id").alias(end), F.col("_heavy").alias(f"_heavy_{end}"))
        coloured = lookup_join(coloured, named, ["graph_id", end]).fillna(False, [f"_heavy_{end}"])
    light = coloured.filter(~(F.col("_heavy_src") | F.col("_heavy_dst"))).select("graph_id", "src", "dst", F.coalesce("_colours", F.lit(1)).alias("_k"))
    colour = lambda end: F.pmod(F.xxhash64(end), F.col("_k").cast("bigint"))
    sent = light.withColumns({"_s": colour("src"), "_t": colour("dst")}).withColumn(
        "_z", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k").cast("bigint") - 1)))
    cell = F.array_sort(F.array("_s", "_t", "_z"))
    # 1: both ends of one colour in a cell of another colour too, where three such edges aren't its triangle
    flag = F.when(F.col("_s") != F.col("_t"), 0).when(F.col("_z") == F.col("_s"), 2).otherwise(1)
    return _closed(sent.select(
        "graph_id", "src", "dst", ((cell[0] * F.col("_k") + cell[1]) * F.col("_k") + cell[2]).alias("_cell"), flag.cast("tinyint").alias("_flag")
    )).unionByName(_of_heavy(coloured.filter("_colours > 1")))


def _of_heavy(edges: DataFrame) -> DataFrame:
    """Triangles with a heavy vertex, told by the edge across from the greatest one."""
    knows = edges.filter("_heavy_dst").select("graph_id", F.col("src").alias("id"), F.col("dst").alias("_h")).unionByName(
        edges.filter("_heavy_src").select("graph_id", F.col("dst").alias("id"), F.col("src").alias("_h")))
    known = knows.groupBy("graph_id", "id").agg(F.collect_set("_h").alias("_known"))
    both = edges
    for end in ("src", "dst"):
        named = known.select("graph_id", F.col("id").alias(end), F.col("_known").alias(f"_known_{end}"))
        both = lookup_join(both, named, ["graph_id", end], "inner")
    met = both.select("graph_id", "src", "dst", "_heavy_src", "_heavy_dst", F.explode(F.array_intersect("_known_src", "_known_dst")).alias("_h"))
    greatest = (~F.col("_heavy_src") | (F.col("src") < F.col("_h"))) & (~F.col("_heavy_dst") | (F.col("dst") < F.col("_h")))
    three = F.array_sort(F.array("src", "dst", "_h"))
    return met.filter(greatest).select("graph_id", three[0].alias("a"), three[1].alias("b"), three[2].alias("c"))


def _closed(cells: DataFrame) -> DataFrame:
    """Triangles of (graph_id, _cell)."""
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema}
    schema = f"graph_id {kinds['graph_id']}, a {kinds['src']}, b {kinds['src']}, c {kinds['src']}"
    dealt = cells.repartition("graph_id", "_cell").sortWithinPartitions("graph_id", "_cell")
    return dealt.mapInArrow(_triangles_of_cells, schema)


def _triangles_of_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole cells at a time, as many as arrive together; edges come sorted by cell."""
    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows < WEDGES:
            continue
        table = pa.Table.from_batches(waiting)
        last = _cell_numbers(table)
        whole = int(np.searchsorted(last, last[-1]))
        yield from _close_wedges(table.slice(0, whole), last[:whole])
        rest = table.slice(whole).combine_chunks()
        waiting, rows = rest.to_batches(), 0
    if waiting:
        table = pa.Table.from_batches(waiting)
        yield from _close_wedges(table, _cell_numbers(table))


def _cell_numbers(table: pa.Table) -> np.ndarray:
    """0, 1, ... per cell, in the order of the rows."""
    graph = pc.fill_null(table["graph_id"].combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    cell = table["_cell"].to_numpy()
    new = (graph[1:] != graph[:-1]) | (cell[1:] != cell[:-1])
    return np.concatenate([[0], np.cumsum(new)])[: len(cell)]


def _close_wedges(table: pa.Table, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Edges point to the end of the higher degree; a triangle is an edge u-v, v-w with u-w known."""
    n = table.num_rows
    if n < 3:
        return
    coded = pa.concat_arrays([table[c].combine_chunks() for c in ("src", "dst")]).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    places, vertex = np.unique(np.concatenate([cells, cells]) * len(coded.dictionary) + ids, return_inverse=True)
    size = len(places)
    order = np.lexsort((np.arange(size), np.bincount(vertex, minlength=size)))
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    ends = rank[vertex].reshape(2, n)
    keys = ends.min(0) * size + ends.max(0)
    by_key = np.argsort(keys, kind="stable")
    keys, flags, row = keys[by_key], table["_flag"].to_numpy()[by_key], by_key
    u, v = keys // size, keys % size
    first = np.searchsorted(u, np.arange(size + 1))
    out = (first[1:] - first[:-1])[v]
    until = np.cumsum(out)
    name = coded.dictionary.take(pa.array(places[order] % len(coded.dictionary)))
    start = 0
    while start < n:
        done = until[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(until, done + WEDGES, side="right")))
        counts = out[start:stop]
        edge = np.repeat(np.arange(start, stop), counts)
        inside = np.arange(len(edge)) - np.repeat(np.cumsum(counts) - counts, counts)
        third = first[v[edge]] + inside
        wanted = u[edge] * size + v[third]
        at = np.minimum(np.searchsorted(keys, wanted), n - 1)
        hit = (keys[at] == wanted) & ~((flags[edge] == 1) & (flags[third] == 1) & (flags[at] == 1))
        edge, third = edge[hit], third[hit]
        if len(edge):
            yield _sorted_batch(table["graph_id"].take(pa.array(row[edge])), [name.take(pa.array(x)) for x in (u[edge], v[edge], v[third])])
        start = stop


def _sorted_batch(graph: pa.ChunkedArray, ends: list[pa.Array]) -> pa.RecordBatch:
    """Rows of three ids in ascending order."""
    a, b, c = ends
    for x, y in ((0, 1), (1, 2), (0, 1)):
        three = [a, b, c]
        swap = pc.greater(three[x], three[y])
        three[x], three[y] = pc.if_else(swap, three[y], three[x]), pc.if_else(swap, three[x], three[y])
        a, b, c = three
    return pa.RecordBatch.from_arrays([graph.combine_chunks(), a, b, c], ["graph_id", "a", "b", "c"])
