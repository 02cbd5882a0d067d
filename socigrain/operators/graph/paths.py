"""Shortest-path measures.

Hop distances use bit-parallel breadth-first search over blocks of vertices (``reach``): every measure
is summed up level by level without a table of all pairs.  Path counts and weighted distances have a column per
source instead of a bit (``packed``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from ...session import StoredSteps, cut, drop_cut, release
from . import counted, packed, reach
from .components import connected_components, giant_members
from .core import ArcTable, GraphTotals, Network


def _no_loops(arcs: DataFrame) -> DataFrame:
    return arcs.filter("src <> dst")


def hop_measures(net: Network, words: int = 32, batches_at_once: int = 64) -> DataFrame:
    """(graph_id, id, reach, sum_dist, sum_inv, ecc) over the sources that reach each vertex.

    Exact, from all sources.  In a directed graph distances are towards the vertex.  ``words`` words of 64
    sources go side by side, ``batches_at_once`` such chunks at a time (``reach``).  ``hop_estimates`` is for
    graphs where all sources are too many.
    """
    numbered, parts = reach.gains(net, _no_loops(net.arcs()), words, batches_at_once)
    zero = {"reach": F.lit(0), "sum_dist": F.lit(0), "sum_inv": F.lit(0.0), "ecc": F.lit(0)}
    if not parts:
        return net.vertices.select("graph_id", "id", *[c.alias(name) for name, c in zero.items()])
    summed = _union(parts).groupBy("graph_id", "block", "place").agg(
        F.sum("n").alias("reach"), F.sum(F.col("n") * F.col("step")).alias("sum_dist"),
        F.sum(F.col("n") / F.col("step").cast("double")).alias("sum_inv"), F.max("step").cast("int").alias("ecc"))
    by_idx = summed.withColumn("idx", F.col("block") * reach.BLOCK + F.col("place")).drop("block", "place")
    # vertices that nothing reaches have zeros
    joined = numbered.join(by_idx, ["graph_id", "idx"], "left")
    return joined.select("graph_id", "id", *[F.coalesce(name, c).alias(name) for name, c in zero.items()])


def hop_estimates(net: Network, lg_k: int = 11) -> DataFrame:
    """(graph_id, id, reach, sum_dist, sum_inv, ecc) as ``hop_measures``, estimated for any number of vertices.

    HyperBall: the vertices within t hops of a vertex are a distinct counter of 2^lg_k registers, and a round
    unites the counters along the arcs.  The relative standard error of a counter, and so about that of
    ``reach`` and of the sums, is 1.04 / sqrt(2^lg_k): 2.3 % at 11, 1.6 % at 12; sets far smaller than 2^lg_k
    are counted exactly.  ``ecc`` is the last round that raised the vertex's estimate: it can be too small, and
    too great by a round where the counter changes its form.
    State is one counter per vertex whatever the number of sources; a round writes the counters it raised.
    """
    key = ["graph_id", "id"]
    table = ArcTable(_no_loops(net.arcs()))
    steps = StoredSteps(net.vertices.sparkSession, "balls")
    first = net.vertices.groupBy(*key).agg(F.hll_sketch_agg(F.xxhash64("id"), F.lit(lg_k)).alias("ball"))
    counted = F.hll_sketch_estimate("ball").cast("double")
    front = steps.add(first.withColumn("near", counted))
    while not front.isEmpty():
        latest = steps.all().groupBy(*key).agg(F.max_by("ball", "step").alias("_had"), F.max("near").alias("_near"))
        met = table.send(front.select(*key, "ball")).groupBy("graph_id", F.col("dst").alias("id")).agg(F.hll_union_agg("ball").alias("_got"))
        grown = met.join(latest, key).select(*key, F.hll_union("_had", "_got").alias("ball"), "_near").withColumn("near", counted)
        front = steps.add(grown.filter("near > _near").drop("_near"))
    rise = F.col("near") - F.coalesce(F.lag("near").over(W.partitionBy(*key).orderBy("step")), F.lit(0.0))
    rises = steps.all().select(*key, "step", "near").withColumn("_n", F.when(F.col("step") > 0, rise).otherwise(0.0))
    out = cut(rises.groupBy(*key).agg(
        F.sum("_n").alias("reach"), F.sum(F.col("_n") * F.col("step")).alias("sum_dist"),
        F.sum(F.coalesce(F.try_divide("_n", "step"), F.lit(0.0))).alias("sum_inv"), F.max("step").alias("ecc")))
    steps.drop(), table.drop()
    return out


def closeness(hops: DataFrame, net: Network) -> DataFrame:
    """Wasserman-Faust closeness: (r / sum of distances) * (r / (n - 1)), r = vertices reaching it."""
    sized = GraphTotals(net.vertices).vertices.join(hops, ["graph_id", "id"], "left")
    c = F.try_divide("reach", "sum_dist") * F.try_divide("reach", F.col("n") - 1)
    return sized.select("graph_id", "id", F.coalesce(c, F.lit(0.0)).alias("closeness"))


def path_summary(net: Network, hops: DataFrame, components: DataFrame | None = None) -> DataFrame:
    """(graph_id, avg_path, diameter) on the giant component, global efficiency and reaching centrality."""
    comps = connected_components(net) if components is None else components
    giant = hops.join(giant_members(comps), ["graph_id", "id"], "left_semi")
    on_giant = giant.groupBy("graph_id").agg(
        F.try_divide(F.sum("sum_dist"), F.count(F.lit(1)) * (F.count(F.lit(1)) - 1)).alias("avg_path"),
        F.max("ecc").alias("diameter"),
    )
    everywhere = net.vertices.join(hops, ["graph_id", "id"], "left").groupBy("graph_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("sum_inv", F.lit(0.0))).alias("inv"),
        F.max(F.coalesce("sum_inv", F.lit(0.0))).alias("top"),
    )
    n = F.col("n")
    return on_giant.join(
        everywhere.select(
            "graph_id",
            F.try_divide("inv", n * (n - 1)).alias("global_efficiency"),
            # sum over v of (max C - C_v) / (n - 1) with C_v = sum_inv / (n - 1)
            F.try_divide(n * F.col("top") - F.col("inv"), (n - 1) * (n - 1)).alias("global_reaching"),
        ),
        "graph_id", "inner",
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _reversed(arcs: DataFrame) -> DataFrame:
    return arcs.select("graph_id", F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")


def betweenness(net: Network, weighted: bool = False, normalised: bool = True, sources_at_once: int = 2048) -> DataFrame:
    """Brandes betweenness of every vertex, exact: by chunks of sources (``counted``), with weights one batch after the other."""
    arcs = cut(_no_loops(net.arcs()), "arcs")
    parts = [net.vertices.select("graph_id", "id", F.lit(0.0).alias("own"))]
    if weighted:
        for sources in packed.source_batches(net, sources_at_once):
            parts.append(packed.weighted_dependencies(arcs, sources))
    else:
        parts += _counted_dependencies(net, arcs)
    summed = _union(parts).groupBy("graph_id", "id").agg(F.sum("own").alias("b"))
    sized = GraphTotals(net.vertices).vertices.join(summed, ["graph_id", "id"], "left")
    b = F.coalesce("b", F.lit(0.0))
    if normalised:
        b = F.coalesce(F.try_divide(b, (F.col("n") - 1) * (F.col("n") - 2)), F.lit(0.0))
    elif not net.directed:
        b = b / 2
    return sized.select("graph_id", "id", b.alias("betweenness"))


def _stored_levels(blocks: counted.Blocks, sources: DataFrame) -> StoredSteps:
    steps = StoredSteps(blocks.spark, "levels")
    rounds = blocks.levels(sources)
    level = next(rounds)
    try:
        while True:
            level = rounds.send(steps.add(level))
    except StopIteration:
        return steps


def _counted_dependencies(net: Network, arcs: DataFrame) -> list[DataFrame]:
    """Tables of (graph_id, id, own), one per pass: the sum over its sources of their dependencies on each vertex."""
    blocks = counted.Blocks(net, arcs, back=True)
    parts = []
    for sources in blocks.passes():
        steps = _stored_levels(blocks, sources)
        release(blocks.spark)
        if steps.count > 1:
            found = blocks.dependencies(steps)
            own = blocks.by_vertex(found.all()).groupBy("graph_id", "idx").agg(F.sum("own").alias("own"))
            parts.append(cut(own.join(blocks.numbered, ["graph_id", "idx"]).select("graph_id", "id", "own"), "own"))
            found.drop()
        steps.drop()
        release(blocks.spark)
    blocks.drop()
    return parts


def edge_betweenness(net: Network, sources_at_once: int = 2048) -> DataFrame:
    """(graph_id, src, dst, betweenness), unnormalised; both directions of an undirected edge count."""
    arcs = cut(_no_loops(net.arcs()), "arcs")
    table = ArcTable(arcs)
    back = ArcTable(_reversed(arcs)) if net.directed else table
    parts = [arcs.select("graph_id", "src", "dst", F.lit(0.0).alias("b"))]
    for sources in packed.source_batches(net, sources_at_once):
        steps = packed.levels(table, sources, net.directed)
        found, along = packed.dependencies(back, steps, edges=True)
        if along.count:
            parts.append(cut(along.all().groupBy("graph_id", "src", "dst").agg(F.sum("b").alias("b")), "along"))
        steps.drop(), found.drop(), along.drop()
    for t in {id(t): t for t in (table, back)}.values():
        t.drop()
    ends = (F.col("src"), F.col("dst")) if net.directed else (F.least("src", "dst"), F.greatest("src", "dst"))
    half = 1.0 if net.directed else 0.5
    return _union(parts).groupBy("graph_id", ends[0].alias("src"), ends[1].alias("dst")).agg((F.sum("b") * half).alias("betweenness"))


def mean_path_nodes(net: Network) -> DataFrame:
    """(graph_id, id, path_nodes): ceil of the mean number of nodes on every shortest path from id.

    Paths are weighted by their number, never listed; the path of a vertex to itself has one node.  Of a level
    only its sums per source are kept once the next one is there.
    """
    blocks = counted.Blocks(net, _no_loops(net.arcs()))
    sums = []
    for sources in blocks.passes():
        totals = StoredSteps(blocks.spark, "path-sums")
        rounds = blocks.levels(sources)
        level, last = next(rounds), None
        try:
            while True:
                stored = cut(level, "level")
                totals.add(blocks.by_source(stored))
                if last is not None:
                    drop_cut(last)
                last = stored
                level = rounds.send(stored)
        except StopIteration:
            drop_cut(last)
        each = totals.all().groupBy("graph_id", "idx").agg(F.sum(F.col("n") * (F.col("step") + 1)).alias("p"), F.sum("n").alias("n"))
        sums.append(cut(each.join(blocks.numbered, ["graph_id", "idx"]).select("graph_id", "id", F.ceil(F.col("p") / F.col("n")).alias("path_nodes"))))
        totals.drop()
        release(blocks.spark)
    blocks.drop()
    return _union(sums) if sums else net.vertices.select("graph_id", "id", F.lit(1).cast("long").alias("path_nodes"))


def weighted_closeness(net: Network, sources_at_once: int = 2048) -> DataFrame:
    """Wasserman-Faust closeness with edge weights as distances."""
    arcs = cut(_no_loops(net.arcs()), "arcs")
    parts = []
    for sources in packed.source_batches(net, sources_at_once):
        dist = packed.Distances(arcs, sources)
        parts.append(cut(dist.state().selectExpr(
            "graph_id", "id", "cast(size(filter(x, v -> v > 0)) AS bigint) AS reach", f"{packed.added('transform(x, v -> coalesce(v, 0D))')} AS sum_dist",
        ).groupBy("graph_id", "id").agg(F.sum("reach").alias("reach"), F.sum("sum_dist").alias("sum_dist"))))
        dist.drop()
    hops = _union(parts).groupBy("graph_id", "id").agg(F.sum("reach").alias("reach"), F.sum("sum_dist").alias("sum_dist"))
    return closeness(hops, net)
