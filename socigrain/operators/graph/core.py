"""Graphs as vertex and edge tables, keyed by ``graph_id`` so that many graphs share one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ...functions.numbers import correlation
from ...session import cut, drop_cut
from ..skew import HOT_ROWS, hot_keys, lookup_join, number_rows

ONE_GRAPH = "all"


@dataclass(frozen=True)
class Network:
    """``vertices`` (graph_id, id); ``edges`` (graph_id, src, dst, weight), no parallel edges.

    Undirected edges are stored once with src <= dst.
    """

    vertices: DataFrame
    edges: DataFrame
    directed: bool

    def arcs(self) -> DataFrame:
        """Directed arcs: an undirected edge gives both directions, a self loop one."""
        if self.directed:
            return self.edges
        back = self.edges.filter("src <> dst").select("graph_id", F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
        return self.edges.unionByName(back)

    def checkpointed(self) -> "Network":
        return Network(cut(self.vertices), cut(self.edges), self.directed)

    def undirected(self) -> "Network":
        if not self.directed:
            return self
        return network(self.edges, self.vertices, directed=False, graph_id="graph_id", weight="weight")


def network(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    directed: bool = True,
    graph_id: str | None = None,
    weight: str | None = None,
    keep_loops: bool = True,
) -> Network:
    """Build a network from any edge list; weights of parallel edges add up, without weight they are 1."""
    g = (F.col(graph_id) if graph_id else F.lit(ONE_GRAPH)).alias("graph_id")
    src, dst = F.col("src"), F.col("dst")
    if not directed:
        src, dst = F.least("src", "dst"), F.greatest("src", "dst")
    e = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if not keep_loops:
        e = e.filter("src <> dst")
    w = F.sum(F.col("_w")) if weight else F.lit(1.0)
    e = e.select(g, src.alias("src"), dst.alias("dst"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"))
    e = e.groupBy("graph_id", "src", "dst").agg((F.sum("_w") if weight else F.max("_w")).alias("weight"))
    ends = e.select("graph_id", F.explode(F.array("src", "dst")).alias("id"))
    if vertices is not None:
        own = vertices.select(F.col("graph_id") if "graph_id" in vertices.columns else F.lit(ONE_GRAPH).alias("graph_id"), "id")
        ends = ends.unionByName(own)
    return Network(ends.distinct(), e, directed)


class ArcTable:
    """Arcs cut in slices by source degree, so that a hub's arcs are spread over tasks.

    Every source is cut by the same rule, one slice per ``slice_rows`` arcs.  Arcs are dealt out by
    (source, slice) once and kept on disk that way: each round only moves the state.
    """

    def __init__(self, arcs: DataFrame, slice_rows: int = HOT_ROWS):
        self.keys = ["graph_id", "src"]
        self.hot = cut(hot_keys(arcs, self.keys, slice_rows))
        sliced = lookup_join(arcs, self.hot, self.keys)
        sliced = sliced.withColumn(
            "_slice", F.coalesce(F.pmod(F.xxhash64("dst"), F.col("_salts")), F.lit(0)).cast("int")
        ).drop("_salts")
        count = int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.arcs = sliced.repartition(count, *self.keys, "_slice").persist(StorageLevel.DISK_ONLY)

    def drop(self) -> None:
        self.arcs.unpersist()
        drop_cut(self.hot)

    def send(self, state: DataFrame, key: str = "id") -> DataFrame:
        """Every arc with the state of its source; ``key`` names the vertex column of the state."""
        s = state.withColumnRenamed(key, "src") if key != "src" else state
        copies = lookup_join(s, self.hot, self.keys)
        copies = copies.withColumn(
            "_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        ).drop("_salts")
        return self.arcs.join(copies, [*self.keys, "_slice"], "inner").drop("_slice")


class GraphTotals:
    """Per-graph figures for every vertex: vertices of a large graph are spread over slices."""

    def __init__(self, vertices: DataFrame, slice_rows: int = HOT_ROWS):
        sizes = vertices.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n"))
        self.sizes = cut(sizes.withColumn("_gslices", F.ceil(F.col("n") / F.lit(slice_rows)).cast("int")))
        hot = hot_keys(vertices, ["graph_id"], slice_rows)
        sliced = lookup_join(vertices, hot, "graph_id").withColumn(
            "_gslice", F.coalesce(F.pmod(F.xxhash64("id"), F.col("_salts")), F.lit(0)).cast("int")
        ).drop("_salts")
        self.vertices = cut(self.attach(sliced, self.sizes.select("graph_id", "n"), hot))

    def attach(self, state: DataFrame, totals: DataFrame, hot: DataFrame | None = None) -> DataFrame:
        """Left join per-graph rows to a state that carries ``graph_id`` and ``_gslice``."""
        per = totals.join(self.sizes.select("graph_id", "_gslices"), "graph_id", "inner")
        copies = per.withColumn("_gslice", F.explode(F.sequence(F.lit(0), F.col("_gslices") - 1))).drop("_gslices")
        return state.join(copies, ["graph_id", "_gslice"], "left")


def indexed(vertices: DataFrame, name: str = "idx") -> DataFrame:
    """Vertices numbered 0, 1, ... per graph, in hash order, without one task per graph."""
    h = F.xxhash64("id")
    hashed = vertices.select("graph_id", "id", h.alias("_h"))
    return number_rows(hashed, ["graph_id"], ["_h", "id"], F.shiftright("_h", 46), name, 0).drop("_h")


def degrees(net: Network) -> DataFrame:
    """(graph_id, id, degree, in_degree, out_degree); an undirected self loop counts twice."""
    out = net.edges.select("graph_id", F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i"))
    into = net.edges.select("graph_id", F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    none = net.vertices.select("graph_id", "id", F.lit(0).alias("o"), F.lit(0).alias("i"))
    return out.unionByName(into).unionByName(none).groupBy("graph_id", "id").agg(
        F.sum(F.col("o") + F.col("i")).alias("degree"),
        F.sum("i").alias("in_degree"),
        F.sum("o").alias("out_degree"),
    )


def graph_sizes(net: Network) -> DataFrame:
    """(graph_id, nodes, edges, edges_per_node, density)."""
    n = net.vertices.groupBy("graph_id").agg(F.count(F.lit(1)).alias("nodes"))
    m = net.edges.groupBy("graph_id").agg(F.count(F.lit(1)).alias("edges"))
    sized = n.join(m, "graph_id", "left").withColumn("edges", F.coalesce("edges", F.lit(0)))
    pairs = F.col("nodes") * (F.col("nodes") - 1)
    factor = 1.0 if net.directed else 2.0
    return sized.withColumns(
        {
            "edges_per_node": F.col("edges") / F.col("nodes"),
            "density": F.coalesce(F.try_divide(F.lit(factor) * F.col("edges"), pairs), F.lit(0.0)),
        }
    )


def average_degrees(net: Network, positive_only: bool = False) -> DataFrame:
    d = degrees(net)
    cols = ("degree", "in_degree", "out_degree")
    def of(c):
        x = F.col(c)
        return F.avg(F.when(x > 0, x) if positive_only else x).alias(f"avg_{c}")
    return d.groupBy("graph_id").agg(*[of(c) for c in cols])


def degree_centrality(net: Network) -> DataFrame:
    """degree / (n - 1) and its in and out forms."""
    d = degrees(net)
    totals = GraphTotals(net.vertices)
    sized = totals.vertices.join(d, ["graph_id", "id"], "inner")
    return sized.select(
        "graph_id", "id",
        *[F.try_divide(c, F.col("n") - 1).alias(f"{c}_centrality") for c in ("degree", "in_degree", "out_degree")],
    )


def strengths(net: Network) -> DataFrame:
    """Sum of edge weights per node, 0 for isolated nodes."""
    ends = net.edges.select("graph_id", F.explode(F.array_distinct(F.array("src", "dst"))).alias("id"), "weight")
    none = net.vertices.select("graph_id", "id", F.lit(0.0).alias("weight"))
    return ends.unionByName(none).groupBy("graph_id", "id").agg(F.sum("weight").alias("strength"))


def average_strength(net: Network) -> DataFrame:
    return strengths(net).groupBy("graph_id").agg(F.avg("strength").alias("avg_strength"))


def degree_heterogeneity(net: Network) -> DataFrame:
    """Population std of degrees, rounded to an integer first, over the mean degree."""
    return degrees(net).groupBy("graph_id").agg(
        F.try_divide(F.bround(F.stddev_pop("degree"), 0), F.avg("degree")).alias("degree_heterogeneity")
    )


def degree_assortativity(net: Network) -> DataFrame:
    """Pearson correlation of the degrees at both ends over both edge directions."""
    d = degrees(net).select("graph_id", F.col("id"), F.col("degree").cast("double").alias("degree"))
    arcs = net.undirected().arcs()
    with_src = lookup_join(arcs, d.select("graph_id", F.col("id").alias("src"), F.col("degree").alias("src_degree")), ["graph_id", "src"], "inner")
    both = lookup_join(with_src, d.select("graph_id", F.col("id").alias("dst"), F.col("degree").alias("dst_degree")), ["graph_id", "dst"], "inner")
    return both.groupBy("graph_id").agg(correlation(F.col("src_degree"), F.col("dst_degree")).alias("degree_assortativity"))


def measure_filter(measures: DataFrame, value: str, limit: float = 0.0, n: int | None = None, descending: bool = True) -> DataFrame:
    """Keep values above a limit, rounded to 4 decimals, sorted, optionally the first n."""
    kept = measures.filter(F.col(value) > limit).withColumn(value, F.bround(F.col(value), 4))
    ordered = kept.orderBy(F.desc(value) if descending else F.asc(value), "graph_id", "id")
    return ordered if n is None else ordered.limit(n)
