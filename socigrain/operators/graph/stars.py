"""Connected components of one edge table by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ...session import cut, drop_cut


def _links_to_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """(a, b, m): every edge with the least vertex around a; a hub's edges stay splittable."""
    return edges.join(least, "a")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def star_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for the ends of ``edges``: component is the least id reachable.

    Directions, loops and repeated edges don't matter; ends that are null are ignored.  Both star
    steps only take a partial minimum per vertex and one join to it, so a hub is never gathered in
    one task.  Rounds run until nothing changes, O(log^2) of the vertices in theory and a handful
    in practice, also on long chains.  Each round ends in a stored table; the one before is deleted.
    """
    base = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a is not null and b is not null and a <> b").distinct()
    ends = edges.select(F.explode(F.array(a, b)).alias("id")).filter("id is not null")
    state = cut(base, "stars")
    before = _state(state)
    while True:
        # large star: neighbours over a go to the least vertex around a
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = _links_to_least(both, least).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a and its lesser neighbours go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _links_to_least(large, least).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        fresh = cut(small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "stars")
        drop_cut(state)
        state, now = fresh, _state(fresh)
        if now == before:
            break
        before = now
    roots = state.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return ends.distinct().join(roots, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
