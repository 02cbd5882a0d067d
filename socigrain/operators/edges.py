"""Node and edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import paired_items
from .rollups import active_accounts
from .skew import lookup_join


def nodes(posts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts with at least one post.  ``out_d`` are followers, ``in_d`` friends, as named upstream."""
    return active_accounts(posts, accounts).withColumns(
        {"out_d": F.col("followers_count").cast("double"), "in_d": F.col("friends_count").cast("double")}
    )


def drop_self_loops(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("src") != F.col("dst"))


def between_nodes(edges: DataFrame, node_ids: DataFrame, src: bool = True, dst: bool = True) -> DataFrame:
    """Edges whose ends are nodes; hub ends are split over tasks."""
    for end in [c for c, on in (("src", src), ("dst", dst)) if on]:
        ids = node_ids.select(F.col("user_id").alias(end)).distinct()
        edges = lookup_join(edges, ids, end, "left_semi")
    return edges


def follow_edges(node_ids: DataFrame, follow_lists: DataFrame) -> DataFrame:
    """(friend -> node) for every friend of a node that is a node itself."""
    e = follow_lists.select(F.explode("friends").alias("src"), F.col("user_id").alias("dst"))
    return between_nodes(e, node_ids)


def mention_edges(node_ids: DataFrame, posts: DataFrame) -> DataFrame:
    """(author -> mentioned) per mention, duplicates kept, no self mentions."""
    e = posts.select(F.col("user_id").alias("src"), F.explode("mention_ids").alias("dst"))
    return between_nodes(drop_self_loops(e), node_ids)


def repost_edges(node_accounts: DataFrame, posts: DataFrame) -> DataFrame:
    """One edge per repost from the original author to the reposter, with its attributes."""
    e = drop_self_loops(
        posts.filter(F.col("repost_of_id").isNotNull()).select(
            F.col("repost_of_user_id").alias("src"),
            F.col("user_id").alias("dst"),
            F.col("id").alias("repost_id"),
            F.col("created_at").alias("reposted_at"),
            F.col("repost_of_id").alias("post_id"),
            F.col("repost_created_at").alias("posted_at"),
            F.col("repost_delay_sec").alias("delay_sec"),
            "lang",
            "full_text",
        )
    )
    for end in ("src", "dst"):
        names = node_accounts.select(F.col("user_id").alias(end), F.col("screen_name").alias(f"{end}_name"))
        e = lookup_join(e, names, end, "inner")
    return e


def edge_coverage(node_ids: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, nodes with source edges, edges."""
    sources = edges.select(F.count_distinct("src")).scalar()
    total = edges.select(F.count(F.lit(1))).scalar()
    return node_ids.agg(F.count_distinct("user_id").alias("nodes")).withColumns(
        {"nodes_with_edges": sources, "edges": total}
    )


def tag_repost_edges(posts: DataFrame) -> DataFrame:
    """(tag, src = original author, dst = reposter) per tag of a repost."""
    return posts.filter("is_repost").select(
        F.explode("all_tags").alias("tag"),
        F.col("repost_of_screen_name").alias("src"),
        F.col("screen_name").alias("dst"),
    )


def user_tag_edges(posts: DataFrame, top_tags: DataFrame | None = None) -> DataFrame:
    """(user -> tag) uses in originals by users who also repost tags, optionally of listed tags."""
    tagged = posts.withColumn("dst", F.explode("all_tags"))
    reposters = tagged.filter("is_repost").select(F.col("screen_name").alias("src")).distinct()
    originals = tagged.filter("is_original").select(F.col("screen_name").alias("src"), "dst")
    e = lookup_join(originals, reposters, "src", "left_semi")
    if top_tags is not None:
        e = lookup_join(e, top_tags.select(F.col("tag").alias("dst")).distinct(), "dst", "left_semi")
    return e


def tag_pair_edges(posts: DataFrame, top_tags: DataFrame | None = None, tags: str = "all_tags") -> DataFrame:
    """Consecutive, non-overlapping tag pairs of a post, the first one optionally of listed tags."""
    e = posts.select(F.explode(paired_items(F.col(tags))).alias("p")).select("p.src", "p.dst")
    if top_tags is not None:
        e = lookup_join(e, top_tags.select(F.col("tag").alias("src")).distinct(), "src", "left_semi")
    return e


def weighted_pairs(edges: DataFrame, by: Sequence[str] = ("src", "dst")) -> DataFrame:
    return edges.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def simple_graph(edges: DataFrame, directed: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Parallel edges collapse; undirected graphs ignore the order of the ends."""
    if directed:
        return edges.select(*keys, "src", "dst").distinct()
    return edges.select(
        *keys, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    ).distinct()


def min_degree_filter(edges: DataFrame, k: int) -> DataFrame:
    """Remove the nodes of degree below k, once, with their edges (not a k-core)."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("user_id"))
    keep = ends.groupBy("user_id").agg(F.count(F.lit(1)).alias("_d")).filter(F.col("_d") >= k)
    return between_nodes(edges, keep)
