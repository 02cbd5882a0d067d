"""Id bookkeeping: baselines, candidates, pending ids, high-water marks, snapshots, run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .accounts import latest_per_account, quality_filter
from .skew import lookup_join


def without_ids(ids: DataFrame, *others: DataFrame, key: str = "user_id") -> DataFrame:
    """Set difference: ids in none of the other id tables."""
    for other in others:
        ids = ids.join(other.select(F.col(other.columns[0]).alias(key)).distinct(), key, "left_anti")
    return ids


def union_of_friends(follow_lists: DataFrame) -> DataFrame:
    return follow_lists.select(F.explode("friends").alias("user_id")).distinct()


def candidates_from_follows(follow_lists: DataFrame, baseline: DataFrame, processed: DataFrame) -> DataFrame:
    of_baseline = follow_lists.join(baseline.select("user_id").distinct(), "user_id", "left_semi")
    return without_ids(union_of_friends(of_baseline), baseline, processed)


def candidates_from_mentions(posts: DataFrame, baseline: DataFrame, processed: DataFrame) -> DataFrame:
    ids = posts.select(F.explode("mention_ids").alias("user_id")).distinct()
    return without_ids(ids, baseline, processed)


def candidates_from_reposts(posts: DataFrame, baseline: DataFrame, processed: DataFrame) -> DataFrame:
    ids = posts.select(F.col("repost_of_user_id").alias("user_id")).dropna().distinct()
    return without_ids(ids, baseline, processed)


def pending_ids(baseline: DataFrame, missing: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    others = [missing] + ([] if processed is None else [processed])
    return without_ids(baseline.select("user_id").distinct(), *others)


def filtered_baseline(account_days: DataFrame, preset: str = "production") -> DataFrame:
    """New baseline: accounts passing the quality filter on their latest day."""
    return quality_filter(latest_per_account(account_days), preset).select("user_id", "followers_count")


def bipartite_nodes(edges: DataFrame) -> DataFrame:
    """(id, node_type) of user -> tag edges; an id seen as a user stays a user."""
    users = edges.select(F.col("src").alias("id"), F.lit("user").alias("node_type"))
    tags = edges.select(F.col("dst").alias("id"), F.lit("tag").alias("node_type"))
    both = users.unionByName(tags)
    return both.groupBy("id").agg(
        F.when(F.max(F.col("node_type") == "user"), "user").otherwise("tag").alias("node_type")
    )


def newer_than_marks(rows: DataFrame, marks: DataFrame, key: str = "user_id", id_col: str = "id") -> DataFrame:
    """Rows above their user's high-water mark; users without a mark keep all rows."""
    m = marks.select(key, F.col("max_id").alias("_mark"))
    joined = lookup_join(rows, m, key, "left")
    return joined.filter(F.col("_mark").isNull() | (F.col(id_col) > F.col("_mark"))).drop("_mark")


def advance_marks(marks: DataFrame, rows: DataFrame, key: str = "user_id", id_col: str = "id") -> DataFrame:
    """Marks raised to the largest id seen."""
    seen = rows.groupBy(key).agg(F.max(id_col).alias("max_id"))
    return marks.select(key, "max_id").unionByName(seen).groupBy(key).agg(F.max("max_id").alias("max_id"))


def upsert_latest(existing: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """Dictionary update: a changed key replaces the existing row."""
    tagged = existing.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    w = W.partitionBy(*key).orderBy(F.desc("_new"))
    return tagged.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_new")
