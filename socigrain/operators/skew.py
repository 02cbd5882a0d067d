"""Joins, numbering and windows that keep working when one key holds a large part of the rows.

Nothing here drops or samples rows.  Plain lookups leave hot keys to adaptive skew joins; graph
arcs, which are joined again and again, are cut in slices by ``hot_keys`` once; numbering and
totals aggregate partially instead of windowing a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut

# Rows of one key that a single task may take before the key is split.
HOT_ROWS = 500_000


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``on`` columns plus ``_salts``: in how many slices each key of more than ``hot_rows`` rows is split."""
    return (
        df.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*on, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts"))
    )


def lookup_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join of a large ``left``, in which a key may be hot, to a ``right`` with few rows per key.

    One plain join: Spark broadcasts the right side when its measured size allows, and otherwise
    adaptive execution splits the hot key's partition (``forceOptimizeSkewedJoin`` is on, see
    ``session``), repeating only that key's few right-hand rows.  ``how`` must keep the left side
    splittable: inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} cannot split a hot left key")
    keys = [on] if isinstance(on, str) else list(on)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return left.join(right, keys, how).select(*[f"`{c}`" for c in [*left.columns, *added]])


def with_group_totals(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Add group aggregates to every row: partial aggregation and a split lookup, not a window."""
    totals = df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggs.items()])
    return lookup_join(df, totals, list(keys), "left")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    name: str = "rn",
    start: int = 1,
) -> DataFrame:
    """Row number per key without one task per key.

    ``bucket`` must not decrease along ``order`` inside a key.  Rows are ranked inside
    (key, bucket) and shifted by the number of rows in the key's earlier buckets; only the
    per-bucket counts are windowed over the whole key.
    """
    keyed = df.withColumn("_bucket", bucket)
    offsets = keyed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = offsets.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = keyed.withColumn("_inside", F.row_number().over(inside))
    return (
        ranked.join(offsets, [*keys, "_bucket"], "inner")
        .withColumn(name, F.col("_inside") + F.col("_before") + F.lit(start - 1))
        .drop("_bucket", "_inside", "_before")
    )


def number_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn", start: int = 1) -> DataFrame:
    """Row number per key along any order, without one task per key and without a bucket rule.

    Rows are dealt out by ranges of (keys, order) whose limits Spark samples, and stored, so that a range
    stays what it is; a range is ranked by itself and shifted by the counts of the key's earlier ranges.
    Limits decide the cost, not the numbers.  Rows that ``order`` can't tell apart share a range.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(ranges, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    return number_rows(dealt, keys, order, F.col("_range"), name, start).drop("_range")
