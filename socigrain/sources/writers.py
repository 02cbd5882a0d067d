"""DataFrames -> files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


def write_table(df: DataFrame, path: str, overwrite: bool = True, partition_by: Sequence[str] = ()) -> None:
    """Overwrite or append; date folders are partitions, so readers prune them."""
    writer = df.write.mode("overwrite" if overwrite else "append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_clean_csv(df: DataFrame, path: str) -> None:
    """Quoted UTF-8 CSV.  Array columns become JSON lists."""
    flat = df.select(
        *[
            F.to_json(c).alias(c) if t.startswith("array") else F.col(c)
            for c, t in df.dtypes
        ]
    )
    flat.write.mode("overwrite").options(header=True, quoteAll=True, escape='"', encoding="UTF-8").csv(path)


def write_edges(edges: DataFrame, path: str) -> bool:
    """Edge CSV with a header; nothing is written for an empty table."""
    if edges.isEmpty():
        return False
    edges.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_edges_by_tag(edges: DataFrame, path: str, tags: Sequence[str]) -> None:
    """One folder per listed tag, and the whole edge list below ``all``."""
    edges.write.mode("overwrite").option("header", True).csv(f"{path}/all")
    listed = edges.filter(F.col("tag").isin(*tags))
    listed.write.mode("overwrite").partitionBy("tag").option("header", True).csv(f"{path}/by_tag")


def write_population(traj: DataFrame, path: str, entity: str = "entity", frame: str = "frame") -> None:
    """CSV files of trajectories that name the individual in their last column.

    Individuals share files: rows are dealt out by ranges of (entity, frame), so the number of files is that of
    the ranges and doesn't grow with the individuals.
    """
    ranges = int(traj.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = traj.select(*[c for c in traj.columns if c != entity], entity)
    last.repartitionByRange(ranges, entity, frame).write.option("header", True).csv(path)


def archive_snapshot(ids: DataFrame, root: str, reason: str, run_date: str) -> str:
    """Keep a copy of an id table under its reason and date before it is replaced."""
    path = f"{root.rstrip('/')}/history/run_date={run_date}/reason={reason}"
    ids.write.mode("overwrite").parquet(path)
    return path


def with_metrics(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count things while the table is written, without a second scan."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def append_run_metrics(df: DataFrame, path: str, step: str, run_date: str, **metrics: Column) -> DataFrame:
    """One row of metrics per step, appended to the run log."""
    row = df.agg(*[c.alias(n) for n, c in metrics.items()])
    long = row.select(*[F.col(c).cast("double").alias(c) for c in metrics]).unpivot([], list(metrics), "metric", "value")
    long = long.select(F.lit(run_date).alias("run_date"), F.lit(step).alias("step"), "metric", "value")
    long.write.mode("append").parquet(path)
    return long
