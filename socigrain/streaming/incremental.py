"""Incremental loads over arriving files: the batch contract of ``operators.baseline`` as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.baseline import newer_than_marks
from .folded import FoldedTable, drain

STAMP = "created_at"


def new_posts(posts: DataFrame, delay: str = "7 days", key: str = "id") -> DataFrame:
    """Streaming posts without repeats; state is bounded by the watermark."""
    return posts.withWatermark(STAMP, delay).dropDuplicatesWithinWatermark([key])


def tag_day_stream(posts: DataFrame, delay: str = "7 days", tags: str = "all_tags") -> DataFrame:
    """Uses and favourites per tag and day, updated as posts arrive."""
    tagged = posts.withWatermark(STAMP, delay).select(
        STAMP, F.explode(tags).alias("tag"), "original_favourite_cnt"
    )
    return tagged.groupBy(F.window(STAMP, "1 day").alias("w"), "tag").agg(
        F.count(F.lit(1)).alias("tag_cnt"), F.sum("original_favourite_cnt").alias("favourite_cnt")
    ).select(F.date_format("w.start", "yyyy-MM-dd").alias("day_name"), "tag", "tag_cnt", "favourite_cnt")


class MarkedTable:
    """A table of accepted posts with high-water marks, written one micro-batch after the other.

    Each batch has its own folder named by its number, so a batch that is run again after a
    failure replaces what its first run wrote.  A batch writes the marks that it may have moved
    only; a user's mark is the largest one written so far, and marks are folded now and then.
    """

    def __init__(self, spark: SparkSession, root: str, fold_every: int = 16):
        self.spark, self.root = spark, root
        self.moved = FoldedTable(spark, f"{root}/marks", "user_id bigint, max_id bigint", {"max_id": "max"}, fold_every)

    def accept(self, batch_rows: DataFrame, batch: int) -> None:
        fresh = newer_than_marks(batch_rows, self.marks(batch - 1))
        fresh.write.mode("overwrite").parquet(f"{self.root}/posts/batch={batch}")
        stored = self.spark.read.schema(batch_rows.schema).parquet(f"{self.root}/posts/batch={batch}")
        self.moved.write(batch, stored.select("user_id", F.col("id").alias("max_id")))

    def run(self, stream: DataFrame) -> int:
        """Drain what has arrived; returns the last batch committed."""
        return drain(stream, self.accept, f"{self.root}/progress")

    def posts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/posts").drop("batch")

    def marks(self, last_batch: int) -> DataFrame:
        """Marks after a batch: the last one or the one before, since older folds are deleted."""
        return self.moved.read(last_batch)


def arriving_parquet(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
