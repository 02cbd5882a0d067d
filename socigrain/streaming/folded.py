"""Aggregates that micro-batches keep up: partial results per batch, folded together now and then."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import _delete


class FoldedTable:
    """Keyed values that merge (sums, smallest and largest values), one folder per micro-batch.

    A batch writes its own partial result, so a batch that is run again after a failure replaces what
    its first run wrote.  Every ``fold_every`` batches all that is known is folded into one folder, so a
    reader opens one folded folder and fewer than ``fold_every`` small ones, however long the stream runs.
    Folders that a rerun of the present batch can't need any more are deleted.  ``merge`` names the
    function of each value column (sum, min or max); with no value columns the table is a set of keys.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, merge: dict[str, str], fold_every: int = 16):
        self.spark, self.root, self.schema, self.merge, self.every = spark, root, schema, merge, fold_every
        self.columns = spark.createDataFrame([], schema).columns
        self.keys = [c for c in self.columns if c not in merge]

    def merged(self, partial: DataFrame) -> DataFrame:
        if not self.merge:
            return partial.select(*self.keys).distinct()
        values = [getattr(F, how)(c).alias(c) for c, how in self.merge.items()]
        return partial.groupBy(*self.keys).agg(*values).select(*self.columns)

    def _parts(self, last: int, folded: int) -> DataFrame:
        paths = [f"{self.root}/folded={folded}"] if folded >= 0 else []
        paths += [f"{self.root}/part={n}" for n in range(folded + 1, last + 1)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _last_fold(self, last: int) -> int:
        return (last + 1) // self.every * self.every - 1

    def write(self, batch: int, partial: DataFrame) -> None:
        self.merged(partial).write.mode("overwrite").parquet(f"{self.root}/part={batch}")
        if self._last_fold(batch) != batch:
            return
        before = batch - self.every
        self.merged(self._parts(batch, before)).write.mode("overwrite").parquet(f"{self.root}/folded={batch}")
        # a rerun of this batch reads the fold before it and the parts since then
        _delete(self.spark, f"{self.root}/folded={before - self.every}")
        for n in range(max(before - self.every + 1, 0), before + 1):
            _delete(self.spark, f"{self.root}/part={n}")

    def read(self, last: int, only: DataFrame | None = None) -> DataFrame:
        """The state after batch ``last``; of the keys in ``only`` when that is given."""
        parts = self._parts(last, self._last_fold(last))
        return self.merged(parts if only is None else parts.join(only, only.columns, "left_semi"))


def drain(stream: DataFrame, accept: Callable[[DataFrame, int], None], progress: str) -> int:
    """Run ``accept`` over what has arrived; returns the last batch ever committed, -1 for none."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.foreachBatch(accept).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{progress}/commits")
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)
