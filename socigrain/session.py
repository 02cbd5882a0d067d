"""Session settings and lineage cuts shared by every operator."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

# Runtime settings only: safe on a session somebody else built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE split a skewed join even when an aggregate above wanted its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "socigrain", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder; a cluster would lose what its
    executors write there, so it raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            folder = current.get()
        elif re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            folder = tempfile.mkdtemp(prefix="socigrain-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for tables written along the way."""
    return f"{shared_dir(spark).rstrip('/')}/socigrain/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "step", compression: str = "snappy") -> DataFrame:
    """End a lineage: write a table in the shared folder and read it back.

    It survives the loss of executors, and unlike a checkpointed plan it has its real size, so
    that Spark can choose joins by it however many rounds an algorithm runs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if "/socigrain/" in path:
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def drop_cut(df: DataFrame) -> None:
    """Delete the table behind a frame that ``cut`` returned, once nothing reads it any more."""
    for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    It deletes them when the driver's JVM collects the plans, by itself only every half hour or under
    pressure; between the steps of a job that is too late for the executors' disks.
    """
    gc.collect()
    spark._jvm.System.gc()


class StoredSteps:
    """Numbered tables of one iteration in one folder: appended to, read together, deleted together.

    A round writes what it changed and nothing else, and however many rounds there are, all of them
    are one scan.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path = spark, scratch_path(spark, label)
        self.schema, self.count = None, 0

    def add(self, df: DataFrame) -> DataFrame:
        """Store the next step and read it back."""
        self.schema = self.schema or df.schema
        df.write.mode("overwrite").parquet(f"{self.path}/step={self.count}")
        self.count += 1
        return self.read(self.count - 1)

    def read(self, *steps: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/step={n}" for n in steps])

    def all(self) -> DataFrame:
        """Every step, with its number in ``step``."""
        whole = StructType([*self.schema.fields, StructField("step", IntegerType())])
        return self.spark.read.schema(whole).parquet(self.path)

    def drop(self) -> None:
        _delete(self.spark, self.path)


def balanced(df: DataFrame) -> DataFrame:
    """Spread a table of fewer files than cores over all cores.

    A few small files with one row group each would otherwise be parsed by as many tasks.  A
    large table has more files than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df
