"""Landed files -> DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.arrays import revive_list
from .schemas import FOLLOW_LISTS, RAW_ACCOUNT, RAW_POST


def scan_posts_json(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """All posts below a path.  Files holding one JSON array need ``multiline``; JSON lines split."""
    return spark.read.schema(RAW_POST).option("multiLine", multiline).option(
        "recursiveFileLookup", True).json(path)


def scan_accounts_json(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(RAW_ACCOUNT).option("multiLine", multiline).option(
        "recursiveFileLookup", True).json(path)


def scan_follow_lists(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Files with one object ``{user id: {friends, followers, ...}}`` -> one row per user.

    ``lines``: every line holds such an object; large inputs want this form, since a file that is
    one object is one row of one task.
    """
    docs = spark.read.text(path, wholetext=not lines, recursiveFileLookup=True)
    entries = docs.select(F.explode(F.from_json("value", FOLLOW_LISTS)).alias("user_id", "lists"))
    return entries.select(F.col("user_id").cast("bigint").alias("user_id"), "lists.*")


def follow_coverage(nodes: DataFrame, follow_lists: DataFrame) -> DataFrame:
    """How many nodes have a follow list; a missing file is counted, not an error."""
    has = follow_lists.select("user_id").distinct().withColumn("_has", F.lit(True))
    return nodes.select("user_id").join(has, "user_id", "left").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.col("_has").isNotNull()).alias("found"),
        F.count_if(F.col("_has").isNull()).alias("not_found"),
    )


def scan_dated_csv(spark: SparkSession, root: str, schema: str, lists: dict[str, str] | None = None) -> DataFrame:
    """Union of the CSV files of every date folder; text cells may hold newlines and quotes.

    ``lists`` names columns written as list literals with their item type; they come back typed.
    """
    df = (
        spark.read.schema(schema)
        .options(header=True, multiLine=True, quote='"', escape='"', recursiveFileLookup=True)
        .csv(root)
    )
    return df.withColumns({c: revive_list(F.col(c), t) for c, t in (lists or {}).items()})


def read_ids(spark: SparkSession, path: str, column: str | None = None, lines: bool = False) -> DataFrame:
    """A JSON list of ids, or one key of each item of a JSON list; an absent file is empty.

    ``lines``: every line holds a list, for large inputs.
    """
    item = "bigint" if column is None else f"struct<`{column}`:bigint>"
    try:
        docs = spark.read.text(path, wholetext=not lines)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "user_id bigint")
    items = docs.select(F.explode(F.from_json("value", f"array<{item}>")).alias("x"))
    return items.select((F.col("x") if column is None else F.col(f"x.{column}")).alias("user_id"))


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """JSON object ``{user: max id}`` -> (user_id, max_id); of a repeated key the largest id counts."""
    docs = spark.read.text(path, wholetext=True)
    pairs = docs.select(F.explode(F.regexp_extract_all("value", F.lit(r'("\d+"\s*:\s*\d+)'), 1)).alias("p"))
    split = pairs.select(
        F.regexp_extract("p", r'"(\d+)"', 1).cast("bigint").alias("user_id"),
        F.regexp_extract("p", r":\s*(\d+)", 1).cast("bigint").alias("max_id"),
    )
    return split.groupBy("user_id").agg(F.max("max_id").alias("max_id"))


def load_population(spark: SparkSession, folder: str) -> DataFrame:
    """Folder of per-individual CSVs (frame, pos x, pos y) -> (entity, frame, pos_x, pos_y), rounded.

    The individual is the file's name, or ``entity``: the files' folder or, where individuals share files, a column.
    """
    raw = spark.read.options(header=True).csv(folder)
    name = F.col("entity").cast("string") if "entity" in raw.columns else F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1)
    return population_from(raw.withColumn("entity", name))


def population_from(raw: DataFrame) -> DataFrame:
    """Tracking rows with an ``entity``: first column is the frame, spaces in names become ``_``."""
    raw = raw.withColumnsRenamed({c: c.strip().replace(" ", "_") for c in raw.columns})
    return raw.select(
        "entity",
        F.col(raw.columns[0]).cast("bigint").alias("frame"),
        F.bround(F.col("pos_x").cast("double"), 0).alias("pos_x"),
        F.bround(F.col("pos_y").cast("double"), 0).alias("pos_y"),
    )


def file_headers(spark: SparkSession, folder: str) -> DataFrame:
    """(file, header): the first line of every file below a folder, files named by their whole path."""
    lines = spark.read.text(folder, recursiveFileLookup=True).select(
        F.input_file_name().alias("file"), "value", F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("_i"),
    )
    return lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "_i").alias("header"))


def compare_headers(headers: DataFrame, expected: list[str]) -> DataFrame:
    """(file, ok): does each file's header equal the expected columns, in order?"""
    return headers.select(
        F.regexp_extract("file", r"([^/]+)$", 1).alias("file"),
        (F.col("header") == ",".join(expected)).alias("ok"),
    )


def check_columns(spark: SparkSession, folder: str, expected: list[str]) -> DataFrame:
    """(file, ok): does each CSV's header equal the expected columns, in order?  Compares the first line of every file."""
    return compare_headers(file_headers(spark, folder), expected)
