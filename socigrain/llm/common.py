"""What the operators of this subpackage share: reading, stored steps and Arrow slices.

Text conventions: a word is a maximal run of characters other than ASCII white space
(0x20, 0x09-0x0D), which is what ``bytes.split()`` gives on UTF-8; a null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import cut, drop_cut, release, scratch_path, shared_dir, tune  # noqa: F401

#: Rows of one Arrow batch; documents of some kilobytes make batches of a few megabytes.
BATCH_ROWS = 500
#: Text that a vectorised step takes at a time; a single longer document is taken alone.
CHUNK_BYTES = 2 << 20
WORD = "[^\\x20\\x09-\\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's runtime settings and small Arrow batches."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _print, _text): a row's id and text, with a fingerprint that tells rows of one id apart.

    Rows that repeat both the id and the text share a key.
    """
    return docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text_of(text)).alias("_print"), text_of(text).alias("_text"))


def map_batches(df: DataFrame, schema: str | StructType, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` for a step that looks at one batch at a time; empty batches are skipped."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string or binary column with about ``limit`` bytes each."""
    offsets = offsets_of(column)
    start = 0
    while start < len(column):
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(column))
        yield start, end
        start = end


def offsets_of(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, one after the other, and where each row starts and ends."""
    offsets = offsets_of(column)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def raw_texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``keyed`` rows that carry the whole source row as the struct ``_row``, whatever its columns are called."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*own).alias("_row"), F.col(doc_id).alias("_doc"), F.xxhash64(text_of(text)).alias("_print"), text_of(text).alias("_text"))
