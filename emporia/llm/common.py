"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.session import bounded_batches, checkpoint_dir, ship_code

#: Text handed to one numpy step. Arrays of a step take a few dozen bytes per byte of text.
STEP_BYTES = 1 << 20
#: The same for the operators whose steps take most.
SMALL_STEP = 1 << 18


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{_saved_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _saved_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/saved/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete what ``saved`` wrote for this application. Call it when the results are written: until then they read it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_saved_folder(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder (small tables of iterative steps)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_batches(spark: SparkSession) -> None:
    """Session settings of the Python tasks: the package's code, and rows and bytes per Arrow batch."""
    ship_code(spark)
    bounded_batches(spark)


def row_key() -> list:
    """(doc_id, _h): names one row for joins back to it; rows that repeat an id stay apart by their text.

    ``_h`` is never null, so the pair can be joined with ``same_row``.
    """
    return [F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_h")]


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        col = col.cast(pa.string() if pa.types.is_large_string(col.type) else pa.binary())
    return col.fill_null("" if pa.types.is_string(col.type) else b"")


def raw_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the rows' offsets in them; no copy."""
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, dtype=np.int32, count=len(col) + 1, offset=col.offset * 4).astype(np.int64)
    if data is None or o[-1] == o[0]:
        return np.zeros(0, np.uint8), np.zeros(len(o), np.int64)
    return np.frombuffer(data, dtype=np.uint8, count=o[-1] - o[0], offset=o[0]), o - o[0]


def steps(batch: pa.RecordBatch, name: str = "text", most: int = STEP_BYTES
          ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``most`` bytes; a longer row is a run by itself."""
    buf, offs = raw_bytes(text_column(batch, name))
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, j, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every (start, length), one after the other."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
