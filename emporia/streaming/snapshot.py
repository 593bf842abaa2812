"""A table's snapshot and its change log, joined without a gap.

The table keeps changing while its snapshot is read, so the snapshot is
read in chunks of its key, each between two positions of the log:

1. ``low``: the log's end; 2. the chunk's rows; 3. ``high``: the log's end again;
4. chunk rows whose key has a log row in (low, high] are dropped: the log
   tells what they became, the chunk may hold them as they were before or after;
5. the log rows up to ``high`` and the rest of the chunk go to the sink as one
   batch. Then the next chunk; after the last one the log alone goes on from there.

Every log row is sent once and in order, every row of the table that the
log does not touch comes from its chunk, and nothing is locked. What is
done is stored per chunk, so a restart goes on with the chunk that was
begun; its batch number is the same again, so sinks by batch id overwrite it
and keyed sinks merge it a second time without a change.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emporia.sources.sinks import written
from emporia.streaming.jobs import start

Write = Callable[[DataFrame, int], None]


def chunk_batch(chunk: DataFrame, log: DataFrame, keys: list[str], low: int, pos: str = "pos", op: str = "op") -> DataFrame:
    """One chunk's batch: ``log`` (rows up to the high position) and the ``chunk`` rows whose key it does not hold
    after ``low``; those come as snapshot reads (``r``) at position ``low``."""
    changed = log.where(F.col(pos) > low).select(*keys).distinct()
    still = chunk.join(changed, keys, "left_anti").withColumn(pos, F.lit(low).cast("bigint")).withColumn(op, F.lit("r"))
    return log.unionByName(still, allowMissingColumns=True)


def snapshot_with_log(spark: SparkSession, chunks: list, read_chunk: Callable[[object], DataFrame],
                      position: Callable[[], int], read_log: Callable[[int, int], DataFrame], keys: list[str],
                      write: Write, checkpoint: str, pos: str = "pos", op: str = "op") -> int:
    """Send all chunks and the log meanwhile to ``write(batch, number)``; returns the position up to which the log is done.

    ``read_log(low, high)``: log rows with low < ``pos`` <= high. A chunk is
    stored under ``checkpoint`` before ``high`` is taken.
    """
    done, at = 0, None
    for n, chunk in enumerate(chunks):
        state = os.path.join(checkpoint, "chunks", str(n))
        if written(spark, state):
            at, done = spark.read.parquet(state).first()["high"], n + 1
    if at is None:
        begin = os.path.join(checkpoint, "begin")
        if not written(spark, begin):  # changes before the first chunk's low position are in the chunks
            spark.createDataFrame([(position(),)], "high long").coalesce(1).write.mode("overwrite").parquet(begin)
        at = spark.read.parquet(begin).first()["high"]
    for n in range(done, len(chunks)):
        low = position()
        kept = os.path.join(checkpoint, "rows", str(n))
        read_chunk(chunks[n]).write.mode("overwrite").parquet(kept)
        high = position()
        write(chunk_batch(spark.read.parquet(kept), read_log(at, high), keys, low, pos, op), n)
        spark.createDataFrame([(high,)], "high long").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(checkpoint, "chunks", str(n)))
        at = high
    return at


def snapshot_then_stream(spark: SparkSession, chunks: list, read_chunk, position, read_log, log_stream: DataFrame,
                         keys: list[str], write: Write, checkpoint: str, trigger: dict | None = None, pos: str = "pos",
                         op: str = "op") -> StreamingQuery:
    """:func:`snapshot_with_log`, then the stream of the log from where it ended, into the same sink."""
    at = snapshot_with_log(spark, chunks, read_chunk, position, read_log, keys, write, checkpoint, pos, op)
    rest = log_stream.where(F.col(pos) > at)
    return start(rest, os.path.join(checkpoint, "log"), sink=lambda df, i: write(df, len(chunks) + i), trigger=trigger)
