"""Keyed tables (K3, K6): immutable bucket files behind a versioned list.

A table is a set of hash buckets of its key. A merge writes new files for
the buckets that a batch touches and then, last, one small Parquet table
that lists every bucket with its folder: the *manifest* of the next
version. Readers take the newest finished manifest, so a job that dies
anywhere before that leaves the table as it was, and the retry starts
from the same version. A bucket whose rows all went (expired deletes) is
listed without a folder.

A bucket is named by the last ``depth`` bits of the key's hash. One that
would hold more than ``most_rows`` is split into deeper ones before it is
written, so a bucket is never more than one task's work however far the
table grows. One writer per table at a time; a second one that commits the
same version fails.

The driver handles one row per bucket; data never passes through it.
"""

from __future__ import annotations

import os
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emporia.operators.routing import latest_by_key

MOST_ROWS = 2_000_000


class Bucket(NamedTuple):
    depth: int
    prefix: int
    folder: str | None  # below the table's path; None: no rows
    n_rows: int


_MANIFEST = "depth int, prefix long, folder string, n_rows long, schema string"


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, place = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def _finished(spark: SparkSession, path: str) -> bool:
    fs, place = _fs(spark, os.path.join(path, "_SUCCESS"))
    return fs.exists(place)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions, oldest first."""
    root = os.path.join(path, "manifest")
    return sorted(int(v) for v in _folders(spark, root) if v.isdigit() and _finished(spark, os.path.join(root, v)))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[Bucket], StructType | None]:
    """(version, buckets, schema) of the newest or a given version; (-1, [], None) without a table."""
    done = versions(spark, path)
    if not done:
        return -1, [], None
    version = done[-1] if version is None else version
    rows = spark.read.schema(_MANIFEST).parquet(os.path.join(path, "manifest", str(version))).collect()
    return version, [Bucket(r.depth, r.prefix, r.folder, r.n_rows) for r in rows], StructType.fromJson(_json(rows[0].schema))


def _json(text: str):
    import json
    return json.loads(text)


def rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the newest version, deletes that are still kept included."""
    _, buckets, schema = manifest(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    return _read(spark, path, buckets, schema)


def _read(spark: SparkSession, path: str, buckets: list[Bucket], schema: StructType) -> DataFrame:
    folders = [os.path.join(path, b.folder) for b in buckets if b.folder]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _placed(df: DataFrame, keys: list[str], buckets: list[Bucket]) -> DataFrame:
    """``df`` with ``_b``: the place in ``buckets`` of the one that a row belongs to."""
    deep = max(b.depth for b in buckets)
    slots = [(b.prefix + (k << b.depth), n) for n, b in enumerate(buckets) for k in range(1 << (deep - b.depth))]
    slot = F.xxhash64(*keys).bitwiseAND(F.lit((1 << deep) - 1))
    return df.withColumn("_slot", slot).join(df.sparkSession.createDataFrame(slots, "_slot long, _b int"), "_slot").drop("_slot")


def _split(b: Bucket, levels: int) -> list[Bucket]:
    return [Bucket(b.depth + levels, b.prefix + (k << b.depth), None, 0) for k in range(1 << levels)]


def _levels(n_rows: int, most_rows: int) -> int:
    """Splits after which a bucket of ``n_rows`` holds four fifths of ``most_rows`` or less on average."""
    levels = 0
    while n_rows > (most_rows * 4 // 5) << levels:
        levels += 1
    return levels


def _write(df: DataFrame, keys: list[str], path: str, version: int, buckets: list[Bucket], most_rows: int) -> list[Bucket]:
    """Write ``df``, which belongs to ``buckets``, one folder per bucket; splits again what turns out too large."""
    spark = df.sparkSession
    folder = os.path.join("data", f"{version:09d}-{uuid.uuid4().hex}")
    target = os.path.join(path, folder)
    _placed(df, keys, buckets).repartition("_b").write.partitionBy("_b").parquet(target)
    if not any(x.startswith("_b=") for x in _folders(spark, target)):
        return [b._replace(folder=None, n_rows=0) for b in buckets]
    count = {r["_b"]: r["n"] for r in spark.read.parquet(target).groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()}
    out, large = [], []
    for n, b in enumerate(buckets):
        b = b._replace(folder=os.path.join(folder, f"_b={n}") if n in count else None, n_rows=count.get(n, 0))
        (large if b.n_rows > most_rows and b.depth < 60 else out).append(b)
    if large:
        again = [c for b in large for c in _split(b, max(1, _levels(b.n_rows, most_rows)))]
        out += _write(_read(spark, path, large, df.schema), keys, path, version, again, most_rows)
    return out


def _commit(spark: SparkSession, path: str, version: int, buckets: list[Bucket], schema: StructType) -> None:
    target = os.path.join(path, "manifest", str(version))
    text = schema.json()
    listed = spark.createDataFrame([(*b, text) for b in buckets], _MANIFEST).coalesce(1)
    # What a died writer left is no version; a finished one is another writer's and an error.
    listed.write.mode("errorifexists" if _finished(spark, target) else "overwrite").parquet(target)


def merge(changes: DataFrame, keys: list[str], path: str, order: str, retention_ms: int, start_buckets: int = 16,
          most_rows: int = MOST_ROWS, keep_versions: int = 2) -> None:
    """Merge ``changes`` into the table: the latest row per key by ``order`` stays.

    A delete (``op`` = ``d``) stays as a tombstone until ``order`` has moved
    on by ``retention_ms``, so that a late, older change loses against it;
    then it goes. Merging a batch twice gives the same table. Columns that
    only one side has are null on the other.
    """
    spark = changes.sparkSession
    version, buckets, schema = manifest(spark, path)
    if not buckets:
        depth = max(0, (start_buckets - 1).bit_length())
        buckets = [Bucket(depth, k, None, 0) for k in range(1 << depth)]
    found = (_placed(changes.withColumn("_h", F.xxhash64(*keys)), keys, buckets).groupBy("_b")
             .agg(F.max(order).alias("latest"), F.approx_count_distinct("_h").alias("n")).collect())
    if not found:
        return
    old = [buckets[r["_b"]] for r in found]
    new = changes if schema is None else _read(spark, path, old, schema).unionByName(changes, allowMissingColumns=True)
    latest = latest_by_key(new, keys, order).select(*new.columns)
    if "op" in latest.columns:
        horizon = max(r["latest"] for r in found) - retention_ms
        latest = latest.where((F.col("op") != "d") | (F.col(order) >= horizon))
    # Old rows and new keys together are no fewer than the merged rows.
    aims = [c for r, b in zip(found, old) for c in _split(b, _levels(b.n_rows + r["n"], most_rows))]
    written = _write(latest, keys, path, version + 1, aims, most_rows)
    touched = {(b.depth, b.prefix) for b in old}
    _commit(spark, path, version + 1, [b for b in buckets if (b.depth, b.prefix) not in touched] + written, latest.schema)
    clean(spark, path, keep_versions)


def clean(spark: SparkSession, path: str, keep_versions: int = 2) -> None:
    """Delete versions before the last ``keep_versions`` and the bucket files that only they, or died writers, hold."""
    done = versions(spark, path)
    kept = done[-keep_versions:]
    if not kept or len(done) == len(kept):
        return
    used = {b.folder for v in kept for b in manifest(spark, path, v)[1]}
    fs, _ = _fs(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for write in _folders(spark, os.path.join(path, "data")):
        if int(write.split("-")[0]) > kept[-1]:
            continue  # of a version that is being written
        parts = _folders(spark, os.path.join(path, "data", write))
        gone = [p for p in parts if p.startswith("_b=") and os.path.join("data", write, p) not in used]
        if len(gone) == sum(p.startswith("_b=") for p in parts):
            fs.delete(hadoop(os.path.join(path, "data", write)), True)
        else:
            for p in gone:
                fs.delete(hadoop(os.path.join(path, "data", write, p)), True)
    for v in done[:-keep_versions]:
        fs.delete(hadoop(os.path.join(path, "manifest", str(v))), True)
