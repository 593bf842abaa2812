"""K5: day folders of append-only files, rolled by size, time and idleness.

Writers append small files as batches come. ``roll`` packs a day's small
files into files of about ``target_bytes`` when

* there are enough of them for a whole file (size),
* the oldest has waited for ``roll_ms`` (time), or
* the day has had no new file for ``idle_ms``: the day is closed (idleness).

A roll is planned, written and then switched. The new files come into
the day's folder hidden (Spark does not read names that begin with a
dot), then a record of the switch is stored; from there the old files go
and the new ones become visible. A job that dies before the record has
changed nothing, one that dies after it is finished by the next call, so a
row is never lost or seen twice for good. Readers during the few renames of
a switch may miss the rows of that day; they do not see them twice.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 128 << 20


class _Folder:
    """File names, sizes and times below ``path``, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.new = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.new(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self.new("/".join([self.path, *parts]))

    def names(self, *parts: str) -> list:
        place = self.at(*parts)
        return list(self.fs.listStatus(place)) if self.fs.exists(place) else []

    def store(self, text: str, *parts: str) -> None:
        part = (*parts[:-1], f"{parts[-1]}.tmp")
        out = self.fs.create(self.at(*part), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.rename(self.at(*part), self.at(*parts))

    def load(self, *parts: str) -> str:
        size = self.fs.getFileStatus(self.at(*parts)).getLen()
        stream = self.fs.open(self.at(*parts))
        try:
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()


def _finish(folder: _Folder, day: str, record: str) -> None:
    """Do what is left of a switch: old files go, then the new ones appear, then the record goes."""
    plan = json.loads(folder.load(day, record))
    for name in plan["old"]:
        folder.fs.delete(folder.at(day, name), False)
    for name in plan["new"]:
        if folder.fs.exists(folder.at(day, f".{name}")):
            folder.fs.rename(folder.at(day, f".{name}"), folder.at(day, name))
    folder.fs.delete(folder.at(day, record), False)


def recover(spark: SparkSession, path: str) -> None:
    """Finish the switches that a died job began; drop the hidden files of one that had not come so far."""
    folder = _Folder(spark, path)
    for d in folder.names():
        day = d.getPath().getName()
        if not day.startswith("day="):
            continue
        names = [s.getPath().getName() for s in folder.names(day)]
        for record in (n for n in names if n.startswith("_switch-") and n.endswith(".json")):
            _finish(folder, day, record)
        for s in folder.names(day):
            if s.getPath().getName().startswith(".rolled-"):
                folder.fs.delete(s.getPath(), False)


def _due(files: list[tuple[str, int, int]], now_ms: int, target: int, roll_ms: int, idle_ms: int) -> list[tuple[str, int, int]]:
    """The small files (name, bytes, time) of a day that are to be packed now."""
    small = [f for f in files if f[1] < target * 3 // 4]
    if len(small) < 2:
        return []
    size = sum(f[1] for f in small)
    idle = max(f[2] for f in files) <= now_ms - idle_ms
    old = min(f[2] for f in small) <= now_ms - roll_ms
    return small if size >= target or idle or old else []


def roll(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, roll_ms: int = 15 * 60_000, idle_ms: int = 5 * 60_000,
         now_ms: int | None = None) -> dict[str, int]:
    """Pack the small files of all days that are due; returns the number of files packed per day.

    One Spark job for all days: a day's rows are dealt to as many tasks as
    it gets files. The driver sees file names only. One call at a time.
    """
    recover(spark, path)
    folder = _Folder(spark, path)
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    due: dict[str, list] = {}
    for d in folder.names():
        day = d.getPath().getName()
        if day.startswith("day="):
            files = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in folder.names(day)]
            files = [f for f in files if f[0].endswith(".parquet") and not f[0].startswith((".", "_"))]
            if chosen := _due(files, now_ms, target_bytes, roll_ms, idle_ms):
                due[day] = chosen
    if not due:
        return {}
    run = uuid.uuid4().hex
    staged = f"_rolling/{run}"
    files = [str(folder.at(day, f[0])) for day, chosen in due.items() for f in chosen]
    rows = spark.read.option("basePath", folder.path).option("mergeSchema", "true").parquet(*files)
    bins = spark.createDataFrame([(day[4:], max(1, round(sum(f[1] for f in chosen) / target_bytes))) for day, chosen in due.items()],
                                 "day string, _bins int")
    cols = [c for c in rows.columns if c != "day"]
    dealt = rows.withColumn("day", F.col("day").cast("string")).join(F.broadcast(bins), "day").withColumn(
        "_bin", F.pmod(F.xxhash64(*cols), F.col("_bins")))
    # One task, and so one file, per bin.
    dealt.select("day", "_bin", *cols).repartition("day", "_bin").write.partitionBy("day", "_bin").parquet(f"{folder.path}/{staged}")
    for day, chosen in due.items():
        new = []
        written = [f for b in folder.names(staged, day) for f in folder.names(staged, day, b.getPath().getName())]
        for n, s in enumerate(f for f in written if f.getPath().getName().endswith(".parquet")):
            name = f"rolled-{run}-{n:05d}.parquet"
            folder.fs.rename(s.getPath(), folder.at(day, f".{name}"))
            new.append(name)
        folder.store(json.dumps({"old": [f[0] for f in chosen], "new": new}), day, f"_switch-{run}.json")
        _finish(folder, day, f"_switch-{run}.json")
    folder.fs.delete(folder.at(staged), True)
    return {day[4:]: len(chosen) for day, chosen in due.items()}
