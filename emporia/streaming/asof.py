"""Versioned look-ups on streams (J6, J16): records and versions merged by event time.

Versions (dimension changes, routing-config changes) are a second stream.
Both are tagged and merged before the watermark, so one clock holds for
both: a record waits until the watermark has passed its time, then takes
the latest version at or before it. A change therefore applies from its
own time on, not from the next micro-batch, and a replay cut into other
micro-batches gives the same rows. Rows later than ``delay`` are dropped,
as everywhere (W6).

A key with a large share of all records (one table's route) can be dealt
to ``salts`` state keys; its versions are then kept in each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from emporia.functions.packing import packed, unpacked

_OUT = "record string, version string"


class AsOf(StatefulProcessor):
    """One key's versions and waiting records. Input: ``is_version``, ``t`` (ms), ``row`` (JSON), ``gone``."""

    def __init__(self, keep_unmatched: bool):
        self.keep_unmatched = keep_unmatched

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getMapState("versions", "t long", "row string")
        self.waiting = handle.getMapState("waiting", "t long, row string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for pdf in rows:
            for version, t, row, gone in zip(pdf["is_version"].tolist(), pdf["t"].tolist(), pdf["row"].tolist(), pdf["gone"].tolist()):
                t = int(t)
                if version:
                    text = "" if gone else row  # of one time the greatest row counts, as in the batch form
                    held = self.versions.getValue((t,))[0] if self.versions.containsKey((t,)) else None
                    if held is None or (gone, row) > (held == "", held):
                        self.versions.updateValue((t,), (text,))
                else:
                    n = self.waiting.getValue((t, row))[0] if self.waiting.containsKey((t, row)) else 0
                    self.waiting.updateValue((t, row), (n + 1,))
                    earliest = t if earliest is None else min(earliest, t)
        if earliest is not None:
            set_ = list(self.handle.listTimers())
            if not set_ or earliest < min(set_):
                for x in set_:
                    self.handle.deleteTimer(x)
                self.handle.registerTimer(earliest)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        versions = sorted((t[0], row[0]) for t, row in self.versions.iterator())
        due = sorted(((t, row), n[0]) for (t, row), n in self.waiting.iterator() if t <= now)
        out, at = [], -1
        for (t, row), n in due:
            while at + 1 < len(versions) and versions[at + 1][0] <= t:
                at += 1
            version = versions[at][1] or None if at >= 0 else None
            if version is not None or self.keep_unmatched:
                out += [(row, version)] * n
            self.waiting.removeKey((t, row))
        for t, _ in [v for v in versions if v[0] <= now][:-1]:
            self.versions.removeKey((t,))
        left = [t for (t, _), _ in self.waiting.iterator()]
        if left:
            self.handle.registerTimer(min(left))
        if out:
            yield pd.DataFrame(out, columns=["record", "version"])

    def close(self) -> None:
        pass


def as_of_stream(records: DataFrame, versions: DataFrame, keys: list[str], time: str = "ts_ms", version_time: str = "ts_ms",
                 how: str = "inner", deleted: str | None = None, delay: str = "10 seconds", salts: int = 1) -> DataFrame:
    """``operators.versions.as_of_join`` on two streams (neither with a watermark yet)."""
    rest = [f for f in versions.schema if f.name not in (*keys, version_time, deleted)]
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    salt = F.pmod(F.xxhash64(*records.columns), F.lit(salts))
    a = records.select(*keys, salt.cast("int").alias("_salt"), F.lit(False).alias("is_version"), F.col(time).alias("t"),
                       packed(records.columns).alias("row"), F.lit(False).alias("gone"))
    v = versions.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"), F.lit(True).alias("is_version"),
                        F.col(version_time).alias("t"), packed([f.name for f in rest]).alias("row"), gone.alias("gone"))
    both = a.unionByName(v).withColumn("et", F.timestamp_millis("t")).withWatermark("et", delay)
    found = both.groupBy(*keys, "_salt").transformWithStateInPandas(AsOf(how == "left"), _OUT, "append", "EventTime")
    return found.select(*unpacked("record", list(records.schema)), *unpacked("version", rest))
