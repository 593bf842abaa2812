"""Look-ups into versioned tables (J6, P7/J16): what held at a record's own time.

A dimension or routing table changes while records flow. Reading it "as it
is now" gives another answer on every retry; here each record is joined
with the version that was valid at its event time, so a replay, a late run
and the streaming form (:mod:`emporia.streaming.asof`) all agree.

The time axis is cut into segments. A version is listed in its own
segment, and the one that is open at a segment's start is carried into
the segments that records fall into: a small scan over (key, segment)
rows, not over records. Records then meet their segment's versions in an
equi-join on (key, segment), so a key with many records or a long history
is spread over its segments and no key is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.packing import packed

DAY_MS = 86_400_000


def as_of_join(records: DataFrame, versions: DataFrame, keys: list[str], time: str = "ts_ms", version_time: str = "ts_ms",
               how: str = "inner", segment_ms: int = DAY_MS, deleted: str | None = None) -> DataFrame:
    """``records`` with the other columns of the latest version per key at or before their time.

    Of versions of one key and time a deleted one counts, else the one with the greatest JSON text. ``deleted``
    names a boolean column of ``versions`` (not returned): such a version
    ends the key until the next one. ``how``: inner, or left (no version:
    nulls).
    """
    rest = [c for c in versions.columns if c not in (*keys, version_time, deleted)]
    gone = F.col(deleted) if deleted else F.lit(False)
    v = versions.select(*keys, F.col(version_time).alias("_t"), F.struct(F.coalesce(gone, F.lit(False)).alias("_gone"), *rest).alias("_v"),
                        packed(rest).alias("_text"))
    v = v.groupBy(*keys, "_t").agg(F.max_by("_v", F.struct("_v._gone", "_text")).alias("_v")).withColumn("_s", F.floor(F.col("_t") / segment_ms))
    r = records.withColumn("_s", F.floor(F.col(time) / segment_ms))
    # What is open at the start of every segment that holds records.
    last = v.groupBy(*keys, "_s").agg(F.max_by("_v", "_t").alias("_last"), F.lit(False).alias("_asked"))
    asked = r.select(*keys, "_s").distinct().select(*keys, "_s", F.lit(None).cast(last.schema["_last"].dataType).alias("_last"),
                                                   F.lit(True).alias("_asked"))
    slots = last.unionByName(asked).groupBy(*keys, "_s").agg(
        F.max_by("_last", F.col("_last").isNotNull()).alias("_last"), F.max("_asked").alias("_asked"))
    before = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    opening = (slots.withColumn("_v", F.last("_last", ignorenulls=True).over(before)).where("_asked and _v is not null")
               .select(*keys, "_s", F.lit(None).cast("bigint").alias("_t"), "_v"))
    within = Window.partitionBy(*keys, "_s").orderBy(F.asc_nulls_first("_t"))
    spans = v.select(*keys, "_s", F.col("_t").cast("bigint").alias("_t"), "_v").unionByName(opening).withColumn(
        "_until", F.lead("_t").over(within)).where("not _v._gone")
    cond = [r[k] == spans[k] for k in (*keys, "_s")] + [spans["_t"].isNull() | (r[time] >= spans["_t"]),
                                                       spans["_until"].isNull() | (r[time] < spans["_until"])]
    out = r.join(spans, cond, how)
    return out.select(*[r[c] for c in records.columns], *[spans["_v"][c].alias(c) for c in rest])
