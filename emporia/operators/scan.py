"""Running values per key without sorting a key in one task.

A key's order is cut into segments (a column that never falls along the
order). Each segment is scanned by itself; what all earlier segments
amount to is carried into it from one small row per (key, segment). A hot
key is so spread over its segments, and only their totals meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SEGMENT = "_seg"


def earlier(totals: DataFrame, keys: list[str], carried: dict[str, Column]) -> DataFrame:
    """keys, segment and, per name, an aggregate over the totals of all earlier segments of the key.

    ``totals``: one row per (key, segment); ``carried`` holds aggregate columns over them.
    """
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, SEGMENT, *[agg.over(before).alias(name) for name, agg in carried.items()])


def within(keys: list[str], *order: str) -> WindowSpec:
    """A segment's rows in order."""
    return Window.partitionBy(*keys, SEGMENT).orderBy(*order)


def running_max_before(df: DataFrame, keys: list[str], value: str, order: list[str], segment: Column, alias: str) -> DataFrame:
    """``alias``: the largest ``value`` among the key's rows before this one in ``order``; null for the first."""
    x = df.withColumn(SEGMENT, segment)
    carry = earlier(x.groupBy(*keys, SEGMENT).agg(F.max(value).alias("_most")), keys, {"_carry": F.max("_most")})
    here = F.max(value).over(within(keys, *order).rowsBetween(Window.unboundedPreceding, -1))
    return x.withColumn(alias, here).join(carry, [*keys, SEGMENT]).withColumn(
        alias, F.greatest(alias, "_carry")).drop(SEGMENT, "_carry")
