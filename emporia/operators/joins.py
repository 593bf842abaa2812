"""Join operators.

Equi-joins are left to the planner: with AQE on, a side whose measured
shuffle output is small becomes a broadcast hash join at run time, and
skewed partitions of a sort-merge join are split. Explicit broadcast
hints are used only for sides bounded by construction (config rows,
weight tables).

Interval joins (J3, J10-J14) add a time bucket to the equi key so that a
hot key is split by time: each left row is sent to the (at most two)
buckets its interval touches, the join is an equi-join on
``(key, bucket)`` and the exact bounds are a post-filter. No key ever
pairs all of its rows with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "left") -> DataFrame:
    """Dimension enrichment; a missing dimension leaves the row unchanged
    (its dimension columns null)."""
    return df.join(dim, on, how)


def enrich_sparse(df: DataFrame, dim: DataFrame, key: str, spread: str) -> DataFrame:
    """J7 for a string key that is null in many rows: null rows match nothing, so
    each gets a key of its own making (from the column ``spread``) instead of
    meeting in one task."""
    k = F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col(spread).cast("string")))
    d = dim.withColumnRenamed(key, "_lk")
    return df.withColumn("_key", k).join(d, F.col("_key") == F.col("_lk"), "left").drop("_key", "_lk")


SALTS = 64  # parts of the rows of one code


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, spread: str, how: str = "inner") -> DataFrame:
    """Look a code up in a dictionary. There are few codes and many rows of each: the rows of a code are
    dealt by the column ``spread`` to ``SALTS`` copies of the (small) dictionary, so no task gets all of them."""
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    d = dim.withColumnRenamed(dim_key, "_lk").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    x = df.withColumn("_salt", salt)
    return x.join(d, (F.col(key) == F.col("_lk")) & (F.col("_salt") == F.col("_part")), how).drop("_lk", "_salt", "_part")


def lookup_or_default(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, value: str,
                      alias: str, default: str = "N/A", spread: str | None = None) -> DataFrame:
    """Look a code up, ``default`` when the code is not in the dictionary (``spread``: see :func:`lookup`)."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(value).alias(alias))
    out = lookup(df, d, left_key, "_lk", spread, "left") if spread else df.join(d, F.col(left_key) == F.col("_lk"), "left").drop("_lk")
    return out.withColumn(alias, F.coalesce(F.col(alias), F.lit(default)))


def interval_join(left: DataFrame, right: DataFrame, key: str | list[str], left_ts: str, right_ts: str,
                  lower_ms: int, upper_ms: int) -> DataFrame:
    """Inner join on ``key`` where ``right_ts`` lies in
    ``[left_ts + lower_ms, left_ts + upper_ms]`` (both ends inclusive).

    ``left_ts``/``right_ts`` are epoch-ms columns; right-side column
    names must not clash with the left side except the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    width = max(int(upper_ms) - int(lower_ms), 1)
    lb = F.floor((F.col(left_ts) + F.lit(lower_ms)) / width)
    ub = F.floor((F.col(left_ts) + F.lit(upper_ms)) / width)
    lx = left.withColumn("_bucket", F.explode(F.array_distinct(F.array(lb, ub))))
    rx = right.withColumn("_bucket", F.floor(F.col(right_ts) / width))
    cond = [lx[k] == rx[k] for k in keys] + [lx["_bucket"] == rx["_bucket"],
                                            rx[right_ts] >= lx[left_ts] + F.lit(lower_ms),
                                            rx[right_ts] <= lx[left_ts] + F.lit(upper_ms)]
    out = lx.join(rx, cond, "inner")
    return out.select(*[lx[c] for c in left.columns],
                      *[rx[c] for c in right.columns if c not in keys])


def prefixed(df: DataFrame, prefix: str, keep: list[str] | None = None) -> DataFrame:
    """Rename every column (but ``keep``) with a prefix."""
    keep = keep or []
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])
