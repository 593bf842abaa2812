"""Tumbling event-time window aggregates.

Each aggregate is ``groupBy(window(et, size), keys).agg(...)``: Spark
plans a partial (map-side) aggregate, one exchange on the grouping keys
and a final aggregate; the window is stamped afterwards. The same functions run on streaming DataFrames once a
watermark is set (``with_event_time``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.scalars import DATE, DATETIME, ms_to_day, ms_to_ts
from emporia.operators.scan import SEGMENT, earlier, within

WINDOW_COLS = ["stt", "edt", "cur_date"]


def stamp_window(df: DataFrame, window_col: str = "window") -> DataFrame:
    """A10: ``stt``/``edt`` ('yyyy-MM-dd HH:mm:ss') and ``cur_date`` from the window."""
    w = F.col(window_col)
    return (df.withColumn("stt", F.date_format(w.start, DATETIME))
              .withColumn("edt", F.date_format(w.end, DATETIME))
              .withColumn("cur_date", F.date_format(w.start, DATE))
              .drop(window_col))


def tumbling(ts: Column | str, size: str) -> Column:
    """Tumbling window column over an event-time TIMESTAMP."""
    return F.window(ts, size)


# ------------------------------------------------------------------ A1

TRAFFIC_DIMS = ["vc", "ch", "ar", "is_new"]


def traffic_window(log: DataFrame, size: str = "10 seconds", key: str = "mid",
                   ts: str = "ts_ms", tie: str = "event_id") -> DataFrame:
    """A1: page views by version, channel, area and new/old flag per window.

    ``log`` holds every log record (start records included, flagged by
    ``has_start``): F1's stored date is set by a device's first record of
    any kind, while only page records (P8: no ``start``) are counted.

    Plan, built for a device that may hold a third of all records: no
    record and no cell of a device is ever sorted or gathered; every step
    is an aggregate that is combined before its shuffle, or a join whose
    hot partitions Spark can split.
    1. per (device, day): the first record with its flag, and the first
       page record (one row per device and day);
    2. per device: F1's date from the first of those rows;
    3. page records as cells ``(device, day, window, dims)``, joined to
       their day; F2 is the cell that holds the day's first page record;
    4. the final aggregate over ``(window, dims)`` with repaired ``is_new``.
    """
    # Arrival order as one fixed-width number, so the aggregates are hash aggregates.
    order = (F.col(ts).cast("decimal(19,0)") * F.lit(Decimal(10**19))
             + F.col(tie).cast("decimal(19,0)")).cast("decimal(38,0)")
    start = F.coalesce(F.col("has_start"), F.lit(False))
    lp = F.col("last_page_id")
    rows = log.select(F.col(key).alias("_key"), ms_to_day(ts).alias("_day"), ts, *TRAFFIC_DIMS, start.alias("_start"),
                      order.alias("_order"), "during_time", (lp.isNull() | (lp == "")).alias("_opens"))
    state = F.when(F.col("is_new") == "1", F.col("_day")).otherwise(F.date_sub("_day", 1))
    days = rows.groupBy("_key", "_day").agg(F.min("_order").alias("_first"), F.min_by(state, "_order").alias("_state"),
                                            F.min(F.when(~F.col("_start"), F.col("_order"))).alias("_first_page"))
    visit = days.groupBy("_key").agg(F.min_by("_state", "_first").alias("_visit_date"))
    days = days.select("_key", "_day", "_first_page").join(visit, "_key")
    cells = (rows.where(~F.col("_start"))
             .groupBy("_key", "_day", F.window(ms_to_ts(ts), size).alias("window"), *TRAFFIC_DIMS)
             .agg(F.count(F.lit(1)).alias("pv_ct"), F.sum(F.col("_opens").cast("bigint")).alias("sv_ct"),
                  F.sum("during_time").cast("bigint").alias("dur_sum"), F.min("_order").alias("_order")))
    pages = (cells.join(days, ["_key", "_day"])
             .withColumn("uv_ct", (F.col("_order") == F.col("_first_page")).cast("bigint"))
             .withColumn("is_new", F.when((F.col("is_new") == "1") & (F.col("_visit_date") != F.col("_day")),
                                          F.lit("0")).otherwise(F.col("is_new"))))
    out = (pages.groupBy("window", *TRAFFIC_DIMS)
           .agg(F.sum("uv_ct").alias("uv_ct"), F.sum("sv_ct").alias("sv_ct"),
                F.sum("pv_ct").alias("pv_ct"), F.sum("dur_sum").alias("dur_sum")))
    return stamp_window(out).select(*WINDOW_COLS, *TRAFFIC_DIMS, "uv_ct", "sv_ct", "pv_ct", "dur_sum")


# ------------------------------------------------------------------ A9

def last_in_window(df: DataFrame, key: str, ts: str, size: str, cols: list[str], tie: str | None = None) -> DataFrame:
    """The last record per key in each tumbling window (``max_by``, a
    partial aggregate: a hot key is reduced map-side)."""
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    agg = df.groupBy(key, F.window(ms_to_ts(ts), size).alias("window")).agg(
        F.max_by(F.struct(*cols), order).alias("_last"))
    return stamp_window(agg.select(key, "window", *[F.col("_last")[c].alias(c) for c in cols]))


def running_state_per_window(df: DataFrame, key: str, ts: str, size: str, fields: list[str]) -> DataFrame:
    """A8 + A9: for each key and each tumbling window holding its records, the
    running state after the window's last record: ``pv`` = distinct payloads
    ``(fields)`` seen so far and, per field, the sorted distinct values seen so
    far joined by commas (nulls are not added).

    Closed form without pairing a key's records: the records are reduced to
    one row per (key, window) with what is new in it, and the windows are
    added up day by day, the sets of all earlier days carried in. The
    result holds every value set in full, so its size is windows x values
    of a key: that is a limit of the definition, not of the plan.
    """
    x = df.select(key, F.window(ms_to_ts(ts), size).start.alias("_w"), *fields)
    payloads = (x.groupBy(key, *fields).agg(F.min("_w").alias("_t")).groupBy(key, "_t").agg(F.count(F.lit(1)).alias("_n"))
                .select(key, "_t", "_n", F.lit(None).cast("string").alias("_f"), F.lit(None).cast("string").alias("_v")))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in fields]))
    values = (x.select(key, "_w", each.alias("_e")).where(F.col("_e.v").isNotNull())
              .groupBy(key, F.col("_e.f").alias("_f"), F.col("_e.v").alias("_v")).agg(F.min("_w").alias("_t"))
              .select(key, "_t", F.lit(0).cast("bigint").alias("_n"), "_f", "_v"))
    wins = x.select(key, F.col("_w").alias("_t"), F.lit(0).cast("bigint").alias("_n"), F.lit(None).cast("string").alias("_f"),
                    F.lit(None).cast("string").alias("_v")).distinct()
    new = (payloads.unionByName(values).unionByName(wins).groupBy(key, "_t")
           .agg(F.sum("_n").alias("_n"), *[F.collect_set(F.when(F.col("_f") == f, F.col("_v"))).alias(f) for f in fields])
           .withColumn(SEGMENT, F.to_date("_t")))
    sums = [("_n", F.sum("_n")), *((f, F.flatten(F.collect_list(f))) for f in fields)]  # a value is new only once
    totals = new.groupBy(key, SEGMENT).agg(*[agg.alias(c) for c, agg in sums])
    carry = earlier(totals, [key], {f"_c{i}": F.sum(c) if i == 0 else F.collect_list(c) for i, (c, _) in enumerate(sums)})
    day = within([key], "_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = new.select(key, "_t", SEGMENT, *[(F.sum(c) if i == 0 else F.collect_list(c)).over(day).alias(f"_d{i}")
                                           for i, (c, _) in enumerate(sums)])
    both = here.join(carry, [key, SEGMENT])
    state = both.select(key, "_t", (F.col("_d0") + F.coalesce("_c0", F.lit(0))).alias("pv"), *[
        F.array_join(F.array_sort(F.flatten(F.concat(f"_c{i}", f"_d{i}"))), ",").alias(f) for i, f in enumerate(fields, 1)])
    out = state.select(
        key, F.date_format("_t", DATETIME).alias("stt"),
        F.date_format(F.col("_t") + F.expr(f"interval {size}"), DATETIME).alias("edt"),
        F.date_format("_t", DATE).alias("cur_date"), F.col("pv").cast("bigint").alias("pv"), *fields)
    return out
