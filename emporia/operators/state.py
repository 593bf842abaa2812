"""Per-key stateful markers, batch (closed) forms.

The streaming jobs keep one value per key in state and update it record
by record. Over a bounded table each of those updates has a closed form.
Where the closed form only needs "the first/last record of a key" it is
written as an aggregation (partial, map-side combined, so a key holding a
third of all rows is spread over many tasks) joined back on the key; AQE
splits a hot key's partition of that join. Record order is ``(ts_ms, id)``
everywhere: arrival order in the stream equals event order there.

Streaming twins live in ``emporia.streaming.processors``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.scalars import ms_to_day, negate
from emporia.operators.scan import running_max_before

#: Arrival numbers per segment of a running comparison.
SEGMENT_ROWS = 1 << 16


def _order(ts: str, tie: str) -> Column:
    return F.struct(F.col(ts), F.col(tie))


# ------------------------------------------------------------------ F1

def first_visit_dates(log: DataFrame, key: str = "mid", ts: str = "ts_ms", tie: str = "event_id") -> DataFrame:
    """The date F1 keeps per device: set by its first record only.

    A first record flagged new stores its own day; one flagged old stores
    the day before. Computed as ``min_by`` over the key (partial aggregate).
    """
    d = ms_to_day(ts)
    state = F.when(F.col("is_new") == "1", d).otherwise(F.date_sub(d, 1))
    return log.groupBy(key).agg(F.min_by(state, _order(ts, tie)).alias("first_visit_date"))


def repair_is_new(log: DataFrame, key: str = "mid", ts: str = "ts_ms", tie: str = "event_id") -> DataFrame:
    """a record flagged new on a later day than the stored one becomes old.

    Records flagged old are never changed; a device's first flag-1 day
    keeps its flag-1 records.
    """
    first = first_visit_dates(log, key, ts, tie)
    fixed = F.when((F.col("is_new") == "1") & (F.col("first_visit_date") != ms_to_day(ts)), F.lit("0")) \
        .otherwise(F.col("is_new"))
    cols = [fixed.alias(c) if c == "is_new" else F.col(c) for c in log.columns]
    return log.join(first, key).select(*cols)


# ------------------------------------------------------------------ F2 / F3 / F4

def mark_daily_unique(df: DataFrame, keys: list[str] | str = "mid", ts: str = "ts_ms", tie: str = "event_id",
                      flag: str = "uv_ct") -> DataFrame:
    """``flag`` = 1 on the key's first record of each calendar day, else 0.

    The stream keeps the key's last visit date; a record counts when that
    date is empty or differs, which in event order is "first of the day".
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    day = ms_to_day(ts)
    firsts = (df.groupBy(*keys, day.alias("_day"))
              .agg(F.min(_order(ts, tie)).alias("_first")))
    out = df.withColumn("_day", day).join(firsts, keys + ["_day"], "left")
    return out.withColumn(flag, (_order(ts, tie) == F.col("_first")).cast("bigint")) \
        .drop("_day", "_first")


def first_of_day(df: DataFrame, keys: list[str] | str = "user_id", ts: str = "ts_ms",
                 tie: str = "event_id") -> DataFrame:
    """keep only each key's first record per calendar day."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    day = ms_to_day(ts)
    cols = [c for c in df.columns]
    firsts = df.groupBy(*keys, day.alias("_day")).agg(F.min_by(F.struct(*cols), _order(ts, tie)).alias("r"))
    return firsts.select("r.*")


def with_session_start(df: DataFrame, last_page: str = "last_page_id", flag: str = "sv_ct") -> DataFrame:
    """F2 (second half): a record with no last page opens a session."""
    lp = F.col(last_page)
    return df.withColumn(flag, F.when(lp.isNull() | (lp == ""), 1).otherwise(0).cast("bigint"))


# ------------------------------------------------------------------ F5

def dedup_retract(df: DataFrame, key: str, measures: list[str], order: list[str] | str = "ts_ms") -> DataFrame:
    """on a repeated key emit the previous version negated, then the new one.

    Every version is emitted as is; every version that a later one
    supersedes is emitted a second time with its measures negated (it
    keeps its own event time, so it cancels itself in its own window).
    Summing the output equals summing only the latest version per key.
    "Superseded" = not the key's latest ``order``: a partial aggregate
    (``max`` per key) joined back, so a key's versions never have to be
    sorted together in one task.
    """
    order = [order] if isinstance(order, str) else list(order)
    pos = F.struct(*[F.col(c) for c in order])
    last = df.groupBy(key).agg(F.max(pos).alias("_last"))
    signs = F.when(pos < F.col("_last"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    signed = df.join(last, key).withColumn("is_retraction", F.explode(signs))
    return signed.select(*[F.when(F.col("is_retraction"), negate(c)).otherwise(F.col(c)).alias(c) if c in measures
                           else F.col(c) for c in df.columns], "is_retraction")


# ------------------------------------------------------------------ F6

def mark_login(df: DataFrame, key: str = "user_id", ts: str = "ts_ms", tie: str = "event_id",
               return_days: int = 8) -> DataFrame:
    """per login, ``uu_ct`` = first login of the day, ``back_ct`` = a
    first login of the day at least ``return_days`` after the previous
    login day. The previous login day is a ``lag`` over the key's distinct
    login days (one row per user-day, so a hot user costs days, not rows).
    """
    day = ms_to_day(ts)
    days = df.groupBy(key, day.alias("_day")).agg(F.min(_order(ts, tie)).alias("_first"))
    w = Window.partitionBy(key).orderBy("_day")
    days = days.withColumn("_prev", F.lag("_day").over(w))
    out = df.withColumn("_day", day).join(days, [key, "_day"], "left")
    is_first = _order(ts, tie) == F.col("_first")
    back = is_first & F.col("_prev").isNotNull() & (F.datediff("_day", "_prev") >= return_days)
    return (out.withColumn("uu_ct", is_first.cast("bigint"))
            .withColumn("back_ct", back.cast("bigint"))
            .drop("_day", "_first", "_prev"))


# ------------------------------------------------------------------ F7

def keep_newer(df: DataFrame, key: str, ts: str, arrival: list[str] | str, segment: Column | None = None) -> DataFrame:
    """keep a record only when its ``ts`` is later than the stored one.

    The stored value is the largest time kept so far, so a record passes
    exactly when its time exceeds every record's that arrived before it;
    ``arrival`` orders the arrivals and is not the compared time. Records
    without key are dropped (P12). ``segment`` never falls along the
    arrivals (default: ``SEGMENT_ROWS`` numbers of the first arrival column,
    which must be a number): a key's records are compared segment by
    segment, with the largest time of all earlier segments carried in.
    """
    arrival = [arrival] if isinstance(arrival, str) else list(arrival)
    seg = F.floor(F.col(arrival[0]) / SEGMENT_ROWS) if segment is None else segment
    out = running_max_before(df.where(F.col(key).isNotNull()), [key], ts, arrival, seg, "_seen")
    return out.where(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen"))).select(*df.columns)


# ------------------------------------------------------------------ F8 / F9

def dedup_first(df: DataFrame, cols: list[str], order: list[str] | str) -> DataFrame:
    """The first record (smallest ``order``) of every distinct ``cols``; a partial aggregate."""
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in cols]
    first = df.groupBy(*cols).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*[F.col(c) if c in cols else F.col("_r")[c].alias(c) for c in df.columns])


def dedup_payload(df: DataFrame, key: str, payload: list[str], order: list[str] | str = "ts_ms") -> DataFrame:
    """F8: drop exact repeats of ``(key, payload)``; the first arrival is kept."""
    return dedup_first(df, [key, *payload], order)


def dedup_exact(df: DataFrame, cols: list[str], order: list[str] | str) -> DataFrame:
    """the Bloom-filter de-duplication on ``order_id_ts_ms``, made exact
    (no false drops): the first row per distinct key tuple."""
    return dedup_first(df, list(cols), order)
