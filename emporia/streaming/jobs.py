"""Structured Streaming forms of the jobs (W1-W7 and the streaming twins).

A streaming job is the batch operator chain on a ``readStream``
DataFrame, with three differences: per-key record state lives in a
stateful processor (``emporia.streaming.processors``), event time carries
a watermark, and results leave through a checkpointed sink.

Late data (W6): rows behind the watermark are dropped by Spark, as the
source jobs drop them with zero allowed lateness; there is no side output.
Spark advances the watermark per micro-batch, so the last open window is
emitted only once a later record arrives (Q25).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emporia.operators import windows
from emporia.streaming import processors as P


# ------------------------------------------------------------------ W1-W3

def with_event_time(df: DataFrame, ms_col: str = "ts_ms", delay: str = "0 seconds", name: str = "et",
                    seconds_col: str | None = None) -> DataFrame:
    """W1 (``delay`` 0: monotonous), W2/W3 (bounded out-of-orderness).

    ``seconds_col``: a second-resolution field preferred when present
    (promoted to ms), as in the watermark helper that picks between two
    time fields.
    """
    ms = F.col(ms_col)
    if seconds_col:
        ms = F.coalesce(F.col(seconds_col) * 1000, ms)
    return df.withColumn(name, F.timestamp_millis(ms)).withWatermark(name, delay)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(df: DataFrame, checkpoint: str, sink: str = "parquet", path: str | None = None,
          mode: str = "append", trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start a checkpointed query (exactly-once for file sinks and
    idempotent ``foreachBatch`` writers); ``trigger`` e.g.
    ``{"processingTime": "5 seconds"}`` or ``{"availableNow": True}``."""
    conf = df.sparkSession.conf
    if "RocksDB" not in (conf.get(_PROVIDER, None) or ""):
        conf.set(_PROVIDER, _ROCKSDB)  # stateful processors need it; state lives on local disk + checkpoint
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if sink == "memory":
        w = w.format("memory")
    elif callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink).option("path", path)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


# ------------------------------------------------------------------ A1

def traffic_stream(log: DataFrame, size: str = "10 seconds", expire_ms: int | None = 86_400_000) -> DataFrame:
    """A1 on a stream: F1 + F2 in one processor keyed by device, then the
    event-time window aggregate. ``log``: flat page-log stream with ``et``
    watermarked (``with_event_time``)."""
    cols = ["mid", "event_id", "ts_ms", "et", "is_new", "has_start", "last_page_id", "vc", "ch", "ar",
            "during_time"]
    marked = (log.select(*cols).groupBy("mid")
              .transformWithStateInPandas(P.TrafficMarker(expire_ms), P.TrafficMarker.OUTPUT, "append", "EventTime",
                                          eventTimeColumnName="et"))
    agg = (marked.groupBy(F.window("et", size).alias("window"), *windows.TRAFFIC_DIMS)
           .agg(F.sum("uv_ct").alias("uv_ct"), F.sum("sv_ct").alias("sv_ct"),
                F.count(F.lit(1)).alias("pv_ct"), F.sum("during_time").alias("dur_sum")))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, *windows.TRAFFIC_DIMS, "uv_ct", "sv_ct",
                                            "pv_ct", "dur_sum")


# ------------------------------------------------------------------ A2

DETAIL_STATE = "id string, order_id string, province_id string, ts_ms long, seq long, amount decimal(16,2)"


def province_order_stream(details: DataFrame, provinces: DataFrame, size: str = "10 seconds",
                          expire_ms: int | None = 10_000) -> DataFrame:
    """A2 on a stream: F5 per order-detail id (the Retractor keeps the last
    version), 10 s windows by province with the amount and the number of
    distinct orders (size of the order-id set: count-distinct is not allowed
    on streams), then the province name from a static dimension
    (stream-static left join). A retraction carries its old time and is
    dropped like any late row once its window has closed (Q6), so a stored
    version may be forgotten ``expire_ms`` after its time without changing
    a result.

    ``details``: ``id, order_id, province_id, ts_ms, seq, amount`` with a
    watermark on ``et``.
    """
    cols = ["id", "order_id", "province_id", "ts_ms", "seq", "amount"]
    retracted = (details.select(*cols, "et").groupBy("id")
                 .transformWithStateInPandas(P.Retractor(cols, ["amount"], state_schema=DETAIL_STATE, event_time="et",
                                                         expire_ms=expire_ms),
                                             DETAIL_STATE + ", is_retraction boolean, et timestamp", "append",
                                             "EventTime", eventTimeColumnName="et"))
    agg = (retracted.groupBy(F.window("et", size).alias("window"), "province_id")
           .agg(F.sum("amount").alias("amt"), F.size(F.collect_set("order_id")).cast("bigint").alias("order_count")))
    out = windows.stamp_window(agg).join(provinces.select("province_id", "province_name"), "province_id", "left")
    return out.select(*windows.WINDOW_COLS, "province_id", "province_name",
                      F.col("amt").cast("double").alias("order_amount"), "order_count")


SKU_STATE = ("id string, sku_id string, ts_ms long, seq long, split_original_amount decimal(20,2), "
             "split_activity_amount decimal(18,4), split_coupon_amount decimal(18,4), "
             "split_total_amount decimal(16,2)")
SKU_MEASURES = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def sku_order_stream(details: DataFrame, enrich, size: str = "5 seconds",
                     expire_ms: int | None = 10_000) -> DataFrame:
    """A3 on a stream: F5 per order-detail id over the four amounts, 5 s
    windows by sku, then ``enrich`` (the J8 chain as stream-static left
    joins, e.g. ``lambda df: enrich_sku_chain(df, spark, sf)``)."""
    cols = ["id", "sku_id", "ts_ms", "seq"] + SKU_MEASURES
    retracted = (details.select(*cols, "et").groupBy("id")
                 .transformWithStateInPandas(P.Retractor(cols, SKU_MEASURES, state_schema=SKU_STATE, event_time="et",
                                                         expire_ms=expire_ms),
                                             SKU_STATE + ", is_retraction boolean, et timestamp", "append",
                                             "EventTime", eventTimeColumnName="et"))
    agg = (retracted.groupBy(F.window("et", size).alias("window"), "sku_id")
           .agg(*[F.sum(c).alias(c) for c in SKU_MEASURES]))
    return enrich(windows.stamp_window(agg))


# ------------------------------------------------------------------ A4 / A6

def cart_uu_stream(cart: DataFrame, size: str = "10 seconds", expire_ms: int | None = 86_400_000) -> DataFrame:
    """A4 on a stream: F3 (first cart add of the day per user), global window count."""
    cols = ["user_id", "event_id", "ts_ms", "et"]
    firsts = (cart.select(*cols).groupBy("user_id")
              .transformWithStateInPandas(P.FirstOfDay(cols, expire_ms=expire_ms),
                                          "user_id string, event_id long, ts_ms long, et timestamp",
                                          "append", "EventTime", eventTimeColumnName="et"))
    agg = firsts.groupBy(F.window("et", size).alias("window")).agg(F.count(F.lit(1)).alias("cart_add_uu_ct"))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, "cart_add_uu_ct")


def login_stream(logins: DataFrame, size: str = "10 seconds", expire_ms: int | None = 90 * 86_400_000) -> DataFrame:
    """A6 on a stream: F6 per user, global window sums. A user's last login day is
    forgotten ``expire_ms`` after it (a user who stays away longer counts as new)."""
    marked = (logins.select("uid", "event_id", "ts_ms", "et").groupBy("uid")
              .transformWithStateInPandas(P.LoginMarker(expire_ms=expire_ms), "uid string, event_id long, ts_ms long, et timestamp, "
                                          "uu_ct long, back_ct long", "append", "EventTime",
                                          eventTimeColumnName="et"))
    agg = marked.groupBy(F.window("et", size).alias("window")).agg(F.sum("back_ct").alias("back_ct"),
                                                                   F.sum("uu_ct").alias("uu_ct"))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, "back_ct", "uu_ct")


# ------------------------------------------------------------------ A5 / A7

def home_detail_stream(pages: DataFrame, size: str = "10 seconds", expire_ms: int | None = 86_400_000) -> DataFrame:
    """A5 on a stream: F4 (first home and first detail page of the day per device),
    global window counts. ``pages``: page records (no start records) with ``et``."""
    from emporia.operators.routing import home_or_detail
    cols = ["mid", "page_id", "event_id", "ts_ms", "et"]
    firsts = (pages.where(home_or_detail()).select(*cols).groupBy("mid", "page_id")
              .transformWithStateInPandas(P.FirstOfDay(cols, expire_ms=expire_ms),
                                          "mid string, page_id string, event_id long, ts_ms long, et timestamp",
                                          "append", "EventTime", eventTimeColumnName="et"))
    agg = firsts.groupBy(F.window("et", size).alias("window")).agg(
        F.sum(F.when(F.col("page_id") == "home", 1).otherwise(0)).cast("bigint").alias("home_uv_ct"),
        F.sum(F.when(F.col("page_id") == "good_detail", 1).otherwise(0)).cast("bigint").alias("good_detail_uv_ct"))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, "home_uv_ct", "good_detail_uv_ct")


def keyword_stream(pages: DataFrame, size: str = "1 second") -> DataFrame:
    """A7 on a stream: search keywords (P11 + T1) counted per window; no state but the open windows."""
    from emporia.operators.routing import is_search
    from emporia.operators.text import explode_tokens
    kw = explode_tokens(pages.where(is_search()).select("et", "item"), "item", "keyword")
    agg = kw.groupBy(F.window("et", size).alias("window"), "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, "keyword", "keyword_count")


# ------------------------------------------------------------------ T4

def comment_order_stream(comments: DataFrame, orders: DataFrame, bound: str = "1 minute") -> DataFrame:
    """T4, first half, on streams: comments (``c_et``) JOIN their order (``info_id``, ``o_et``) within
    ``bound`` (J11), then exact de-duplication on order id and time (F9)."""
    x = bounded_join(comments, orders, [("order_id", "info_id")], "c_et", "o_et", bound)
    return x.dropDuplicatesWithinWatermark(["order_id", "ts_ms"])


def moderation_sink(words_loader, path: str, screened_loader=None):
    """T4, second half, per micro-batch: last-word check (T2), whole-text check (T3; with a list of its own when
    ``screened_loader`` is given), with the word lists as they are now; result rows under ``batch=<id>`` (a
    replayed batch overwrites its own)."""
    from emporia.operators import text
    from emporia.operators.routing import with_ds

    def write(batch: DataFrame, batch_id: int) -> None:
        words = words_loader()
        rows = with_ds(batch.select("id", "user_id", "consignee", "ts_ms", "msg"))
        out = text.check_all_words(text.check_last_word(rows, words), (screened_loader or words_loader)())
        out.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))
    return write


# ------------------------------------------------------------------ J3 / J10-J14, F9

def interval_join_stream(left: DataFrame, right: DataFrame, key: str, left_et: str, right_et: str,
                         lower: str, upper: str) -> DataFrame:
    """Interval join of two watermarked streams: equal ``key`` and
    ``right_et`` within ``[left_et + lower, left_et + upper]``; Spark keeps
    each side's rows only as long as the other side's watermark allows."""
    cond = (left[key] == right[key]) & \
        (right[right_et] >= left[left_et] + F.expr(f"interval {lower}")) & \
        (right[right_et] <= left[left_et] + F.expr(f"interval {upper}"))
    return left.join(right, cond, "inner").drop(right[key])


def order_detail_stream(details: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame,
                        bound: str = "10 seconds") -> DataFrame:
    """J1 on streams: detail JOIN order, LEFT activity, LEFT coupon.

    The source keeps join state for an idle time; a stream-stream join
    bounds state by event time instead: each side must lie within
    ``bound`` of the detail's time. Each stream carries its own watermarked
    time column (``d_et``, ``o_et``, ``a_et``, ``c_et``); the joined side's
    column is dropped before the next join (one event-time column per
    stateful step). Left-join misses are emitted once the watermark passes
    the bound. Every detail version is emitted; an upsert sink (K3) keeps
    the latest per id, which is the batch fact table.
    """
    def within(other: str):
        return (F.col(other) >= F.col("d_et") - F.expr(f"interval {bound}")) & \
            (F.col(other) <= F.col("d_et") + F.expr(f"interval {bound}"))

    x = details.join(orders, (details["order_id"] == orders["oi_id"]) & within("o_et"), "inner").drop("o_et", "oi_id")
    x = x.join(activity, (x["id"] == activity["a_detail_id"]) & within("a_et"), "left").drop("a_et", "a_detail_id")
    x = x.join(coupon, (x["id"] == coupon["c_detail_id"]) & within("c_et"), "left").drop("c_et", "c_detail_id")
    return x


def bounded_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], left_et: str, right_et: str,
                 bound: str, how: str = "inner") -> DataFrame:
    """Stream-stream equi-join whose state is bounded by event time: the right
    row's time within ``bound`` of the left row's; the right side's key and
    time columns are dropped (one event-time column per stateful step)."""
    cond = (F.col(right_et) >= F.col(left_et) - F.expr(f"interval {bound}")) & \
        (F.col(right_et) <= F.col(left_et) + F.expr(f"interval {bound}"))
    for lk, rk in keys:
        cond = cond & (left[lk] == right[rk])
    out = left.join(right, cond, how).drop(right_et)
    return out.drop(*[rk for lk, rk in keys if rk != lk])


def order_cancel_stream(fact: DataFrame, changes: DataFrame, bound: str = "30 minutes") -> DataFrame:
    """J2 on streams: order-detail fact (``d_et``) JOIN order changes
    (``cancel_order_id``, ``c_et``) within ``bound`` (the source's 30 min
    state retention)."""
    return bounded_join(fact, changes, [("order_id", "cancel_order_id")], "d_et", "c_et", bound)


def refund_stream(refunds: DataFrame, orders: DataFrame, dic: DataFrame, bound: str = "5 seconds") -> DataFrame:
    """J4 on streams: refund (``r_et``) JOIN order (``oi_id``, ``o_et``) within
    ``bound``, then two look-ups into the same dictionary (stream-static
    inner joins: unknown codes drop, as in the look-up join)."""
    x = bounded_join(refunds, orders, [("order_id", "oi_id")], "r_et", "o_et", bound)
    t = dic.select(F.col("dic_code").alias("refund_type"), F.col("dic_name").alias("refund_type_name"))
    rr = dic.select(F.col("dic_code").alias("refund_reason_type"), F.col("dic_name").alias("refund_reason_type_name"))
    return x.join(t, "refund_type").join(rr, "refund_reason_type")


def refund_payment_stream(payments: DataFrame, refunds: DataFrame, orders: DataFrame, dic: DataFrame,
                          bound: str = "5 seconds") -> DataFrame:
    """J5 on streams: refund payment (``p_et``) JOIN refund on (order, sku)
    (``r_order_id``, ``r_sku_id``, ``r_et``) JOIN order (``oi_id``, ``o_et``),
    each within ``bound``, then the payment-type dictionary (stream-static)."""
    x = bounded_join(payments, refunds, [("order_id", "r_order_id"), ("sku_id", "r_sku_id")], "p_et", "r_et", bound)
    x = bounded_join(x, orders, [("order_id", "oi_id")], "p_et", "o_et", bound)
    d = dic.select(F.col("dic_code").alias("payment_type"), F.col("dic_name").alias("payment_type_name"))
    return x.join(d, "payment_type")


def dedup_stream(df: DataFrame, cols: list[str]) -> DataFrame:
    """F9 on a stream: exact de-duplication, state kept until the watermark passes."""
    return df.dropDuplicatesWithinWatermark(cols)


# ------------------------------------------------------------------ foreachBatch sinks (K3, K4, K6)

def upsert_sink(keys: list[str], path: str, order: str = "ts_ms"):
    """K3 as a ``foreachBatch`` writer: every batch is merged into the table;
    replaying a batch gives the same table, so the sink is idempotent."""
    from emporia.sources.sinks import upsert

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, keys, path, order=order)
    return write


def snapshot_then_log(snapshot: DataFrame, log: DataFrame, write, checkpoint: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """S10 ``initial``: the snapshot goes through ``write(df, 0)`` once (a marker under the checkpoint
    tells that it has), then the log's micro-batches as 1, 2, ... into the same sink."""
    from emporia.sources.sinks import written

    spark = snapshot.sparkSession
    done = os.path.join(checkpoint, "snapshot_done")
    if not written(spark, done):
        write(snapshot, 0)
        spark.range(1).write.mode("overwrite").parquet(done)
    return start(log, os.path.join(checkpoint, "log"), sink=lambda df, i: write(df, i + 1), trigger=trigger)


def result_sink(path: str, table_name: str):
    """K4 as a ``foreachBatch`` writer: JSON lines, one directory per batch id."""
    from emporia.sources.sinks import write_result

    def write(batch: DataFrame, batch_id: int) -> None:
        write_result(batch, path, table_name, batch_id)
    return write


def read_page_stream(spark: SparkSession, directory: str, max_files: int = 1) -> DataFrame:
    """S2/S9 on a directory of JSON-line files: parsed, flat page-log stream."""
    from emporia.sources.logs import read_page_log
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(directory)
    return read_page_log(spark, raw)


# ------------------------------------------------------------------ P5-P7, J6, K6 per micro-batch

def routing_sink(config_loader, out_path: str):
    """P5 + J16 on a stream: every micro-batch is routed with the config as it
    is now (``config_loader()`` re-reads it, so a config change applies from
    the next batch -- the latest config wins, Q23) and written one directory
    per target (K2), idempotently per batch id."""
    from emporia.operators.routing import route_facts

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = route_facts(batch, config_loader())
        (routed.withColumn("data", F.to_json("data")).write.mode("overwrite")
         .partitionBy("sink_table").json(os.path.join(out_path, f"batch={batch_id}")))
    return write


def dim_sink(config_loader, path: str):
    """P6 + K6 on a stream: route each micro-batch's dimension changes with the
    current config and merge them into the dimension table (latest op per
    ``(table, row key)``; deletes stay as tombstones for late changes). Read
    it with ``sinks.read_upsert``."""
    from emporia.operators.routing import route_dims
    from emporia.sources.sinks import upsert

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = route_dims(batch, config_loader())
        upsert(routed.select("sink_table", F.col("data")[F.col("sink_row_key")].alias("row_key"), "op", "data",
                             "ts_ms"), ["sink_table", "row_key"], path)
    return write


def log_split_sink(out_path: str):
    """P8 on a stream: each micro-batch of parsed page-log records (nested,
    ``read_page_log(..., nested=True)``) is split five ways -- err, start,
    page, display, action -- and each output written as JSON under
    ``<kind>/batch=<id>`` (a replayed batch overwrites its own folders). The
    batch is parsed once and kept for the five writes."""
    from emporia.operators.routing import split_log

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for kind, df in split_log(kept).items():
                df.write.mode("overwrite").json(os.path.join(out_path, kind, f"batch={batch_id}"))
        finally:
            kept.unpersist()
    return write


def lookup_sink(dim_loader, key: str, out_path: str, how: str = "inner"):
    """J6 on a stream: a processing-time look-up join against the dimension as
    it is when the micro-batch runs (re-read per batch, the equivalent of the
    source's cached remote look-up)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.join(dim_loader(), key, how).write.mode("overwrite").parquet(
            os.path.join(out_path, f"batch={batch_id}"))
    return write


# ------------------------------------------------------------------ A8

DEVICE_FIELDS = ["os", "ch", "md", "ba", "search_item"]


def device_state_stream(devices: DataFrame, fields: list[str] = DEVICE_FIELDS, ttl_ms: int | None = None) -> DataFrame:
    """A8 on a stream (with F8): the running per-user device state, one row
    per new payload; feed it to :func:`last_in_processing_window` for A9."""
    schema = "uid string, ts_ms long, pv long, " + ", ".join(f"{f} string" for f in fields)
    return (devices.select("uid", "ts_ms", *fields).groupBy("uid")
            .transformWithStateInPandas(P.DeviceState(fields, ttl_ms=ttl_ms), schema, "append",
                                        "ProcessingTime" if ttl_ms else "None"))


# ------------------------------------------------------------------ W5 / A9

def last_in_processing_window(df: DataFrame, key: str, cols: list[str], size: str = "2 minutes",
                              order: str = "ts_ms") -> DataFrame:
    """A9 on a stream: the last record per key in each tumbling processing-time
    window (W5). Arrival time is stamped per micro-batch and used as the
    window's time; the window is emitted once arrival time has passed it
    (run with ``trigger(processingTime=size)``)."""
    stamped = df.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", "0 seconds")
    agg = stamped.groupBy(key, F.window("_arrival", size).alias("window")).agg(
        F.max_by(F.struct(*cols), F.col(order)).alias("_last"))
    return windows.stamp_window(agg.select(key, "window", *[F.col("_last")[c].alias(c) for c in cols]))
