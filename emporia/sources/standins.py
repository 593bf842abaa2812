"""Stand-in record streams derived from the driver's tables.

The shop's change log and page log are not part of the test data, so
these functions derive them from the TPC-H-like tables with plain
DataFrame operations (the same definitions, written as SQL, feed the
DuckDB oracle in ``emporia.plans.oracle``). Every stand-in grows with
its input tables; nothing here is a fixed literal data set.

Shapes produced:

* page log (flat): one row per log record with the ``common`` and
  ``page`` fields promoted to columns, ``ts_ms`` in epoch milliseconds.
* change log: ``before``/``after``/``source`` string maps, ``op``,
  ``ts_ms`` and the record ``key``, one row per change, all shop tables
  in one stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.session import bounded_tasks
from emporia.sources.tables import table

# Fixed values of the stand-in mapping (shared with the SQL oracle).
PAGE_OF_EVENT = {"view": "home", "click": "good_detail", "purchase": "order", "signup": "login"}
PAGE_DEFAULT = "search"
USER_EPOCH_MS = 1704067200000  # 2024-01-01 00:00:00 UTC
CDC_DB = "shop"
CDC_SERVER = "1"


def _ms(ts: Column) -> Column:
    """Epoch milliseconds of a (zone-less) timestamp, read in the session zone (UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def events_k(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))


def item_key(spark: SparkSession, sf: str, key: Column) -> Column:
    """The part a record points at: its key spread over the whole part table (a scalar subquery for its size)."""
    return key % table(spark, sf, "part").agg(F.count(F.lit(1))).scalar()


def page_log(spark: SparkSession, sf: str) -> DataFrame:
    """Flat page log: one record per event."""
    e = events_k(spark, sf).withColumn("_item", item_key(spark, sf, F.col("event_id")))
    items = table(spark, sf, "part").select("p_partkey", "p_name")
    page_id = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in PAGE_OF_EVENT.items() for x in kv]),
                     F.col("event_type")),
        F.lit(PAGE_DEFAULT))
    x = e.join(items, F.col("p_partkey") == F.col("_item"), "left").withColumn("page_id", page_id)
    w = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")
    k = F.col("k")
    return x.select(
        "event_id",
        _ms(F.col("ts")).alias("ts_ms"),
        F.col("user_id").cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        "page_id",
        F.lag("page_id").over(w).alias("last_page_id"),
        F.when(k % 2 == 0, "keyword").otherwise("sku_id").alias("item_type"),
        F.col("p_name").alias("item"),
        F.floor("value").cast("bigint").alias("during_time"),
        (k % 3).cast("string").alias("vc"),
        (k % 4).cast("string").alias("ch"),
        (k % 5).cast("string").alias("ar"),
        (F.col("event_id") % 2).cast("string").alias("is_new"),
        F.when(k % 3 == 0, "iOS 13.0").when(k % 3 == 1, "Android 12.0").otherwise("Windows 10").alias("os"),
        F.concat(F.lit("model-"), (k % 6).cast("string")).alias("md"),
        F.concat(F.lit("brand-"), (k % 4).cast("string")).alias("ba"),
        (k % 10 == 0).alias("has_err"),
        (k % 10 == 1).alias("has_start"),
        "k",
    )


def page_log_json(spark: SparkSession, sf: str) -> DataFrame:
    """The page log as raw JSON lines (``value``), nested like the app's log."""
    p = page_log(spark, sf)
    common = F.struct(*[F.col(c) for c in ("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc")])
    page = F.struct("during_time", "item", "item_type", "last_page_id", "page_id")
    err = F.when(F.col("has_err"), F.struct(F.lit(1000 + 1).alias("error_code"),
                                              F.lit("stand-in error").alias("msg")))
    start = F.when(F.col("has_start"), F.struct(F.lit("icon").alias("entry"),
                                                  F.lit(0).cast("bigint").alias("loading_time")))
    displays = F.when(F.col("k") % 4 == 0, F.array(
        F.struct(F.lit("sku_id").alias("item_type"), (F.col("event_id") % 97).cast("string").alias("item"),
                 F.lit(1).alias("pos_id")),
        F.struct(F.lit("activity_id").alias("item_type"), (F.col("event_id") % 13).cast("string").alias("item"),
                 F.lit(2).alias("pos_id"))))
    actions = F.when(F.col("k") % 5 == 0, F.array(
        F.struct(F.lit("cart_add").alias("action_id"), (F.col("event_id") % 97).cast("string").alias("item"),
                 F.col("ts_ms").alias("ts"))))
    rec = F.struct(common.alias("common"), page.alias("page"), err.alias("err"), start.alias("start"),
                   displays.alias("displays"), actions.alias("actions"), F.col("ts_ms").alias("ts"),
                   F.col("event_id").alias("event_id"))
    return p.select(F.to_json(rec).alias("value"))


def order_info(spark: SparkSession, sf: str) -> DataFrame:
    # (of the priority only the code is moved)
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus",
                                          F.substring("o_orderpriority", 1, 1).alias("_type"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("c_nationkey").alias("province_id"),
        F.col("o_orderdate").alias("create_time"),
        F.col("o_totalprice").cast("decimal(16,2)").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("_type").alias("type_code"),
    )


DETAIL_RAW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_shipdate", "p_name", "p_retailprice"]


def _order_of(line_id: Column) -> Column:
    """The order in an id made as order * 10 + line."""
    return F.call_function("div", line_id, F.lit(10))


def _record_key(key: Column) -> Column:
    """The key that a change record carries beside its value: the primary key as text, empty when it is null."""
    return F.coalesce(key.cast("string"), F.lit(""))


def order_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Order-detail changes; repeated ids are later versions (``seq`` 1 = first).

    Only the tables' own columns are shuffled, the others are made of them
    afterwards. Versions are ordered by all of these columns and dealt by
    their record key (the id as text, never null), so that neither a branch's
    columns nor its filters reach below the shuffle: all tables of the change
    log that come from details share one, and what groups or joins them by
    ``key`` later needs no other.
    """
    li = table(spark, sf, "lineitem")
    bounded_tasks(spark, li)
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    order += [c for c in DETAIL_RAW if c not in order]
    order_key, line = F.col("l_orderkey"), F.col("l_linenumber")
    line_id = order_key * 10 + line
    # order and line are shuffled only where the id does not tell them (lines from 10 on, nulls)
    told = F.coalesce((_order_of(line_id) == order_key) & (line_id % 10 == line), F.lit(False))
    raw = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
           .select(*[c for c in DETAIL_RAW if c not in ("l_orderkey", "l_linenumber")],
                   F.when(~told, F.struct("l_orderkey", "l_linenumber")).alias("_own"), _record_key(line_id).alias("_order_line"))
           .repartition("_order_line"))
    id_ = F.col("_order_line").try_cast("bigint")
    types = dict(li.dtypes)
    raw = raw.withColumns({"l_orderkey": F.coalesce("_own.l_orderkey", _order_of(id_).cast(types["l_orderkey"])),
                           "l_linenumber": F.coalesce("_own.l_linenumber", (id_ % 10).cast(types["l_linenumber"]))})
    # other names of the same columns, given after the shuffle, so that it moves them once
    raw = raw.withColumns({"_order": F.col("l_orderkey"), "_line": F.col("l_linenumber")})
    w = Window.partitionBy("_order_line", "_order", "_line").orderBy(*order)
    # same order, whole frame: both numbers come from one sort
    d = raw.select(*DETAIL_RAW, F.col("_order_line").alias("key"), F.row_number().over(w).alias("seq"),
                   F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return d.select(
        line_id.alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        F.col("l_shipdate").alias("create_time"),
        F.col("l_quantity").cast("int").alias("sku_num"),
        F.col("p_retailprice").cast("decimal(16,2)").alias("order_price"),
        F.col("l_extendedprice").cast("decimal(16,2)").alias("split_total_amount"),
        (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,4)").alias("split_activity_amount"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)").alias("split_coupon_amount"),
        F.col("l_suppkey").alias("supp_id"), "l_discount", "l_tax", "l_returnflag", "seq", "n", "key",
    )


def order_detail_latest(spark: SparkSession, sf: str) -> DataFrame:
    return order_detail(spark, sf).where(F.col("seq") == F.col("n"))


def _activity_of() -> tuple[Column, dict[str, Column]]:
    """Which details have an activity, and its columns made of the detail's (so do the next three)."""
    return F.col("l_discount") >= 0.05, {"order_detail_id": F.col("id"), "activity_id": F.col("supp_id") % 10,
                                         "activity_rule_id": F.col("supp_id") % 7}


def _coupon_of() -> tuple[Column, dict[str, Column]]:
    return F.col("l_tax") >= 0.04, {"order_detail_id": F.col("id"), "coupon_id": F.col("supp_id") % 5}


def _refund_of() -> tuple[Column, dict[str, Column]]:
    return F.col("l_returnflag") == "R", {
        "id": F.col("id"), "order_id": F.col("order_id"), "sku_id": F.col("sku_id"), "refund_num": F.col("sku_num"),
        "refund_amount": F.col("split_total_amount"), "create_time": F.col("create_time"),
        "refund_type": (F.col("id") % 3 + 1).cast("string"), "refund_reason_type": (F.col("id") % 5 + 1).cast("string"),
        "refund_reason_txt": F.concat(F.lit("reason of "), F.col("id").cast("string"))}


def _refund_payment_of(amount: str = "refund_amount") -> tuple[Column, dict[str, Column]]:
    return F.col("id") % 2 == 0, {
        "id": F.col("id"), "order_id": F.col("order_id"), "sku_id": F.col("sku_id"), "total_amount": F.col(amount),
        "callback_time": F.col("create_time"), "payment_type": (F.col("id") % 4 + 1).cast("string")}


def _made(df: DataFrame, of: tuple[Column, dict[str, Column]], *kept: str) -> DataFrame:
    return df.where(of[0]).select(*kept, *[c.alias(n) for n, c in of[1].items()])


def activity(spark: SparkSession, sf: str, detail: DataFrame | None = None) -> DataFrame:
    return _made(detail if detail is not None else order_detail_latest(spark, sf), _activity_of(), "key")


def coupon(spark: SparkSession, sf: str, detail: DataFrame | None = None) -> DataFrame:
    return _made(detail if detail is not None else order_detail_latest(spark, sf), _coupon_of(), "key")


def refund(spark: SparkSession, sf: str, detail: DataFrame | None = None) -> DataFrame:
    return _made(detail if detail is not None else order_detail_latest(spark, sf), _refund_of())


def payment(spark: SparkSession, sf: str, detail: DataFrame | None = None) -> DataFrame:
    """One payment per order, within 40 min of its first detail: most fall into the half hour that J3 accepts."""
    d = detail if detail is not None else order_detail_latest(spark, sf)
    first = d.groupBy("order_id").agg(F.min("create_time").alias("first_time"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    delay = F.make_dt_interval(secs=((F.col("order_id") * 7919) % 2400).cast("decimal(18,6)"))
    return first.join(o, F.col("order_id") == F.col("o_orderkey")).select(
        F.col("order_id").alias("id"), "order_id", F.col("o_custkey").alias("user_id"),
        (F.col("order_id") % 5 + 1).cast("string").alias("payment_type"),
        (F.col("first_time") + delay).alias("callback_time"))


def refund_payment(spark: SparkSession, sf: str, refunds: DataFrame | None = None) -> DataFrame:
    return _made(refunds if refunds is not None else refund(spark, sf), _refund_payment_of())


def base_dic(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary rows ``dic_code, dic_name``; code 5 is absent on purpose."""
    o = table(spark, sf, "orders")
    return (o.select(F.substring("o_orderpriority", 1, 1).alias("dic_code"),
                     F.expr("substr(o_orderpriority, 3)").alias("dic_name"))
            .where(F.col("dic_code") != "5").distinct())


def sku(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("sku_name"),
        (F.col("p_partkey") % 50).alias("spu_id"), F.col("p_brand").alias("tm_name"),
        F.col("p_type").alias("category3_id"), F.length("p_type").alias("category2_id"),
        (F.length("p_type") % 2).alias("category1_id"))


def province(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(F.col("n_nationkey").alias("province_id"), F.col("n_name").alias("province_name"),
                    F.col("n_regionkey").alias("region_id"))


def _events_of(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    return table(spark, sf, "events").where(F.col("event_type") == kind).select("user_id", "event_id", "ts")


def payment_event(spark: SparkSession, sf: str) -> DataFrame:
    return _events_of(spark, sf, "purchase")


def detail_event(spark: SparkSession, sf: str) -> DataFrame:
    return _events_of(spark, sf, "click")


def login(spark: SparkSession, sf: str) -> DataFrame:
    """Login events: every sign-up event."""
    return _events_of(spark, sf, "signup")


def _customer_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with ``seen_ms``: their first event, or a time of their own when they have none."""
    first = table(spark, sf, "events").groupBy("user_id").agg(_ms(F.min("ts")).alias("_first"))
    c = table(spark, sf, "customer").join(first, F.col("c_custkey") == F.col("user_id"), "left")
    return c.withColumn("seen_ms", F.coalesce("_first", F.lit(USER_EPOCH_MS) + F.col("c_custkey") * 60000))


def user(spark: SparkSession, sf: str) -> DataFrame:
    c = _customer_seen(spark, sf)
    return c.select(
        F.col("c_custkey").alias("uid"), F.col("c_name").alias("uname"),
        F.when(F.col("c_custkey") % 3 != 0, F.lit("M")).alias("gender"),
        ((F.col("c_custkey") * 37) % 20000).alias("birthday_epoch_day"),
        F.col("seen_ms").alias("ts_ms"))


def user_sup(spark: SparkSession, sf: str) -> DataFrame:
    c = _customer_seen(spark, sf)
    return c.select(
        F.col("c_custkey").alias("uid"), (150 + F.col("c_custkey") % 50).alias("height"),
        F.lit("cm").alias("unit_height"), (45 + F.col("c_custkey") % 60).alias("weight"),
        F.lit("kg").alias("unit_weight"),
        (F.col("seen_ms") + ((F.col("c_custkey") * 7919) % 900 - 450) * 1000).alias("ts_ms"))


def comments(spark: SparkSession, sf: str) -> DataFrame:
    """Product comments: one per document, tied to the order with the same key.

    The comment time lies within +-90 s of the order's creation, so a
    +-1 min interval join keeps about two thirds of them.
    """
    d = table(spark, sf, "documents").select("doc_id", "text")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return d.join(o, F.col("doc_id") == F.col("o_orderkey")).select(
        F.col("doc_id").alias("id"), F.col("o_custkey").alias("user_id"),
        item_key(spark, sf, F.col("doc_id")).alias("sku_id"), F.col("doc_id").alias("order_id"),
        (1 + F.col("doc_id") % 5).cast("string").alias("appraise"),
        F.col("text").alias("comment_txt"),
        (_ms(F.col("o_orderdate")) + ((F.col("doc_id") * 7919) % 181 - 90) * 1000).alias("ts_ms"))


def words(spark: SparkSession, sf: str) -> DataFrame:
    """Word list: the distinct words of ``benchmark`` in any script, as written between blanks and as bare letters."""
    b = table(spark, sf, "benchmark").select(F.lower("text").alias("t"))
    toks = F.explode(F.concat(F.split("t", r"\s+"), F.split("t", r"[^\p{L}]+")))
    return b.select(toks.alias("word")).where(F.col("word") != "").distinct()


def screened_words(spark: SparkSession, sf: str) -> DataFrame:
    """The list that whole texts are screened for: every listed word."""
    return words(spark, sf)


# ---------------------------------------------------------------- change log

def _smap(cols: list[str], df: DataFrame, of: dict[str, Column] | None = None) -> Column:
    """String map of the given columns (values rendered as the change log does); ``of``: what they are made of."""
    of = of or {c: F.col(c) for c in cols}
    types = dict(df.select(*[of[c].alias(c) for c in cols]).dtypes)

    def render(c: str) -> Column:
        if types[c].startswith("timestamp"):
            return F.date_format(of[c], "yyyy-MM-dd HH:mm:ss")
        return of[c].cast("string")
    return F.create_map(*[x for c in cols for x in (F.lit(c), render(c))])


def _source(tbl: Column) -> Column:
    return F.create_map(F.lit("db"), F.lit(CDC_DB), F.lit("table"), tbl, F.lit("server_id"), F.lit(CDC_SERVER))


CDC_COLUMNS = {
    "order_info": ["id", "user_id", "province_id", "create_time", "total_amount", "order_status", "type_code"],
    "order_detail": ["id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price",
                     "split_total_amount", "split_activity_amount", "split_coupon_amount"],
    "order_detail_activity": ["order_detail_id", "activity_id", "activity_rule_id"],
    "order_detail_coupon": ["order_detail_id", "coupon_id"],
    "order_refund_info": ["id", "order_id", "sku_id", "refund_num", "refund_amount", "create_time",
                          "refund_type", "refund_reason_type", "refund_reason_txt"],
    "payment_info": ["id", "order_id", "user_id", "payment_type", "callback_time"],
    "refund_payment": ["id", "order_id", "sku_id", "total_amount", "callback_time", "payment_type"],
    "base_dic": ["dic_code", "dic_name"],
    "base_province": ["province_id", "province_name", "region_id"],
    "sku_info": ["sku_id", "sku_name", "spu_id", "tm_name", "category3_id"],
    "cart_info": ["id", "user_id", "sku_id", "sku_num"],
    "comment_info": ["id", "user_id", "sku_id", "order_id", "appraise", "comment_txt"],
}


NULL_MAP = "map<string,string>"


def _changes(df: DataFrame, tbl: str, op: Column, ts_ms: Column, before: bool = False) -> DataFrame:
    m = _smap(CDC_COLUMNS[tbl], df)
    null_map = F.lit(None).cast(NULL_MAP)
    key = F.col("key") if "key" in df.columns else _record_key(F.col(CDC_COLUMNS[tbl][0]))
    return df.select(
        (m if before else null_map).alias("before"),
        (null_map if before else m).alias("after"),
        _source(F.lit(tbl)).alias("source"), op.alias("op"), ts_ms.cast("bigint").alias("ts_ms"), key.alias("key"))


def _detail_op() -> tuple[Column, Column]:
    """Op and time of an order detail's version."""
    return F.when(F.col("seq") == 1, "c").otherwise("u"), _ms(F.col("create_time")) + F.col("seq")


def _detail_parts(spark: SparkSession, sf: str, det: DataFrame) -> dict[str, DataFrame]:
    """The tables made of one order detail each, one branch per table."""
    latest = det.where(F.col("seq") == F.col("n"))
    refunds = refund(spark, sf, latest)
    rpay = refund_payment(spark, sf, refunds)
    base_ts = F.lit(USER_EPOCH_MS)
    return {
        "order_detail": _changes(det, "order_detail", *_detail_op()),
        "order_detail_activity": _changes(activity(spark, sf, latest), "order_detail_activity", F.lit("c"), base_ts),
        "order_detail_coupon": _changes(coupon(spark, sf, latest), "order_detail_coupon", F.lit("c"), base_ts),
        "order_refund_info": _changes(refunds, "order_refund_info", F.lit("c"), _ms(F.col("create_time"))),
        "refund_payment": _changes(rpay, "refund_payment", F.lit("c"), _ms(F.col("callback_time"))),
    }


def _detail_changes(det: DataFrame) -> DataFrame:
    """The rows of :func:`_detail_parts` with their ``table_name``: a detail's records are made side by side, in one
    pass over the details, instead of one pass (with a sort of its own) per table."""
    latest = F.col("seq") == F.col("n")
    refunded, refund_cols = _refund_of()
    repaid, repay_cols = _refund_payment_of("split_total_amount")
    base_ts = F.lit(USER_EPOCH_MS)
    created = _ms(F.col("create_time"))
    same = {c: F.col(c) for c in CDC_COLUMNS["order_detail"]}
    made = [("order_detail", None, same, *_detail_op())]
    for tbl, (cond, cols), ts in (("order_detail_activity", _activity_of(), base_ts), ("order_detail_coupon", _coupon_of(), base_ts),
                                  ("order_refund_info", (refunded, refund_cols), created),
                                  ("refund_payment", (refunded & repaid, repay_cols), created)):
        made.append((tbl, latest & cond, cols, F.lit("c"), ts))
    records = []
    for tbl, cond, cols, op, ts in made:
        rec = F.struct(F.lit(tbl).alias("table_name"), op.alias("op"), ts.cast("bigint").alias("ts_ms"),
                       _smap(CDC_COLUMNS[tbl], det, cols).alias("after"))
        records.append(rec if cond is None else F.when(cond, rec))
    rows = det.select("key", F.explode(F.array(*records)).alias("_r")).where(F.col("_r").isNotNull())
    return rows.select(F.lit(None).cast(NULL_MAP).alias("before"), F.col("_r.after").alias("after"),
                       _source(F.col("_r.table_name")).alias("source"), F.col("_r.op").alias("op"),
                       F.col("_r.ts_ms").alias("ts_ms"), "key", F.col("_r.table_name").alias("table_name"))


def _other_parts(spark: SparkSession, sf: str, det: DataFrame) -> dict[str, DataFrame]:
    """The tables that are not made of one order detail each."""
    oi = order_info(spark, sf)
    cart = detail_event(spark, sf).select(F.col("event_id").alias("id"), "user_id",
                                          item_key(spark, sf, F.col("event_id")).alias("sku_id"),
                                          (1 + F.col("event_id") % 3).alias("sku_num"), "ts")
    com = comments(spark, sf)
    prov = province(spark, sf)
    pay = payment(spark, sf, det.where(F.col("seq") == F.col("n")))
    base_ts = F.lit(USER_EPOCH_MS)
    return {
        "order_info": _changes(oi, "order_info", F.lit("c"), _ms(F.col("create_time"))),
        "payment_info": _changes(pay, "payment_info", F.lit("c"), _ms(F.col("callback_time"))),
        "base_dic": _changes(base_dic(spark, sf), "base_dic", F.lit("r"), base_ts),
        "base_province": _changes(prov, "base_province", F.lit("r"), base_ts).unionByName(
            _changes(prov.where(F.col("province_id") % 10 == 9), "base_province", F.lit("d"), base_ts + 1000,
                     before=True)),
        "sku_info": _changes(sku(spark, sf), "sku_info", F.lit("r"), base_ts),
        "cart_info": _changes(cart, "cart_info", F.lit("c"), _ms(F.col("ts"))),
        "comment_info": _changes(com, "comment_info", F.lit("c"), F.col("ts_ms")),
    }


def _named(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.withColumn("table_name", F.lit(t)) for t, df in parts.items()))


def cdc(spark: SparkSession, sf: str) -> DataFrame:
    """The whole change log (insert/update/delete records) as one stream, a branch per shop table.

    ``table_name`` is a literal per branch: a filter on it removes the branches of the other tables from
    the plan, so a job reads only the tables it needs. Jobs that take every table read :func:`whole_cdc`.

    * order_detail: the first version of an id is ``c``, later ones ``u``
      (``before`` holds nothing, as with an update that only sends ``after``).
    * dictionary, province and sku rows are snapshot reads ``r``.
    * every province with a key ending in 9 is deleted later (``d``,
      ``before`` only).
    """
    det = order_detail(spark, sf)
    return _named({**_detail_parts(spark, sf, det), **_other_parts(spark, sf, det)})


def whole_cdc_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """:func:`whole_cdc` as the tables made of order details, which are dealt by their record key, and the others."""
    det = order_detail(spark, sf)
    return _detail_changes(det), _named(_other_parts(spark, sf, det))


def whole_cdc(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of :func:`cdc` for jobs that take every table: details are sorted into versions once for the five
    tables made of them (and once for the payments), not once per table."""
    return DataFrame.unionByName(*whole_cdc_parts(spark, sf))


def config_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A routing-config change feed: every part is a change of the route of its brand and type."""
    p = table(spark, sf, "part")
    op = F.when(F.col("p_partkey") % 11 == 0, "d").when(F.col("p_partkey") % 2 == 0, "c").otherwise("u")
    payload = F.create_map(F.lit("source_table"), F.col("p_brand"), F.lit("source_type"), F.col("p_type"),
                           F.lit("sink_table"), F.concat(F.lit("dwd_"), F.col("p_partkey").cast("string")),
                           F.lit("sink_columns"), F.col("p_name"))
    rows = p.select(op.alias("op"), payload.alias("m"), F.col("p_partkey").alias("ts_ms"))
    return rows.select(F.when(F.col("op") == "d", F.col("m")).alias("before"),
                       F.when(F.col("op") != "d", F.col("m")).alias("after"), "op", "ts_ms")


def _span(spark: SparkSession, sf: str, name: str, col: str) -> DataFrame:
    """One row (lo, hi): first and last time of a table, in ms."""
    ms = F.unix_millis(F.col(col).cast("timestamp"))
    return table(spark, sf, name).agg(F.min(ms).alias("lo"), F.max(ms).alias("hi"))


def dic_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary as it changed over the time of a code's orders: renamed three times, code 4 gone for a quarter."""
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    codes = (table(spark, sf, "orders").groupBy(F.substring("o_orderpriority", 1, 1).alias("dic_code"),
                                                F.expr("substr(o_orderpriority, 3)").alias("dic_name"))
             .agg(F.min(ms).alias("lo"), F.max(ms).alias("hi")).where(F.col("dic_code") != "5"))
    rows = codes.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    name = F.when(F.col("k") == 0, F.col("dic_name")).otherwise(F.concat("dic_name", F.lit(" v"), F.col("k").cast("string")))
    return rows.select("dic_code", name.alias("dic_name"), F.expr("lo + (hi - lo) * k div 4").alias("ts_ms"),
                       ((F.col("k") == 2) & (F.col("dic_code") == "4")).alias("deleted"))


def route_versions(spark: SparkSession, sf: str, feed: list[tuple]) -> DataFrame:
    """Fact routes as they changed: step s of the feed at s thirds of the time of the table's events."""
    cols = "step int, op string, source_table string, kind string, source_type string, sink_table string, sink_columns string"
    rows = spark.createDataFrame([(s, op, t, "events" if t == "cart_info" else "orders", o, sink, c) for s, op, t, o, sink, c in feed], cols)
    spans = (_span(spark, sf, "events", "ts").withColumn("kind", F.lit("events"))
             .unionByName(_span(spark, sf, "orders", "o_orderdate").withColumn("kind", F.lit("orders"))))
    return rows.join(spans, "kind").select("source_table", "source_type", "sink_table", "sink_columns",
                                           F.expr("lo + (hi - lo) * step div 3").alias("ts_ms"), (F.col("op") == "d").alias("deleted"))


# ---------------------------------------------------------------- CSV lines

EMP_SCHEMA = "empno BIGINT, ename STRING, deptno INT, ts BIGINT"
DEPT_SCHEMA = "deptno INT, dname STRING, ts BIGINT"


def emp_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Employee lines ``empno,ename,deptno,ts`` (one per customer); the time
    is the department's second plus a few milliseconds."""
    c = table(spark, sf, "customer")
    ts = F.lit(USER_EPOCH_MS) + F.col("c_nationkey") * 1000 + F.col("c_custkey") % 11
    return c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name",
                                F.col("c_nationkey").cast("string"), ts.cast("string")).alias("value"))


def dept_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Department lines ``deptno,dname,ts``: nations (but every fourth) at
    their second + 3 ms, and regions as departments 100+ without staff."""
    n = table(spark, sf, "nation").where(F.col("n_nationkey") % 4 != 3)
    r = table(spark, sf, "region")
    ts = F.lit(USER_EPOCH_MS) + F.col("n_nationkey") * 1000 + 3
    nat = n.select(F.concat_ws(",", F.col("n_nationkey").cast("string"), "n_name", ts.cast("string")).alias("value"))
    reg = r.select(F.concat_ws(",", (F.col("r_regionkey") + 100).cast("string"), "r_name",
                               F.lit(USER_EPOCH_MS).cast("string")).alias("value"))
    return nat.unionByName(reg)
