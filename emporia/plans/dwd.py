"""DWD fact tables built from the change log."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions.scalars import amount_product, reformat
from emporia.operators import joins, routing
from emporia.operators.versions import as_of_join
from emporia.plans import common
from emporia.plans.oracle_views import with_views
from emporia.plans.registry import register
from emporia.sources import standins

S = "varchar"


def _dt(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


# ------------------------------------------------------------------ P1 cart fact

@register("cart_add_fact", with_views(f"""
select cast(event_id as {S}) as id, cast(user_id as {S}) as user_id, cast(event_id % (select count(*) from part) as {S}) as sku_id,
  cast(1 + event_id % 3 as {S}) as sku_num, epoch_us(ts) // 1000 as ts
from v_detail_event""", "v_detail_event"))
def cart_add_fact(spark, sf):
    """Cart-add rows of the change log (table demultiplex + ``after`` projection)."""
    c = common.cdc(spark, sf)
    rows = routing.fact_source(c, "cart_info", ["id", "user_id", "sku_id", "sku_num"], ops=["c", "r"])
    return rows.select("id", "user_id", "sku_id", "sku_num", F.col("ts_ms").alias("ts"))


# ------------------------------------------------------------------ J1

DETAIL_FACT_COLS = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
                    "activity_rule_id", "coupon_id", "date_id", "create_time", "sku_num", "split_original_amount",
                    "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts"]


def widened(det, c):
    """Detail rows JOIN order, LEFT activity, LEFT coupon: user, province and promotion columns beside their own.

    The two left joins are by the record key, by which the change log is
    dealt, so details as they come from it are not exchanged for them; the
    order join exchanges on order id.
    """
    def promotions(table, cols, key):
        rows = routing.keyed_source(c, table, "order_detail_id", ["order_detail_id", *cols], keep_ts=False)
        return rows.where(F.col("order_detail_id").isNotNull()).select(F.col("key").alias(key), *cols)

    act = promotions("order_detail_activity", ["activity_id", "activity_rule_id"], "act_key")
    cou = promotions("order_detail_coupon", ["coupon_id"], "cou_key")
    info = common.order_info(c).select(F.col("id").alias("oi_id"), "user_id", "province_id")
    x = (det.join(act, det["key"] == act["act_key"], "left")
            .join(cou, det["key"] == cou["cou_key"], "left")
            .join(info, det["order_id"] == info["oi_id"], "inner"))
    return x.select(*[det[k] for k in det.columns], "user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
                    amount_product(det["sku_num"], det["order_price"]).cast("string").alias("split_original_amount"))


def order_detail_fact_df(c):
    """The upsert view of details, widened."""
    x = widened(common.detail_latest(c), c)
    return x.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        reformat(F.col("create_time")).alias("date_id"), "create_time", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount", "split_total_amount", F.col("ts_ms").alias("ts"))


DETAIL_FACT_SQL = f"""
  select cast(d.id as {S}) as id, cast(d.order_id as {S}) as order_id, cast(o.user_id as {S}) as user_id,
    cast(d.sku_id as {S}) as sku_id, d.sku_name, cast(o.province_id as {S}) as province_id,
    cast(a.activity_id as {S}) as activity_id, cast(a.activity_rule_id as {S}) as activity_rule_id,
    cast(c.coupon_id as {S}) as coupon_id, strftime(d.create_time, '%Y-%m-%d') as date_id,
    {_dt('d.create_time')} as create_time, cast(d.sku_num as {S}) as sku_num,
    cast(cast(d.sku_num as decimal(16,2)) * d.order_price as {S}) as split_original_amount,
    cast(d.split_activity_amount as {S}) as split_activity_amount,
    cast(d.split_coupon_amount as {S}) as split_coupon_amount,
    cast(d.split_total_amount as {S}) as split_total_amount,
    epoch_us(d.create_time) // 1000 + d.seq as ts
  from v_order_detail_latest d join v_order_info o on d.order_id = o.id
  left join v_activity a on a.order_detail_id = d.id left join v_coupon c on c.order_detail_id = d.id"""


@register("order_detail_fact", with_views(DETAIL_FACT_SQL, "v_order_detail_latest", "v_order_info",
                                          "v_activity", "v_coupon"))
def order_detail_fact(spark, sf):
    """The order-detail fact table (17 columns) from the change log."""
    return order_detail_fact_df(common.cdc(spark, sf))


# ------------------------------------------------------------------ J2

@register("order_cancel_fact", with_views(f"""
with od as ({DETAIL_FACT_SQL})
select od.id, od.order_id, od.user_id, od.sku_id, od.sku_name, od.province_id, od.activity_id,
  od.activity_rule_id, od.coupon_id, strftime(o.create_time, '%Y-%m-%d') as date_id,
  {_dt('o.create_time')} as cancel_time, od.sku_num, od.split_original_amount, od.split_activity_amount,
  od.split_coupon_amount, od.split_total_amount, epoch_us(o.create_time) // 1000 as ts
from od join v_order_info o on od.order_id = cast(o.id as {S})""",
    "v_order_detail_latest", "v_order_info", "v_activity", "v_coupon"))
def order_cancel_fact(spark, sf):
    """Order-detail fact JOIN order changes on the order id.

    As in the source jobs every order change counts as a cancel; pass a
    status predicate to :func:`order_cancel` to narrow it.
    """
    c = common.cdc(spark, sf)
    return order_cancel(order_detail_fact_df(c), common.order_info(c))


def order_cancel(fact, changes, predicate=None):
    """Fact rows JOIN the order changes (optionally narrowed by ``predicate``)."""
    ch = changes if predicate is None else changes.where(predicate)
    ch = ch.select(F.col("id").alias("cancel_order_id"), F.col("create_time").alias("cancel_time"),
                   F.col("ts_ms").alias("cancel_ts"))
    x = fact.join(ch, fact["order_id"] == ch["cancel_order_id"])
    cols = [c for c in DETAIL_FACT_COLS if c not in ("date_id", "create_time", "ts")]
    return x.select(*cols[:9], reformat(F.col("cancel_time")).alias("date_id"), "cancel_time", *cols[9:],
                    F.col("cancel_ts").alias("ts"))


# ------------------------------------------------------------------ J3

PAY_BEFORE_MS = 30 * 60 * 1000   # detail may precede the payment by 30 min ...
PAY_AFTER_MS = 5 * 1000          # ... or follow it by 5 s


@register("payment_interval_join", with_views(f"""
with od as ({DETAIL_FACT_SQL}),
oe as (select od.*, epoch_us(d.create_time) // 1000 as detail_ms
       from od join v_order_detail_latest d on cast(d.id as {S}) = od.id)
select od.id as order_detail_id, od.order_id, od.user_id, od.sku_id, od.sku_name, od.province_id, od.activity_id,
  od.activity_rule_id, od.coupon_id, p.payment_type as payment_type_code, dic.dic_name as payment_type_name,
  {_dt('p.callback_time')} as callback_time, od.sku_num, od.split_original_amount, od.split_activity_amount,
  od.split_coupon_amount, od.split_total_amount as split_payment_amount, epoch_us(p.callback_time) // 1000 as ts_ms
from v_payment p join oe od on od.order_id = cast(p.order_id as {S})
  and od.detail_ms between epoch_us(p.callback_time) // 1000 - {PAY_BEFORE_MS}
                       and epoch_us(p.callback_time) // 1000 + {PAY_AFTER_MS}
join v_base_dic dic on dic.dic_code = p.payment_type""",
    "v_payment", "v_order_detail_latest", "v_order_info", "v_activity", "v_coupon", "v_base_dic"))
def payment_interval_join(spark, sf):
    """Payments JOIN the order-detail fact on the order id with the detail time in
    [pay - 30 min, pay + 5 s], then the payment-type dictionary (inner lookup)."""
    c = common.cdc(spark, sf)
    pay = routing.fact_source(c, "payment_info", ["order_id", "payment_type", "callback_time"]).where(
        routing.has_key("order_id"))
    pay = pay.select("order_id", F.col("payment_type").alias("payment_type_code"), "callback_time",
                     F.col("ts_ms").alias("pay_ms"))
    det = common.detail_latest(c).withColumn("detail_ms", common.ms_of("create_time")).drop("create_time", "ts_ms")
    # The time bound first: only details that a payment meets are widened.
    x = widened(joins.interval_join(pay, det, "order_id", "pay_ms", "detail_ms", -PAY_BEFORE_MS, PAY_AFTER_MS), c)
    dic = common.base_dic(c).select(F.col("dic_code").alias("payment_type_code"),
                                    F.col("dic_name").alias("payment_type_name"))
    x = x.join(dic, "payment_type_code")
    return x.select(F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name", "province_id",
                    "activity_id", "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name",
                    "callback_time", "sku_num", "split_original_amount", "split_activity_amount",
                    "split_coupon_amount", F.col("split_total_amount").alias("split_payment_amount"),
                    F.col("pay_ms").alias("ts_ms"))


# ------------------------------------------------------------------ J4

@register("refund_fact", with_views(f"""
select cast(r.id as {S}) as id, cast(o.user_id as {S}) as user_id, cast(r.order_id as {S}) as order_id,
  cast(r.sku_id as {S}) as sku_id, cast(o.province_id as {S}) as province_id,
  strftime(r.create_time, '%Y-%m-%d') as date_id, {_dt('r.create_time')} as create_time,
  r.refund_type as refund_type_code, t.dic_name as refund_type_name,
  r.refund_reason_type as refund_reason_type_code, rr.dic_name as refund_reason_type_name, r.refund_reason_txt,
  cast(r.refund_num as {S}) as refund_num, cast(r.refund_amount as {S}) as refund_amount,
  epoch_us(r.create_time) // 1000 as ts_ms
from v_refund r join v_order_info o on r.order_id = o.id
join v_base_dic t on t.dic_code = r.refund_type
join v_base_dic rr on rr.dic_code = r.refund_reason_type""", "v_refund", "v_order_info", "v_base_dic"))
def refund_fact(spark, sf):
    """Refund JOIN order, two lookups into the same dictionary."""
    c = common.cdc(spark, sf)
    r = routing.fact_source(c, "order_refund_info", ["id", "order_id", "sku_id", "refund_num", "refund_amount",
                                                     "create_time", "refund_type", "refund_reason_type",
                                                     "refund_reason_txt"])
    o = common.order_info(c).select(F.col("id").alias("oid"), "user_id", "province_id")
    dic = common.base_dic(c)
    t = dic.select(F.col("dic_code").alias("refund_type"), F.col("dic_name").alias("refund_type_name"))
    rr = dic.select(F.col("dic_code").alias("refund_reason_type"),
                    F.col("dic_name").alias("refund_reason_type_name"))
    x = r.join(o, r["order_id"] == o["oid"]).join(t, "refund_type").join(rr, "refund_reason_type")
    return x.select("id", "user_id", "order_id", "sku_id", "province_id",
                    reformat(F.col("create_time")).alias("date_id"), "create_time",
                    F.col("refund_type").alias("refund_type_code"), "refund_type_name",
                    F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_type_name",
                    "refund_reason_txt", "refund_num", "refund_amount", "ts_ms")


# ------------------------------------------------------------------ J5

@register("refund_payment_fact", with_views(f"""
select cast(rp.id as {S}) as id, cast(o.user_id as {S}) as user_id, cast(rp.order_id as {S}) as order_id,
  cast(rp.sku_id as {S}) as sku_id, cast(o.province_id as {S}) as province_id,
  rp.payment_type as payment_type_code, dic.dic_name as payment_type_name,
  strftime(rp.callback_time, '%Y-%m-%d') as date_id, {_dt('rp.callback_time')} as callback_time,
  cast(r.refund_num as {S}) as refund_num, cast(rp.total_amount as {S}) as refund_amount,
  epoch_us(rp.callback_time) // 1000 as ts_ms
from v_refund_payment rp
join v_refund r on r.order_id = rp.order_id and r.sku_id = rp.sku_id
join v_order_info o on o.id = rp.order_id
join v_base_dic dic on dic.dic_code = rp.payment_type""",
    "v_refund_payment", "v_refund", "v_order_info", "v_base_dic"))
def refund_payment_fact(spark, sf):
    """Refund payment JOIN refund on (order, sku) JOIN order, dictionary lookup."""
    c = common.cdc(spark, sf)
    rp = routing.fact_source(c, "refund_payment", ["id", "order_id", "sku_id", "total_amount", "callback_time",
                                                   "payment_type"])
    r = routing.fact_source(c, "order_refund_info", ["order_id", "sku_id", "refund_num"], keep_ts=False)
    o = common.order_info(c).select(F.col("id").alias("order_id"), "user_id", "province_id")
    dic = common.base_dic(c).select(F.col("dic_code").alias("payment_type"),
                                    F.col("dic_name").alias("payment_type_name"))
    x = rp.join(r, ["order_id", "sku_id"]).join(o, "order_id").join(dic, "payment_type")
    return x.select("id", "user_id", "order_id", "sku_id", "province_id",
                    F.col("payment_type").alias("payment_type_code"), "payment_type_name",
                    reformat(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num",
                    F.col("total_amount").alias("refund_amount"), "ts_ms")


# ------------------------------------------------------------------ J6

@register("comment_fact", with_views(f"""
select cast(c.id as {S}) as id, cast(c.user_id as {S}) as user_id, cast(c.sku_id as {S}) as sku_id,
  c.appraise, d.dic_name as appraise_name, c.comment_txt, c.ts_ms as ts
from v_comment c join v_base_dic d on d.dic_code = c.appraise""", "v_comment", "v_base_dic"))
def comment_fact(spark, sf):
    """Comments JOIN the dictionary (lookup, inner: unknown codes drop)."""
    c = common.cdc(spark, sf)
    com = routing.fact_source(c, "comment_info", ["id", "user_id", "sku_id", "appraise", "comment_txt"])
    dic = common.base_dic(c).select("dic_code", F.col("dic_name").alias("appraise_name"))
    return joins.lookup(com, dic, "appraise", "dic_code", "id").select("id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt",
                                            F.col("ts_ms").alias("ts"))


@register("comment_fact_as_of", with_views(f"""
select cast(c.id as {S}) as id, cast(c.user_id as {S}) as user_id, c.appraise, d.dic_name as appraise_name, c.ts_ms as ts
from v_comment c join (select *, lead(ts_ms) over (partition by dic_code order by ts_ms) as until_ms from v_dic_version) d
  on d.dic_code = c.appraise and c.ts_ms >= d.ts_ms and (d.until_ms is null or c.ts_ms < d.until_ms) and not d.deleted""",
    "v_comment", "v_dic_version"))
def comment_fact_as_of(spark, sf):
    """Comments JOIN the dictionary as it was at the comment's time, so a retry gives the same rows."""
    com = routing.fact_source(common.cdc(spark, sf), "comment_info", ["id", "user_id", "appraise"])
    versions = standins.dic_versions(spark, sf).withColumnsRenamed({"dic_code": "appraise", "dic_name": "appraise_name"})
    out = as_of_join(com, versions, ["appraise"], deleted="deleted")
    return out.select("id", "user_id", "appraise", "appraise_name", F.col("ts_ms").alias("ts"))


# ------------------------------------------------------------------ K3

@register("upsert_latest", with_views(f"""
select cast(id as {S}) as id, cast(sku_num as {S}) as sku_num, cast(split_total_amount as {S}) as split_total_amount,
  epoch_us(create_time) // 1000 + seq as ts_ms, cast(n as bigint) as versions
from v_order_detail_latest""", "v_order_detail_latest"))
def upsert_latest(spark, sf):
    """K3: the upsert table of order details: last version per id wins."""
    c = common.cdc(spark, sf)
    v = common.detail_versions(c)
    agg = v.groupBy("id").agg(
        F.max_by(F.struct("sku_num", "split_total_amount", "ts_ms"), F.col("ts_ms")).alias("r"),
        F.count(F.lit(1)).alias("versions"))
    return agg.select("id", "r.sku_num", "r.split_total_amount", "r.ts_ms", "versions")
