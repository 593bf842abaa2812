"""DWS window aggregates and the state markers they build on."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions.scalars import ms_to_ts
from emporia.operators import joins, routing, state, text, windows
from emporia.plans import common
from emporia.plans.oracle_views import with_views
from emporia.plans.registry import register
from emporia.sources import standins

D = "decimal(16,2)"


def _win_sql(size: str, ts: str = "ts_ms") -> str:
    return f"time_bucket(interval '{size}', make_timestamp({ts} * 1000))"


def _stamp_sql(ws: str, size: str) -> str:
    return (f"strftime({ws}, '%Y-%m-%d %H:%M:%S') as stt, "
            f"strftime({ws} + interval '{size}', '%Y-%m-%d %H:%M:%S') as edt, "
            f"strftime({ws}, '%Y-%m-%d') as cur_date")


def _detail_versions_typed(spark, sf, with_province: bool = False):
    """Order-detail versions from the change log with typed amounts (and the
    order's province, which costs a join on the order id, only when asked)."""
    c = common.cdc(spark, sf)
    v = common.detail_versions(c)
    if with_province:
        info = common.order_info(c).select(F.col("id").alias("order_id"), "province_id")
        v = v.join(info, "order_id")
    else:
        v = v.withColumn("province_id", F.lit(None).cast("string"))
    return v.select(
        "id", "key", "order_id", "province_id", "sku_id", "ts_ms",
        F.col("split_total_amount").cast(D).alias("split_total_amount"),
        F.col("split_activity_amount").cast("decimal(18,4)").alias("split_activity_amount"),
        F.col("split_coupon_amount").cast("decimal(18,4)").alias("split_coupon_amount"),
        (F.col("sku_num").cast(D) * F.col("order_price").cast(D)).cast("decimal(20,2)").alias("split_original_amount"))


VERSIONS_SQL = """
  select d.*, o.province_id, epoch_us(d.create_time) // 1000 + d.seq as ts_ms,
    cast(cast(d.sku_num as decimal(16,2)) * d.order_price as decimal(20,2)) as split_original_amount
  from v_order_detail d join v_order_info o on d.order_id = o.id"""

DETAIL_VERSIONS_SQL = """
  select d.*, epoch_us(d.create_time) // 1000 + d.seq as ts_ms,
    cast(cast(d.sku_num as decimal(16,2)) * d.order_price as decimal(20,2)) as split_original_amount
  from v_order_detail d"""


# ------------------------------------------------------------------ F5

@register("dedup_retract", with_views(f"""
with v as ({DETAIL_VERSIONS_SQL})
select cast(id as varchar) as id, ts_ms, cast(split_total_amount as double) as split_total_amount,
  false as is_retraction from v
union all
select cast(id as varchar), ts_ms, cast(-split_total_amount as double), true from v where seq < n""",
    "v_order_detail", "v_order_info"))
def dedup_retract(spark, sf):
    """every detail version, plus each superseded version negated."""
    v = _detail_versions_typed(spark, sf).select("id", "ts_ms", "split_total_amount")
    out = state.dedup_retract(v, "id", ["split_total_amount"], "ts_ms")
    return out.select("id", "ts_ms", F.col("split_total_amount").cast("double").alias("split_total_amount"),
                      "is_retraction")


# ------------------------------------------------------------------ A2 (+ F5, J7)

@register("province_order_window", with_views(f"""
with v as ({VERSIONS_SQL}),
w as (select {_win_sql('10 seconds')} as ws, province_id,
        sum(case when seq = n then split_total_amount else 0 end) as amt, count(distinct order_id) as n_orders
      from v group by 1, 2)
select {_stamp_sql('ws', '10 seconds')}, cast(w.province_id as varchar) as province_id, p.province_name,
  cast(amt as double) as order_amount, cast(n_orders as bigint) as order_count
from w left join v_province p on p.province_id = w.province_id""", "v_order_detail", "v_order_info", "v_province"))
def province_order_window(spark, sf):
    """A2: F5 over detail versions, 10 s windows by province: amount (with
    retractions) and distinct orders, then the province name (J7, left)."""
    v = _detail_versions_typed(spark, sf, with_province=True).select("id", "order_id", "province_id", "ts_ms",
                                                                     "split_total_amount")
    d = state.dedup_retract(v, "id", ["split_total_amount"], "ts_ms")
    agg = (d.groupBy(F.window(ms_to_ts("ts_ms"), "10 seconds").alias("window"), "province_id")
           .agg(F.sum("split_total_amount").alias("amt"), F.countDistinct("order_id").alias("order_count")))
    prov = standins.province(spark, sf).select(F.col("province_id").cast("string").alias("province_id"),
                                               "province_name")
    out = joins.enrich(windows.stamp_window(agg), prov, "province_id")
    return out.select(*windows.WINDOW_COLS, "province_id", "province_name",
                      F.col("amt").cast("double").alias("order_amount"), "order_count")


# ------------------------------------------------------------------ A3 (+ F5, J8)

def sku_dims(spark, sf):
    """The six dimension tables of the sku chain, derived from the part catalogue."""
    from emporia.plans.ods import category_tables
    p = standins.table(spark, sf, "part")
    tm_id = F.regexp_extract("p_brand", "([0-9]+)", 1)
    sku = p.select(F.col("p_partkey").cast("string").alias("sku_id"), F.col("p_name").alias("sku_name"),
                   (F.col("p_partkey") % 50).cast("string").alias("spu_id"), tm_id.alias("tm_id"),
                   F.col("p_type").alias("category3_id"))
    spu = sku.select("spu_id").distinct().select("spu_id", F.concat(F.lit("spu-"), "spu_id").alias("spu_name"))
    tm = p.select(tm_id.alias("tm_id"), F.col("p_brand").alias("tm_name")).distinct()
    c3, c2, c1 = category_tables(spark, sf)
    return sku, spu, tm, c3, c2, c1


def enrich_sku_chain(df, spark, sf):
    """Sku -> spu -> trademark -> category3 -> category2 -> category1, each
    a left enrichment (a missing level leaves its columns null)."""
    return joins.enrich(df, sku_chain(spark, sf), "sku_id")


def sku_chain(spark, sf):
    """The six dimension tables flattened to one row per sku, so facts are joined once."""
    sku, spu, tm, c3, c2, c1 = sku_dims(spark, sf)
    x = joins.enrich(sku, spu, "spu_id")
    x = joins.enrich(x, tm, "tm_id")
    x = joins.enrich(x, c3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"),
                                  "category2_id"), "category3_id")
    x = joins.enrich(x, c2.select(F.col("id").alias("category2_id"), F.col("name").alias("category2_name"),
                                  "category1_id"), "category2_id")
    return joins.enrich(x, c1.select(F.col("id").alias("category1_id"), F.col("name").alias("category1_name")),
                        "category1_id")


SKU_CHAIN_SQL = """
  left join (select p_partkey, p_name as sku_name, p_partkey % 50 as spu_id, p_brand as tm_name, p_type as c3
             from part) s on s.p_partkey = cast(x.sku_id as bigint)
  left join (select distinct p_type as c3id, lower(p_type) as c3name, length(p_type) as c2 from part) k3
    on k3.c3id = s.c3"""

SKU_CHAIN_COLS = """s.sku_name, cast(s.spu_id as varchar) as spu_id, 'spu-' || cast(s.spu_id as varchar) as spu_name,
  s.tm_name, s.c3 as category3_id, k3.c3name as category3_name, k3.c2 as category2_id,
  'c2-' || cast(k3.c2 as varchar) as category2_name, k3.c2 % 2 as category1_id,
  'c1-' || cast(k3.c2 % 2 as varchar) as category1_name"""


@register("sku_order_window", with_views(f"""
with v as ({DETAIL_VERSIONS_SQL}),
x as (select {_win_sql('5 seconds')} as ws, cast(sku_id as varchar) as sku_id,
        sum(case when seq = n then split_original_amount else 0 end) as original_amount,
        sum(case when seq = n then split_activity_amount else 0 end) as activity_amount,
        sum(case when seq = n then split_coupon_amount else 0 end) as coupon_amount,
        sum(case when seq = n then split_total_amount else 0 end) as order_amount
      from v group by 1, 2)
select {_stamp_sql('ws', '5 seconds')}, x.sku_id, {SKU_CHAIN_COLS},
  cast(original_amount as double) as original_amount,
  cast(activity_amount as double) as activity_reduce_amount,
  cast(coupon_amount as double) as coupon_reduce_amount,
  cast(order_amount as double) as order_amount
from x {SKU_CHAIN_SQL}""", "v_order_detail", "v_order_info"))
def sku_order_window(spark, sf):
    """A3: F5 over detail versions, 5 s windows by sku: four amount sums, then J8."""
    v = _detail_versions_typed(spark, sf)
    m = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
    # by the record key, by which the log is dealt
    d = state.dedup_retract(v.where(F.col("id").isNotNull()).select("key", "sku_id", "ts_ms", *m), "key", m, "ts_ms")
    agg = (d.groupBy(F.window(ms_to_ts("ts_ms"), "5 seconds").alias("window"), "sku_id")
           .agg(*[F.sum(c).alias(c) for c in m]))
    out = windows.stamp_window(enrich_sku_chain(agg, spark, sf))  # the stamps are longer than the window
    return out.select(*windows.WINDOW_COLS, "sku_id", "sku_name", "spu_id", "spu_name", "tm_name",
                      "category3_id", "category3_name", "category2_id", "category2_name", "category1_id",
                      "category1_name",
                      F.col("split_original_amount").cast("double").alias("original_amount"),
                      F.col("split_activity_amount").cast("double").alias("activity_reduce_amount"),
                      F.col("split_coupon_amount").cast("double").alias("coupon_reduce_amount"),
                      F.col("split_total_amount").cast("double").alias("order_amount"))


@register("sku_dim_chain", with_views(f"""
select cast(x.id as varchar) as id, x.sku_id, {SKU_CHAIN_COLS}
from (select id, cast(sku_id as varchar) as sku_id from v_order_detail_latest) x {SKU_CHAIN_SQL}""",
    "v_order_detail_latest"))
def sku_dim_chain(spark, sf):
    """J8 on the order details: six chained left enrichments."""
    det = common.detail_latest(common.cdc(spark, sf)).select("id", "sku_id")
    out = enrich_sku_chain(det, spark, sf)
    return out.select("id", "sku_id", "sku_name", "spu_id", "spu_name", "tm_name", "category3_id", "category3_name",
                      "category2_id", "category2_name", "category1_id", "category1_name")


@register("province_enrich", with_views("""
select cast(o.id as varchar) as order_id, cast(o.province_id as varchar) as province_id, p.province_name,
  p.region_id
from v_order_info o left join (select * from v_province where province_id % 10 <> 9) p
  on p.province_id = o.province_id""", "v_order_info", "v_province"))
def province_enrich(spark, sf):
    """Orders enriched from the province dimension as the dimension sink
    holds it (deleted provinces are gone, their orders keep null names)."""
    c = common.cdc(spark, sf)
    rows = c.where(routing.table_col(c) == "base_province").select(
        F.coalesce(F.col("after"), F.col("before")).alias("data"), "op", "ts_ms")
    rows = rows.select(F.col("data")["province_id"].alias("province_id"), "data", "op", "ts_ms")
    prov = routing.latest_by_key(rows, "province_id", "ts_ms").where(F.col("op") != "d")
    prov = prov.select("province_id", F.col("data")["province_name"].alias("province_name"),
                       F.col("data")["region_id"].cast("int").alias("region_id"))
    orders = common.order_info(c).select(F.col("id").alias("order_id"), "province_id")
    return joins.enrich(orders, prov, "province_id").select("order_id", "province_id", "province_name", "region_id")


# ------------------------------------------------------------------ A4 / F3

CART_SQL = """select cast(event_id as varchar) as id, cast(user_id as varchar) as user_id,
  epoch_us(ts) // 1000 as ts_ms, cast(ts as date) as d from v_detail_event"""


def _cart_firsts(spark, sf):
    c = common.cdc(spark, sf)
    cart = routing.fact_source(c, "cart_info", ["id", "user_id"], ops=["c", "r"]).drop("op")
    return state.first_of_day(cart.withColumn("_id", F.col("id").cast("bigint")), "user_id", "ts_ms", "_id")


@register("cart_first_of_day", with_views(f"""
with c as ({CART_SQL})
select id, user_id, ts_ms from (
  select *, row_number() over (partition by user_id, d order by ts_ms, cast(id as bigint)) as rn from c) t
where rn = 1""", "v_detail_event"))
def cart_first_of_day(spark, sf):
    """each user's first cart add of the day."""
    return _cart_firsts(spark, sf).select("id", "user_id", "ts_ms")


@register("cart_uu_window", with_views(f"""
with c as ({CART_SQL}),
f as (select * from (select *, row_number() over (partition by user_id, d order by ts_ms, cast(id as bigint)) as rn
                     from c) t where rn = 1)
select {_stamp_sql(_win_sql('10 seconds'), '10 seconds')}, cast(count(*) as bigint) as cart_add_uu_ct
from f group by {_win_sql('10 seconds')}""", "v_detail_event"))
def cart_uu_window(spark, sf):
    """A4: first cart adds of the day per 10 s window (global)."""
    f = _cart_firsts(spark, sf)
    agg = f.groupBy(F.window(ms_to_ts("ts_ms"), "10 seconds").alias("window")).agg(
        F.count(F.lit(1)).alias("cart_add_uu_ct"))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, "cart_add_uu_ct")


# ------------------------------------------------------------------ A5

@register("home_detail_uv_window", with_views(f"""
with p as (select *, cast(make_timestamp(ts_ms * 1000) as date) as d from v_page_log
           where not has_start and page_id in ('home', 'good_detail')),
f as (select *, row_number() over (partition by mid, page_id, d order by ts_ms, event_id) as rn from p)
select {_stamp_sql(_win_sql('10 seconds'), '10 seconds')},
  cast(sum(case when page_id = 'home' then 1 else 0 end) as bigint) as home_uv_ct,
  cast(sum(case when page_id = 'good_detail' then 1 else 0 end) as bigint) as good_detail_uv_ct
from f where rn = 1 group by {_win_sql('10 seconds')}""", "v_page_log"))
def home_detail_uv_window(spark, sf):
    """A5: home and detail-page unique visitors per 10 s window (F4: one
    daily marker per device and page)."""
    page = standins.page_log(spark, sf).where(~F.col("has_start") & routing.home_or_detail())
    marked = state.mark_daily_unique(page.select("mid", "page_id", "ts_ms", "event_id"), ["mid", "page_id"],
                                     flag="uv")
    marked = marked.where(F.col("uv") == 1)
    agg = marked.groupBy(F.window(ms_to_ts("ts_ms"), "10 seconds").alias("window")).agg(
        F.sum(F.when(F.col("page_id") == "home", 1).otherwise(0)).cast("bigint").alias("home_uv_ct"),
        F.sum(F.when(F.col("page_id") == "good_detail", 1).otherwise(0)).cast("bigint").alias("good_detail_uv_ct"))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, "home_uv_ct", "good_detail_uv_ct")


# ------------------------------------------------------------------ A6 / F6

def _login_sql(src: str) -> str:
    return f"""
with l as (select *, cast(make_timestamp(ts_ms * 1000) as date) as d from ({src}) s),
dd as (select uid, d, min(ts_ms) as first_ms from l group by uid, d),
firsts as (select l.* from l join (select uid, d, arg_min(event_id, ts_ms * 1000000 + event_id) as fe
                                   from l group by uid, d) x on x.uid = l.uid and x.fe = l.event_id),
prev as (select uid, d, lag(d) over (partition by uid order by d) as pd from dd)
select f.uid, f.event_id, f.ts_ms, cast(1 as bigint) as uu_ct,
  cast(case when p.pd is not null and f.d - p.pd >= 8 then 1 else 0 end as bigint) as back_ct
from firsts f join prev p on p.uid = f.uid and p.d = f.d"""


LOGIN_SRC = """select cast(user_id as varchar) as uid, event_id, epoch_us(ts) // 1000 as ts_ms from v_login"""


@register("login_return", with_views(_login_sql(LOGIN_SRC), "v_login"))
def login_return(spark, sf):
    """first login of the day (``uu_ct``) and 8-day returns (``back_ct``)."""
    lg = standins.login(spark, sf).select(F.col("user_id").cast("string").alias("uid"), "event_id",
                                          F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))
    m = state.mark_login(lg, "uid")
    return m.where((F.col("uu_ct") == 1) | (F.col("back_ct") == 1)).select("uid", "event_id", "ts_ms", "uu_ct",
                                                                           "back_ct")


PAGE_LOGIN_SRC = """select uid, event_id, ts_ms from v_page_log
  where not has_start and uid is not null and uid <> ''
    and (last_page_id = 'login' or last_page_id is null or last_page_id = '')"""


@register("login_events", with_views(PAGE_LOGIN_SRC, "v_page_log"))
def login_events(spark, sf):
    """P10: page records that are logins."""
    p = standins.page_log(spark, sf).where(~F.col("has_start") & routing.is_login())
    return p.select("uid", "event_id", "ts_ms")


@register("user_login_window", with_views(f"""
with m as ({_login_sql(PAGE_LOGIN_SRC)})
select {_stamp_sql(_win_sql('10 seconds'), '10 seconds')}, cast(sum(back_ct) as bigint) as back_ct,
  cast(sum(uu_ct) as bigint) as uu_ct
from m group by {_win_sql('10 seconds')}""", "v_page_log"))
def user_login_window(spark, sf):
    """Unique and returning login users per 10 s window (P10 + F6)."""
    p = standins.page_log(spark, sf).where(~F.col("has_start") & routing.is_login())
    m = state.mark_login(p.select("uid", "event_id", "ts_ms"), "uid")
    m = m.where((F.col("uu_ct") == 1) | (F.col("back_ct") == 1))
    agg = m.groupBy(F.window(ms_to_ts("ts_ms"), "10 seconds").alias("window")).agg(
        F.sum("back_ct").alias("back_ct"), F.sum("uu_ct").alias("uu_ct"))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, "back_ct", "uu_ct")


# ------------------------------------------------------------------ A7

@register("keyword_window", with_views(f"""
with s as (select ts_ms, unnest(regexp_split_to_array(lower(item), '[^\\p{{L}}\\p{{N}}]+')) as keyword
           from v_page_log where not has_start and last_page_id = 'search' and item_type = 'keyword'
             and item is not null)
select {_stamp_sql(_win_sql('1 second'), '1 second')}, keyword, cast(count(*) as bigint) as keyword_count
from s where keyword <> '' group by {_win_sql('1 second')}, keyword""", "v_page_log"))
def keyword_window(spark, sf):
    """Search keywords (P11 + T1) counted per 1 s window."""
    p = standins.page_log(spark, sf).where(~F.col("has_start") & routing.is_search())
    kw = text.explode_tokens(p.select("ts_ms", "item"), "item", "keyword")
    agg = kw.groupBy(F.window(ms_to_ts("ts_ms"), "1 second").alias("window"), "keyword").agg(
        F.count(F.lit(1)).alias("keyword_count"))
    return windows.stamp_window(agg).select(*windows.WINDOW_COLS, "keyword", "keyword_count")


# ------------------------------------------------------------------ A8 / A9 / F8

DEVICE_SQL = """select case when uid is null or uid = '' then 'home' else uid end as uid, ar, ba, ch, md,
  split_part(os, ' ', 1) as os, case when item_type = 'keyword' then item end as search_item, ts_ms, event_id
from v_page_log"""


@register("device_search", with_views(f"select uid, ar, ba, ch, md, os, search_item, ts_ms from ({DEVICE_SQL}) t",
                                      "v_page_log"))
def device_search(spark, sf):
    """Device and search projection of the page log."""
    return routing.device_search(standins.page_log(spark, sf))


PAYLOAD = ["os", "ch", "md", "ba", "search_item"]


@register("dedup_payload", with_views(f"""
select uid, os, ch, md, ba, search_item, ts_ms, event_id from (
  select *, row_number() over (partition by uid, os, ch, md, ba, search_item order by ts_ms, event_id) as rn
  from ({DEVICE_SQL}) t) x where rn = 1""", "v_page_log"))
def dedup_payload(spark, sf):
    """F8: exact-payload de-duplication per user (time is not part of the payload); the first arrival stays."""
    d = routing.device_search(standins.page_log(spark, sf), keep=("event_id",))
    return state.dedup_payload(d, "uid", PAYLOAD, ["ts_ms", "event_id"]).select("uid", *PAYLOAD, "ts_ms", "event_id")


def _set_sql(c: str) -> str:
    return f"coalesce(string_agg(distinct {c}, ',' order by {c}), '') as {c}"


@register("user_device_running", with_views(f"""
with d as (select distinct uid, os, ch, md, ba, search_item from ({DEVICE_SQL}) t)
select uid, cast(count(*) as bigint) as pv, {_set_sql('os')}, {_set_sql('ch')}, {_set_sql('md')}, {_set_sql('ba')},
  {_set_sql('search_item')}
from d group by uid""", "v_page_log"))
def user_device_running(spark, sf):
    """Per user, the running state after all records: distinct payloads
    seen (F8 first) and the sorted, comma-joined sets of each device field."""
    d = state.dedup_payload(routing.device_search(standins.page_log(spark, sf)), "uid", PAYLOAD)
    return text.running_sets(d, "uid", PAYLOAD)


def _cum_sql(f: str) -> str:
    return (f"(select coalesce(string_agg(v, ',' order by v), '') from (select uid, {f} as v, min(w) as fw "
            f"from dd where {f} is not null group by uid, {f}) s where s.uid = wins.uid and s.fw <= wins.w) as {f}")


@register("user_device_last", with_views(f"""
with dd as (select *, {_win_sql('2 minutes')} as w from ({DEVICE_SQL}) t),
wins as (select distinct uid, w from dd),
pay as (select uid, min(w) as fw from dd group by uid, os, ch, md, ba, search_item)
select wins.uid, {_stamp_sql('wins.w', '2 minutes')},
  (select cast(count(*) as bigint) from pay p where p.uid = wins.uid and p.fw <= wins.w) as pv,
  {", ".join(_cum_sql(f) for f in PAYLOAD)}
from wins""", "v_page_log"))
def user_device_last(spark, sf):
    """A9 over A8: per user and 2-minute window, the running device state
    (distinct payloads, sorted value sets) as it stands after the window's
    last record -- the batch form of keeping the last running state in a
    processing-time window (event time stands in for arrival time)."""
    d = routing.device_search(standins.page_log(spark, sf))
    return windows.running_state_per_window(d, "uid", "ts_ms", "2 minutes", PAYLOAD)


# ------------------------------------------------------------------ F7 / F9

@register("keep_newer", with_views("""
select order_id, id, create_ms from (
  select cast(order_id as varchar) as order_id, cast(id as varchar) as id, epoch_us(create_time) // 1000 as create_ms,
    max(epoch_us(create_time) // 1000) over (partition by order_id order by id, seq
      rows between unbounded preceding and 1 preceding) as seen
  from v_order_detail) t where seen is null or create_ms > seen""", "v_order_detail"))
def keep_newer(spark, sf):
    """per order, detail records whose create time is later than that of every record that
    arrived before; details arrive in line order (id, then version)."""
    v = common.detail_versions(common.cdc(spark, sf)).where(routing.has_key("order_id"))
    v = v.select("order_id", "id", common.ms_of("create_time").alias("create_ms"),
                 F.col("id").cast("bigint").alias("_line"), F.col("ts_ms").alias("_version"))
    return state.keep_newer(v, "order_id", "create_ms", ["_line", "_version"]).select("order_id", "id", "create_ms")


@register("dedup_order_ts", with_views("""
select cast(order_id as varchar) as order_id, ts_ms, cast(id as varchar) as id, cast(0 as bigint) as arrival
from v_comment""", "v_comment"))
def dedup_order_ts(spark, sf):
    """comments re-delivered (every seventh twice) de-duplicated exactly on
    ``order_id_ts_ms``; the first arrival stays."""
    c = common.cdc(spark, sf)
    com = routing.fact_source(c, "comment_info", ["id", "order_id"]).withColumn("arrival", F.lit(0).cast("bigint"))
    again = com.where(F.col("id").cast("bigint") % 7 == 0).withColumn("arrival", F.lit(1).cast("bigint"))
    out = state.dedup_exact(com.unionByName(again), ["order_id", "ts_ms"], ["arrival", "id"])
    return out.select("order_id", "ts_ms", "id", "arrival")
