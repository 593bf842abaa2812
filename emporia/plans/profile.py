"""User-profile labels: projections, interval joins, look-ups and scores
(P13-P16, H5-H9, J12-J14, J17, J18, M1-M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions import scalars as H
from emporia.operators import joins, routing, scoring
from emporia.plans import common
from emporia.plans.oracle_views import with_views
from emporia.plans.registry import register
from emporia.sources import standins

AS_OF = "2025-05-13"  # the day ages are computed on (a parameter, not the wall clock)
DAY_MS = 24 * 3600 * 1000

# Stand-in catalogue names (test data only, not model values): the level-1
# category of each part type, the search category each level-1 category
# compares to, and shop names for the first trademark numbers.
LEVEL1_OF_TYPE = {"ECONOMY": "数码", "LARGE": "家用电器", "MEDIUM": "服饰内衣", "PROMO": "母婴",
                  "SMALL": "个护化妆", "STANDARD": "图书、音像、电子书刊"}
SEARCH_CATEGORY = {"数码": "科技与数码", "家用电器": "家庭与育儿", "服饰内衣": "时尚与潮流", "母婴": "家庭与育儿",
                   "个护化妆": "健康与养生", "图书、音像、电子书刊": "学习与发展"}
BRAND_NAMES = {"1": "TCL", "2": "苹果", "3": "联想", "4": "小米", "5": "欧莱雅", "6": "香奈儿"}


def _map_col(d: dict, col) -> F.Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), col)


def _case_sql(d: dict, expr: str, default: str = "null") -> str:
    whens = " ".join(f"when {expr} = '{k}' then '{v}'" for k, v in d.items())
    return f"case {whens} else {default} end"


def sku_catalog(spark, sf):
    """sku -> (category3 id, trademark name, level-1 category); S6 + J17 dimension rows."""
    p = standins.table(spark, sf, "part")
    tm_no = F.regexp_extract("p_brand", "([0-9]+)", 1)
    return p.select(F.col("p_partkey").cast("string").alias("sku_id"), F.col("p_type").alias("c3id"),
                    F.coalesce(_map_col(BRAND_NAMES, tm_no), F.col("p_brand")).alias("tname"),
                    _map_col(LEVEL1_OF_TYPE, F.col("p_type")).alias("b1_name"))


SKU_CATALOG_SQL = f"""select cast(p_partkey as varchar) as sku_id, p_type as c3id,
  coalesce({_case_sql(BRAND_NAMES, "regexp_extract(p_brand, '([0-9]+)', 1)")}, p_brand) as tname,
  {_case_sql(LEVEL1_OF_TYPE, 'p_type')} as b1_name from part"""


def search_category_dim(spark, sf):
    """The level-1 category -> search category comparison list, read from the catalogue."""
    names = standins.table(spark, sf, "part").select(_map_col(LEVEL1_OF_TYPE, F.col("p_type")).alias("category_name"))
    return names.where(F.col("category_name").isNotNull()).distinct().withColumn(
        "search_category", _map_col(SEARCH_CATEGORY, F.col("category_name")))


# ------------------------------------------------------------------ weights in SQL

def _weights_sql() -> str:
    rows = []
    for s, v, *w in scoring.WEIGHTS:
        ws = ", ".join(f"cast({x} as decimal(4,2))" for x in w)
        rows.append(f"('{s}', '{v}', {ws})")
    cols = ", ".join(f"w_{b}" for b in scoring.BANDS)
    return f"(select * from (values {', '.join(rows)}) t(score, value, {cols}))"


def _score_sql(name: str, value_expr: str, alias: str, prefix: str | None = None) -> tuple[str, str]:
    """(join clause, select list) scoring ``value_expr`` like :func:`scoring.score`."""
    prefix = prefix or name
    coef = scoring.COEFFICIENTS[name]
    known = ", ".join(f"'{v}'" for s, v, *_ in scoring.WEIGHTS if s == name)
    val = value_expr
    if name in scoring.WITH_DEFAULT:
        val = f"case when {value_expr} is null then null when {value_expr} in ({known}) then {value_expr} else 'other' end"
    join = f"left join {_weights_sql()} {alias} on {alias}.score = '{name}' and {alias}.value = {val}"
    cols = []
    for b in scoring.BANDS:
        e = f"round({alias}.w_{b} * cast({coef} as decimal(4,2)), 3)"
        if name == "search":
            e = f"coalesce({e}, 0)"
        cols.append(f"cast({e} as double) as {prefix}_{b}")
    return join, ", ".join(cols)


# ------------------------------------------------------------------ P13 / H5-H9 / J13

def _user_sql() -> str:
    b = "(date '1970-01-01' + cast(birthday_epoch_day as integer))"
    md = lambda x: f"(month({x}) * 100 + day({x}))"
    starts = scoring_zodiac_sql(md(b))
    return f"""select cast(uid as varchar) as uid, uname, coalesce(gender, 'home') as gender,
  strftime({b}, '%Y-%m-%d') as birthday,
  cast(year(date '{AS_OF}') - year({b}) - case when {md(f"date '{AS_OF}'")} < {md(b)} then 1 else 0 end as integer) as age,
  cast(floor(year({b}) / 10) * 10 as integer) as decade, {starts} as constellation, ts_ms from v_user"""


def scoring_zodiac_sql(md: str) -> str:
    z = H.ZODIAC_STARTS
    parts = [f"when {md} < {z[0][0]} then '摩羯座'"]
    for (lo, name), (hi, _) in zip(z, z[1:] + [(1232, None)]):
        parts.append(f"when {md} >= {lo} and {md} < {hi} then '{name}'")
    return "case " + " ".join(parts) + " end"


def _slot_sql(ts: str) -> str:
    parts = " ".join(f"when hour({ts}) < {end} then '{name}'" for end, name in H.TIME_SLOTS)
    return f"case {parts} end"


def _users(spark, sf):
    u = routing.user_base(standins.user(spark, sf), AS_OF)
    return u.withColumn("uid", F.col("uid").cast("string"))


@register("user_base", with_views(_user_sql(), "v_user"))
def user_base(spark, sf):
    """User projection with gender default and birthday-derived fields."""
    return _users(spark, sf)


@register("scalar_profile", with_views(f"""
select cast(uid as varchar) as uid, strftime(date '1970-01-01' + cast(birthday_epoch_day as integer), '%Y-%m-%d') as birthday,
  {_slot_sql('make_timestamp(ts_ms * 1000)')} as time_slot, md5(cast(uid as varchar)) as row_key
from v_user""", "v_user"))
def scalar_profile(spark, sf):
    """Epoch day -> date, slot of the day, MD5 row key (H6-H8 are in user_base)."""
    u = standins.user(spark, sf)
    return u.select(F.col("uid").cast("string").alias("uid"),
                    F.date_format(H.epoch_day_to_date(F.col("birthday_epoch_day")), "yyyy-MM-dd").alias("birthday"),
                    H.time_slot(H.ms_to_ts(F.col("ts_ms"))).alias("time_slot"),
                    H.md5_key(F.col("uid")).alias("row_key"))


USER_SUP_SQL = f"""
with u as ({_user_sql()}),
s as (select cast(uid as varchar) as uid, cast(height as varchar) || unit_height as height,
        cast(weight as varchar) || unit_weight as weight, ts_ms from v_user_sup)
select u.uid, u.uname, u.gender, u.birthday, u.age, u.decade, u.constellation, s.height, s.weight, u.ts_ms
from u join s on s.uid = u.uid and s.ts_ms between u.ts_ms - 300000 and u.ts_ms + 300000"""


def _user_labels(spark, sf):
    u = _users(spark, sf)
    s = routing.user_sup(standins.user_sup(spark, sf)).withColumn("uid", F.col("uid").cast("string"))
    s = s.withColumnRenamed("ts_ms", "sup_ts_ms")
    return joins.interval_join(u, s, "uid", "ts_ms", "sup_ts_ms", -5 * 60 * 1000, 5 * 60 * 1000).drop("sup_ts_ms")


@register("user_sup_interval", with_views(USER_SUP_SQL, "v_user", "v_user_sup"))
def user_sup_interval(spark, sf):
    """User base JOIN supplement (height, weight) within +-5 min."""
    return _user_labels(spark, sf).select("uid", "uname", "gender", "birthday", "age", "decade", "constellation",
                                          "height", "weight", "ts_ms")


# ------------------------------------------------------------------ P16 / J12 / J17

def _orders(c):
    o = common.order_info(c).withColumn("ts_ms", common.ms_of("create_time"))
    return routing.order_base(o).withColumn("total_amount", F.col("total_amount").cast("decimal(16,2)"))


ORDER_SQL = f"""select cast(id as varchar) as id, cast(user_id as varchar) as user_id, total_amount,
  strftime(create_time, '%Y-%m-%d %H:%M:%S') as create_time, {_slot_sql('create_time')} as pay_time_slot,
  epoch_us(create_time) // 1000 as ts_ms from v_order_info"""


@register("order_base", with_views(f"""
select id, user_id, cast(total_amount as double) as total_amount, create_time, pay_time_slot, ts_ms
from ({ORDER_SQL}) o""", "v_order_info"))
def order_base(spark, sf):
    """Order projection with the pay-time slot."""
    o = _orders(common.cdc(spark, sf))
    return o.select("id", "user_id", F.col("total_amount").cast("double").alias("total_amount"), "create_time",
                    "pay_time_slot", "ts_ms")


@register("order_detail_interval", with_views(f"""
with o as ({ORDER_SQL})
select o.id as order_id, cast(d.id as varchar) as detail_id, cast(d.sku_id as varchar) as sku_id, o.user_id,
  cast(o.total_amount as double) as total_amount, cast(d.split_total_amount as varchar) as split_total_amount,
  cast(d.split_coupon_amount as varchar) as split_coupon_amount, o.pay_time_slot, o.ts_ms
from o join v_order_detail_latest d on cast(d.order_id as varchar) = o.id
  and epoch_us(d.create_time) // 1000 between o.ts_ms - 120000 and o.ts_ms + 120000""",
    "v_order_info", "v_order_detail_latest"))
def order_detail_interval(spark, sf):
    """Order JOIN its details created within +-2 min (coupon amount copied as is)."""
    c = common.cdc(spark, sf)
    o = _orders(c)
    d = routing.detail_base(common.detail_latest(c)).select(
        F.col("order_id").alias("id"), F.col("id").alias("detail_id"), F.col("sku_id").cast("string").alias("sku_id"),
        "split_total_amount", "split_coupon_amount", F.col("create_ms").alias("detail_ms"))
    x = joins.interval_join(o, d, "id", "ts_ms", "detail_ms", -120000, 120000)
    return x.select(F.col("id").alias("order_id"), "detail_id", "sku_id", "user_id",
                    F.col("total_amount").cast("double").alias("total_amount"), "split_total_amount",
                    "split_coupon_amount", "pay_time_slot", "ts_ms")


@register("order_dim_lookup", with_views(f"""
select cast(d.id as varchar) as id, cast(d.sku_id as varchar) as sku_id, k.p_type as c3id,
  coalesce({_case_sql(BRAND_NAMES, "regexp_extract(k.p_brand, '([0-9]+)', 1)")}, k.p_brand) as tname,
  'c1-' || cast(length(k.p_type) % 2 as varchar) as b1_name
from v_order_detail_latest d left join part k on k.p_partkey = d.sku_id""",
    "v_order_detail_latest"))
def order_dim_lookup(spark, sf):
    """Two look-ups, first match per key each: sku -> (category3, trademark) in the sku
    list, then category3 -> level-1 name in the flattened category list."""
    from emporia.operators.state import dedup_first
    from emporia.plans.ods import category_dim, category_tables

    det = common.detail_latest(common.cdc(spark, sf)).select("id", "sku_id")
    skus = sku_catalog(spark, sf).drop("b1_name")
    skus = dedup_first(skus, ["sku_id"], ["c3id", "tname"])
    names = dedup_first(category_dim(*category_tables(spark, sf)).select("c3id", F.col("c1name").alias("b1_name")),
                        ["c3id"], "b1_name")
    # The category list is joined to the sku list, not to the facts: one join on the fact side.
    return joins.enrich(det, joins.enrich(skus, names, "c3id"), "sku_id").select("id", "sku_id", "c3id", "tname",
                                                                                "b1_name")


# ------------------------------------------------------------------ J18 / M1 / M2

def _search_lookup(spark, sf):
    """Search word -> level-1 category (first part of that name) -> search category."""
    d = routing.device_search(standins.page_log(spark, sf), keep=("event_id",))
    p = standins.table(spark, sf, "part")
    by_name = p.groupBy(F.col("p_name").alias("search_item")).agg(F.min_by("p_type", "p_partkey").alias("p_type"))
    by_name = by_name.select("search_item", _map_col(LEVEL1_OF_TYPE, F.col("p_type")).alias("b1_category"))
    cmp = search_category_dim(spark, sf).withColumnRenamed("category_name", "b1_category")
    x = joins.enrich_sparse(d, by_name, "search_item", "event_id")
    return joins.enrich_sparse(x, cmp, "b1_category", "event_id")


SEARCH_SQL = f"""
with d as (select case when uid is null or uid = '' then 'home' else uid end as uid, split_part(os, ' ', 1) as os,
             case when item_type = 'keyword' then item end as search_item, ts_ms, event_id from v_page_log),
n as (select p_name as search_item, {_case_sql(LEVEL1_OF_TYPE, 'arg_min(p_type, p_partkey)')} as b1_category
      from part group by p_name)
select d.*, n.b1_category, {_case_sql(SEARCH_CATEGORY, 'n.b1_category')} as search_category
from d left join n on n.search_item = d.search_item"""


@register("search_dim_lookup", with_views(f"""
select uid, event_id, search_item, b1_category, search_category from ({SEARCH_SQL}) s where search_item is not null""",
    "v_page_log"))
def search_dim_lookup(spark, sf):
    """J18 on page records with a search item."""
    x = _search_lookup(spark, sf).where(F.col("search_item").isNotNull())
    return x.select("uid", "event_id", "search_item", "b1_category", "search_category")


_J, _C = _score_sql("device", "s.os", "wd")


@register("score_device", with_views(f"""
select s.uid, s.event_id, s.os, {_C} from ({SEARCH_SQL}) s {_J}""", "v_page_log"))
def score_device(spark, sf):
    """M1: device score per page record (iOS / Android; other systems unscored)."""
    d = routing.device_search(standins.page_log(spark, sf), keep=("event_id",))
    x = scoring.score(d, "device", F.col("os"))
    return x.select("uid", "event_id", "os", *[f"device_{b}" for b in scoring.BANDS])


_J2, _C2 = _score_sql("search", "s.search_category", "ws")


@register("score_search", with_views(f"""
select s.uid, s.event_id, s.search_category, {_C2} from ({SEARCH_SQL}) s {_J2}""", "v_page_log"))
def score_search(spark, sf):
    """M2: search score per page record (unknown or no category scores 0)."""
    x = scoring.score(_search_lookup(spark, sf), "search", F.col("search_category"))
    return x.select("uid", "event_id", "search_category", *[f"search_{b}" for b in scoring.BANDS])


# ------------------------------------------------------------------ M3-M6

_J3, _C3 = _score_sql("pay_time", "o.pay_time_slot", "wp")


@register("score_paytime", with_views(f"""
select o.id, o.pay_time_slot, {_C3} from ({ORDER_SQL}) o {_J3}""", "v_order_info"))
def score_paytime(spark, sf):
    """M3: pay-time score per order."""
    o = _orders(common.cdc(spark, sf))
    x = scoring.score(o, "pay_time", F.col("pay_time_slot"))
    return x.select("id", "pay_time_slot", *[f"pay_time_{b}" for b in scoring.BANDS])


_AMT = "case when o.total_amount < 1000 then 'lt_1000' when o.total_amount > 1000 and o.total_amount < 4000 " \
       "then '1000_4000' else 'other' end"
_J4, _C4 = _score_sql("amount", _AMT, "wa")


@register("score_amount", with_views(f"""
select o.id, cast(o.total_amount as double) as total_amount, {_C4} from ({ORDER_SQL}) o {_J4}""", "v_order_info"))
def score_amount(spark, sf):
    """M4: amount score per order (1000 itself falls in the last range)."""
    o = _orders(common.cdc(spark, sf))
    x = scoring.score(o, "amount", scoring.amount_band(F.coalesce(F.col("total_amount"), F.lit(0))))
    return x.select("id", F.col("total_amount").cast("double").alias("total_amount"),
                    *[f"amount_{b}" for b in scoring.BANDS])


DETAIL_CAT_SQL = f"""select cast(d.id as varchar) as id, k.tname, k.b1_name
  from v_order_detail_latest d left join ({SKU_CATALOG_SQL}) k on k.sku_id = cast(d.sku_id as varchar)"""


def _detail_catalog(spark, sf):
    det = common.detail_latest(common.cdc(spark, sf)).select("id", "sku_id")
    return joins.enrich(det, sku_catalog(spark, sf), "sku_id")


_J5, _C5 = _score_sql("brand", "o.tname", "wb")


@register("score_brand", with_views(f"""
select o.id, o.tname, {_C5} from ({DETAIL_CAT_SQL}) o {_J5}""", "v_order_detail_latest"))
def score_brand(spark, sf):
    """M5: brand score per order detail (unlisted brands use the default row)."""
    x = scoring.score(_detail_catalog(spark, sf), "brand", F.col("tname"))
    return x.select("id", "tname", *[f"brand_{b}" for b in scoring.BANDS])


_J6, _C6 = _score_sql("category", "o.b1_name", "wc")


@register("score_category", with_views(f"""
select o.id, o.b1_name, {_C6} from ({DETAIL_CAT_SQL}) o {_J6}""", "v_order_detail_latest"))
def score_category(spark, sf):
    """M6: level-1 category score per order detail."""
    x = scoring.score(_detail_catalog(spark, sf), "category", F.col("b1_name"))
    return x.select("id", "b1_name", *[f"category_{b}" for b in scoring.BANDS])


# ------------------------------------------------------------------ J14 / M7

def page_labels(spark, sf):
    """Page label per user and day: first (sorted) os and search item, device
    and search scores, and the label's time (latest record, Q16)."""
    s = _search_lookup(spark, sf).withColumn("page_day", H.ms_to_date(F.col("ts_ms")))
    lab = s.groupBy("uid", "page_day").agg(
        F.min("os").alias("os"), F.min_by("search_category", "search_item").alias("search_category"),
        F.max("ts_ms").alias("page_ts"))
    lab = scoring.score(lab, "device", F.col("os"))
    return scoring.score(lab, "search", F.col("search_category"))


def order_labels(spark, sf):
    """Order label per purchase record: pay-time, amount, brand and category scores."""
    # purchase records of the page log are the purchase events themselves
    e = standins.table(spark, sf, "events").where(F.col("event_type") == "purchase")
    o = e.select("event_id", F.col("user_id").cast("string").alias("uid"), "value",
                 F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))
    o = o.select(F.col("event_id").cast("string").alias("order_id"), "uid", F.col("ts_ms").alias("order_ts"),
                 (F.col("value").cast("decimal(10,2)") * 10).alias("total_amount"),
                 standins.item_key(spark, sf, F.col("event_id")).cast("string").alias("sku_id"),
                 H.time_slot(H.ms_to_ts(F.col("ts_ms"))).alias("pay_time_slot"))
    o = joins.enrich(o, sku_catalog(spark, sf), "sku_id")
    o = scoring.score(o, "pay_time", F.col("pay_time_slot"))
    o = scoring.score(o, "amount", scoring.amount_band(F.coalesce(F.col("total_amount"), F.lit(0))))
    o = scoring.score(o, "brand", F.col("tname"))
    return scoring.score(o, "category", F.col("b1_name"))


def profile_join(spark, sf):
    """Page label JOIN user label of the same user within +-24 h, JOIN order label within
    +-24 h of the page label; labels without a user id are dropped first (P12)."""
    orders = order_labels(spark, sf).where(routing.has_key("uid"))
    pages = page_labels(spark, sf).where(routing.has_key("uid"))
    users = _user_labels(spark, sf).where(routing.has_key("uid")).select(
        "uid", "age", "gender", F.col("ts_ms").alias("user_ts"))
    x = joins.interval_join(pages, users, "uid", "page_ts", "user_ts", -DAY_MS, DAY_MS)
    return joins.interval_join(orders, x, "uid", "order_ts", "page_ts", -DAY_MS, DAY_MS)


PROFILE_SQL = f"""
with s as ({SEARCH_SQL}),
pl as (select uid, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') as page_day, min(os) as os,
         arg_min_null(search_category, search_item) as search_category, max(ts_ms) as page_ts
       from s group by uid, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d')),
pages as (select s.*, {_score_sql('device', 's.os', 'wd')[1]}, {_score_sql('search', 's.search_category', 'ws')[1]}
          from pl s {_score_sql('device', 's.os', 'wd')[0]} {_score_sql('search', 's.search_category', 'ws')[0]}),
ob as (select cast(p.event_id as varchar) as order_id, p.uid, p.ts_ms as order_ts,
         cast(e.value as decimal(10,2)) * 10 as total_amount, cast(p.event_id % (select count(*) from part) as varchar) as sku_id,
         {_slot_sql('make_timestamp(p.ts_ms * 1000)')} as pay_time_slot
       from v_page_log p join events e on e.event_id = p.event_id where p.page_id = 'order'),
oc as (select ob.*, k.tname, k.b1_name from ob left join ({SKU_CATALOG_SQL}) k on k.sku_id = ob.sku_id),
orders as (select o.*, {_score_sql('pay_time', 'o.pay_time_slot', 'wp')[1]},
             {_score_sql('amount', _AMT, 'wa')[1]}, {_score_sql('brand', 'o.tname', 'wb')[1]},
             {_score_sql('category', 'o.b1_name', 'wc')[1]}
           from oc o {_score_sql('pay_time', 'o.pay_time_slot', 'wp')[0]} {_score_sql('amount', _AMT, 'wa')[0]}
             {_score_sql('brand', 'o.tname', 'wb')[0]} {_score_sql('category', 'o.b1_name', 'wc')[0]}),
users as (select uid, age, gender, ts_ms as user_ts from ({USER_SUP_SQL}) u)
select o.*, p.page_day, p.page_ts, p.os, p.search_category, {", ".join(
    f"p.device_{b}, p.search_{b}" for b in scoring.BANDS)}, u.age, u.gender, u.user_ts
from orders o join pages p on p.uid = o.uid and p.page_ts between o.order_ts - {DAY_MS} and o.order_ts + {DAY_MS}
join users u on u.uid = o.uid and u.user_ts between p.page_ts - {DAY_MS} and p.page_ts + {DAY_MS}"""

PROFILE_VIEWS = ("v_page_log", "v_user", "v_user_sup")


@register("user_profile_join", with_views(f"""
select uid, order_id, page_day, order_ts, page_ts, age, gender from ({PROFILE_SQL}) j""", *PROFILE_VIEWS))
def user_profile_join(spark, sf):
    """The three labels joined, user and order each within +-24 h of the page label."""
    return profile_join(spark, sf).select("uid", "order_id", "page_day", "order_ts", "page_ts", "age", "gender")


_PREFIXES = ["device", "search", "pay_time", "amount", "brand", "category"]


def _age_sql() -> str:
    sums = []
    for b in scoring.BANDS:
        terms = " + ".join(f"coalesce(cast({p}_{b} as decimal(10,3)), 0)" for p in _PREFIXES)
        sums.append(f"({terms})")
    arr = "[" + ", ".join(sums) + "]"
    bands = "[" + ", ".join(f"'{b}'" for b in scoring.BANDS) + "]"
    totals = ", ".join(f"cast({s} as double) as total_{b}" for s, b in zip(sums, scoring.BANDS))
    return f"""select uid, order_id, page_day, {totals},
  {bands}[list_position({arr}, list_max({arr}))] as age_level from ({PROFILE_SQL}) j"""


@register("age_level", with_views(_age_sql(), *PROFILE_VIEWS))
def age_level(spark, sf):
    """M7: age band with the largest summed score per joined profile."""
    x = scoring.age_level(profile_join(spark, sf), _PREFIXES)
    return x.select("uid", "order_id", "page_day", *[f"total_{b}" for b in scoring.BANDS], "age_level")
