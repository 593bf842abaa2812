"""Look-ups, small interval joins, regular joins and scalar helpers
(J9-J11, J15, H1-H3, H14, H16, T1-T5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions import scalars as H
from emporia.operators import joins, routing, state, text
from emporia.plans import common
from emporia.plans.oracle_views import with_views
from emporia.plans.registry import register
from emporia.sources import logs, standins
from emporia.sources.tables import table

E0 = standins.USER_EPOCH_MS


# ------------------------------------------------------------------ J9

@register("comment_dic_default", with_views("""
select cast(c.id as varchar) as id, c.appraise, coalesce(d.dic_name, 'N/A') as appraise_name
from v_comment c left join v_base_dic d on d.dic_code = c.appraise""", "v_comment", "v_base_dic"))
def comment_dic_default(spark, sf):
    """Appraisal code looked up in the dictionary, ``N/A`` when unknown."""
    c = common.cdc(spark, sf)
    com = routing.fact_source(c, "comment_info", ["id", "appraise"], keep_ts=False)
    out = joins.lookup_or_default(com, common.base_dic(c), "appraise", "dic_code", "dic_name", "appraise_name", spread="id")
    return out.select("id", "appraise", "appraise_name")


# ------------------------------------------------------------------ J10 / J15

def _emp(spark, sf):
    return logs.read_csv_lines(standins.emp_lines(spark, sf), standins.EMP_SCHEMA)


def _dept(spark, sf):
    return logs.read_csv_lines(standins.dept_lines(spark, sf), standins.DEPT_SCHEMA)


EMP_SQL = f"""select c_custkey as empno, c_name as ename, c_nationkey as deptno,
  {E0} + c_nationkey * 1000 + c_custkey % 11 as ts from customer"""
DEPT_SQL = f"""select n_nationkey as deptno, n_name as dname, {E0} + n_nationkey * 1000 + 3 as ts
  from nation where n_nationkey % 4 <> 3
  union all select r_regionkey + 100, r_name, {E0} from region"""


@register("interval_join_small", f"""
with e as ({EMP_SQL}), d as ({DEPT_SQL})
select e.empno, e.ename, e.deptno, d.dname, e.ts as emp_ts, d.ts as dept_ts
from e join d on d.deptno = e.deptno and d.ts between e.ts - 5 and e.ts + 5""")
def interval_join_small(spark, sf):
    """Employees JOIN departments, department time within +-5 ms (inclusive)."""
    e = _emp(spark, sf).withColumnRenamed("ts", "emp_ts")
    d = _dept(spark, sf).withColumnRenamed("ts", "dept_ts")
    x = joins.interval_join(e, d, "deptno", "emp_ts", "dept_ts", -5, 5)
    return x.select("empno", "ename", "deptno", "dname", "emp_ts", "dept_ts")


@register("emp_dept_left", f"""
with e as ({EMP_SQL}), d as ({DEPT_SQL})
select e.empno, e.ename, e.deptno, d.dname from e left join d on d.deptno = e.deptno""")
def emp_dept_left(spark, sf):
    """Regular left join (employees keep a null department name)."""
    e, d = _emp(spark, sf), _dept(spark, sf)
    return e.join(d.select("deptno", "dname"), "deptno", "left").select("empno", "ename", "deptno", "dname")


@register("emp_dept_full", f"""
with e as ({EMP_SQL}), d as ({DEPT_SQL})
select e.empno, e.ename, e.deptno as emp_deptno, d.deptno as dept_deptno, d.dname
from e full outer join d on d.deptno = e.deptno""")
def emp_dept_full(spark, sf):
    """Regular full outer join (staff-less departments appear too)."""
    # Left join plus the departments without staff: a full outer join would deal all staff
    # to one task per department, with no way to split or broadcast.
    e, d = _emp(spark, sf), _dept(spark, sf)
    dept = d.select(F.col("deptno").alias("dept_deptno"), "dname")
    staffed = e.select("empno", "ename", F.col("deptno").alias("emp_deptno")).join(
        dept, F.col("emp_deptno") == F.col("dept_deptno"), "left")
    used = e.select("deptno").distinct()
    empty = d.join(used, "deptno", "left_anti").select(
        F.lit(None).cast("bigint").alias("empno"), F.lit(None).cast("string").alias("ename"),
        F.lit(None).cast("int").alias("emp_deptno"), F.col("deptno").alias("dept_deptno"), "dname")
    return staffed.select("empno", "ename", "emp_deptno", "dept_deptno", "dname").unionByName(empty)


# ------------------------------------------------------------------ J11

ORDER_WINDOW_MS = 60 * 1000

COMMENT_ORDER_SQL = f"""
select cast(c.id as varchar) as id, cast(c.order_id as varchar) as order_id, cast(c.user_id as varchar) as user_id,
  c.appraise, c.comment_txt, c.ts_ms, cast(o.id as varchar) as info_id, cast(o.user_id as varchar) as info_user_id,
  cast(o.province_id as varchar) as info_province_id, cast(o.total_amount as varchar) as info_total_amount,
  strftime(o.create_time, '%Y-%m-%d %H:%M:%S') as info_create_time
from v_comment c join v_order_info o on o.id = c.order_id
  and epoch_us(o.create_time) // 1000 between c.ts_ms - {ORDER_WINDOW_MS} and c.ts_ms + {ORDER_WINDOW_MS}"""


def comment_order(spark, sf):
    """Comments JOIN their order within +-1 min; order fields prefixed ``info_``."""
    c = common.cdc(spark, sf)
    com = routing.fact_source(c, "comment_info", ["id", "order_id", "user_id", "appraise", "comment_txt"]).drop("op")
    o = common.order_info(c).select("id", "user_id", "province_id", "total_amount", "create_time")
    o = joins.prefixed(o, "info_").withColumn("info_ts", common.ms_of("info_create_time"))
    o = o.withColumn("order_id", F.col("info_id"))
    x = joins.interval_join(com, o, "order_id", "ts_ms", "info_ts", -ORDER_WINDOW_MS, ORDER_WINDOW_MS)
    return x.drop("info_ts")


@register("comment_order_interval", with_views(f"""
select id, order_id, user_id, appraise, ts_ms, info_id, info_user_id, info_province_id, info_total_amount,
  info_create_time from ({COMMENT_ORDER_SQL}) j""", "v_comment", "v_order_info"))
def comment_order_interval(spark, sf):
    """Comments JOIN their order within +-1 min, order fields prefixed ``info_``."""
    return comment_order(spark, sf).select("id", "order_id", "user_id", "appraise", "ts_ms", "info_id",
                                           "info_user_id", "info_province_id", "info_total_amount",
                                           "info_create_time")


@register("comment_base", with_views("""
select 'shop' as db, 'comment_info' as table_name, '1' as server_id, 'c' as op, ts_ms, cast(id as varchar) as id,
  cast(user_id as varchar) as user_id, cast(sku_id as varchar) as sku_id, cast(order_id as varchar) as order_id,
  appraise, comment_txt
from v_comment""", "v_comment"))
def comment_base(spark, sf):
    """Comments with their origin (database, table, server) and comment fields."""
    return routing.comment_base(common.cdc(spark, sf), "comment_info")


# ------------------------------------------------------------------ H1-H3, H14, H16

@register("scalar_dates", """
select event_id, strftime(make_timestamp(ms * 1000), '%Y-%m-%d') as d,
  strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') as dt, strftime(make_timestamp(ms * 1000), '%Y%m%d') as day_key,
  epoch_ms(strptime(strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) as back_ms,
  strftime(make_timestamp(ms * 1000), '%Y-%m') as month
from (select event_id, epoch_us(ts) // 1000 as ms from events) e""")
def scalar_dates(spark, sf):
    """H1-H3: epoch ms -> date / datetime / day key; datetime -> ms; reformat."""
    e = table(spark, sf, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    dt = H.ms_to_datetime(F.col("ms"))
    return e.select("event_id", H.ms_to_date(F.col("ms")).alias("d"), dt.alias("dt"),
                    H.ms_to_day_key(F.col("ms")).alias("day_key"), H.datetime_to_ms(dt).alias("back_ms"),
                    H.reformat(dt, "yyyy-MM").alias("month"))


@register("hash_bucket", """
select lpad(cast(cast(('0x' || right(md5(cast(o_custkey as varchar)), 3)) as integer) % 128 as varchar), 4, '0')
    as bucket, cast(count(*) as bigint) as n_rows
from orders group by 1""")
def hash_bucket(spark, sf):
    """H14 re-aimed: orders per salt bucket of the customer key (128 buckets)."""
    o = table(spark, sf, "orders")
    return o.groupBy(H.hash_bucket(F.col("o_custkey"), 128).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("day_spine", """
select order_status, cast(strftime(d, '%Y%m%d') as integer) as day
from (select o_orderstatus as order_status,
        unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d
      from orders group by o_orderstatus) t""")
def day_spine(spark, sf):
    """H16 re-aimed: every day partition between the first and last order, per status."""
    o = table(spark, sf, "orders")
    rng = o.groupBy(F.col("o_orderstatus").alias("order_status")).agg(
        F.min(F.to_date("o_orderdate")).alias("d1"), F.max(F.to_date("o_orderdate")).alias("d2"))
    days = rng.select("order_status", F.explode(F.sequence("d1", "d2")).alias("d"))
    return days.select("order_status", F.date_format("d", "yyyyMMdd").cast("int").alias("day"))


# ------------------------------------------------------------------ T1-T5

@register("keyword_explode", """
select doc_id, keyword, cast(count(*) as bigint) as n
from (select doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) as keyword from documents) t
where keyword <> '' group by doc_id, keyword""")
def keyword_explode(spark, sf):
    """Keyword table function over whole documents, counted per document."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    kw = text.explode_tokens(d, "text", "keyword")
    return kw.groupBy("doc_id", "keyword").agg(F.count(F.lit(1)).alias("n"))


def _comments(spark, sf):
    c = common.cdc(spark, sf)
    return routing.fact_source(c, "comment_info", ["id", "comment_txt"]).select(
        "id", F.col("comment_txt").alias("msg"))


P0_SQL = """
  select cast(c.id as varchar) as id, c.comment_txt as msg, w.word as hit
  from v_comment c left join v_words w on w.word = regexp_replace(
    string_split(regexp_replace(c.comment_txt, ',+$', ''), ',')[-1], '^\\s+|\\s+$', '', 'g')"""

FOUND_SQL = """
  select p.id, string_agg(v.word, ', ' order by v.word) as found
  from p0 p join v_words v on contains(lower(p.msg), v.word) where p.hit is null group by p.id"""

MODERATION_SQL = f"""
with p0 as ({P0_SQL}), found as ({FOUND_SQL})
select p0.id, p0.msg,
  case when p0.hit is not null or f.found is not null then 1 else 0 end as is_violation,
  case when p0.hit is not null then 'P0' when f.found is not null then 'P1' else '' end as violation_grade,
  coalesce(p0.hit, f.found, '') as violation_msg
from p0 left join found f on f.id = p0.id"""


@register("moderate_p0", with_views("""
select id, case when hit is null then 0 else 1 end as is_violation,
  case when hit is null then '' else 'P0' end as violation_grade, coalesce(hit, '') as violation_msg
from ({P0}) p""".replace("{P0}", P0_SQL), "v_comment", "v_words"))
def moderate_p0(spark, sf):
    """Last comma token of each comment checked against the word list."""
    out = text.check_last_word(_comments(spark, sf), standins.words(spark, sf))
    return out.select("id", "is_violation", "violation_grade", "violation_msg")


@register("moderate_p1", with_views(f"""
select id, is_violation, violation_grade, violation_msg from ({MODERATION_SQL}) m""", "v_comment", "v_words"))
def moderate_p1(spark, sf):
    """T3 after T2: clean comments screened for every listed word they contain."""
    out = text.check_all_words(text.check_last_word(_comments(spark, sf), standins.words(spark, sf)),
                               standins.screened_words(spark, sf))
    return out.select("id", "is_violation", "violation_grade", "violation_msg")


@register("moderation_report", with_views(f"""
with j as ({COMMENT_ORDER_SQL}),
p0 as (select j.id, j.user_id, j.info_user_id, j.ts_ms, j.comment_txt as msg, w.word as hit
       from j left join v_words w on w.word = regexp_replace(
         string_split(regexp_replace(j.comment_txt, ',+$', ''), ',')[-1], '^\\s+|\\s+$', '', 'g')),
found as ({FOUND_SQL})
select p0.user_id, p0.info_user_id as consignee, p0.ts_ms, strftime(make_timestamp(p0.ts_ms * 1000), '%Y%m%d') as ds,
  p0.msg, case when p0.hit is not null or f.found is not null then 1 else 0 end as is_violation,
  case when p0.hit is not null then 'P0' when f.found is not null then 'P1' else '' end as violation_grade,
  coalesce(p0.hit, f.found, '') as violation_msg
from p0 left join found f on f.id = p0.id""", "v_comment", "v_order_info", "v_words"))
def moderation_report(spark, sf):
    """T4: comment-order join (J11) -> exact de-dup on order_id_ts (F9) ->
    last-word check (T2) -> whole-text check (T3) -> result columns (K4)."""
    j = comment_order(spark, sf)
    j = state.dedup_exact(j, ["order_id", "ts_ms"], "id")
    j = j.select("id", "user_id", F.col("info_user_id").alias("consignee"), "ts_ms",
                 F.col("comment_txt").alias("msg"))
    j = routing.with_ds(j)
    out = text.check_all_words(text.check_last_word(j, standins.words(spark, sf)), standins.screened_words(spark, sf))
    return out.select("user_id", "consignee", "ts_ms", "ds", "msg", "is_violation", "violation_grade",
                      "violation_msg")


@register("word_membership", with_views("""
select t.word, v.word is not null as is_member
from (select distinct w as word from (select unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) as w
                                      from documents) x where w <> '') t
left join v_words v on v.word = t.word""", "v_words"))
def word_membership(spark, sf):
    """T5: every distinct word of the documents checked against the list in one batch."""
    d = table(spark, sf, "documents").select("text")
    cand = text.explode_tokens(d, "text", "word", text.WORD_SPLIT).distinct()
    return text.membership(cand, standins.words(spark, sf)).select("word", "is_member")
