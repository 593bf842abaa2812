"""Traffic queries over the page log: A1 (flagship), A5, A6, A7, F1, F2, F6."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.operators import state, windows
from emporia.plans.oracle_views import with_views
from emporia.plans.registry import register
from emporia.sources import standins

TRAFFIC_SQL = with_views("""
with fixed as (
  select *, case when is_new = '1' and first_value(case when is_new = '1' then d else d - 1 end)
               over (partition by mid order by ts_ms, event_id) <> d then '0' else is_new end as is_new_fixed
  from (select *, cast(make_timestamp(ts_ms * 1000) as date) as d from v_page_log) a),
page as (
  select *, case when lag(d) over (partition by mid order by ts_ms, event_id) is null
                   or lag(d) over (partition by mid order by ts_ms, event_id) <> d then 1 else 0 end as uv,
         case when last_page_id is null or last_page_id = '' then 1 else 0 end as sv,
         time_bucket(interval '10 seconds', make_timestamp(ts_ms * 1000)) as ws
  from fixed where not has_start)
select strftime(ws, '%Y-%m-%d %H:%M:%S') as stt, strftime(ws + interval '10 seconds', '%Y-%m-%d %H:%M:%S') as edt,
  strftime(ws, '%Y-%m-%d') as cur_date, vc, ch, ar, is_new_fixed as is_new,
  cast(sum(uv) as bigint) as uv_ct, cast(sum(sv) as bigint) as sv_ct, cast(count(*) as bigint) as pv_ct,
  cast(sum(during_time) as bigint) as dur_sum
from page group by ws, vc, ch, ar, is_new_fixed
""", "v_page_log")


@register("traffic_vc_ch_ar_isnew", TRAFFIC_SQL)
def traffic_vc_ch_ar_isnew(spark, sf):
    """A1 (flagship): page log -> F1 -> F2 -> 10 s windows by vc, ch, ar, is_new."""
    return windows.traffic_window(standins.page_log(spark, sf), "10 seconds")


IS_NEW_SQL = with_views("""
select event_id, mid, cast(ts_ms as bigint) as ts_ms, is_new as is_new_raw,
  case when is_new = '1' and first_value(case when is_new = '1' then d else d - 1 end)
       over (partition by mid order by ts_ms, event_id) <> d then '0' else is_new end as is_new
from (select *, cast(make_timestamp(ts_ms * 1000) as date) as d from v_page_log) a
""", "v_page_log")


@register("is_new_repair", IS_NEW_SQL)
def is_new_repair(spark, sf):
    """F1 on every log record."""
    log = standins.page_log(spark, sf).select("event_id", "mid", "ts_ms", "is_new")
    fixed = state.repair_is_new(log.withColumn("is_new_raw", F.col("is_new")))
    return fixed.select("event_id", "mid", "ts_ms", "is_new_raw", "is_new")


DAILY_UNIQUE_SQL = with_views("""
select event_id, mid, ts_ms,
  case when lag(d) over (partition by mid order by ts_ms, event_id) is null
         or lag(d) over (partition by mid order by ts_ms, event_id) <> d then 1 else 0 end as uv_ct,
  case when last_page_id is null or last_page_id = '' then 1 else 0 end as sv_ct
from (select *, cast(make_timestamp(ts_ms * 1000) as date) as d from v_page_log where not has_start) a
""", "v_page_log")


@register("daily_unique", DAILY_UNIQUE_SQL)
def daily_unique(spark, sf):
    """F2 on page records: first visit of the day and session start flags."""
    page = standins.page_log(spark, sf).where(~F.col("has_start"))
    page = page.select("event_id", "mid", "ts_ms", "last_page_id")
    out = state.with_session_start(state.mark_daily_unique(page, "mid"))
    return out.select("event_id", "mid", "ts_ms", F.col("uv_ct").cast("int").alias("uv_ct"),
                      F.col("sv_ct").cast("int").alias("sv_ct"))
