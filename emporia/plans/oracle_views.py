"""The stand-in views of ``emporia.sources.standins`` as portable SQL.

DuckDB runs these against the same parquet tables to produce the
reference answers; each query's oracle is ``WITH <views> <query>``.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _view(name: str, sql: str, deps: list[str] | None = None) -> None:
    VIEWS[name] = sql
    DEPS[name] = deps or []


_view("v_events_k", """
  select e.*, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events e""")

_view("v_page_log", """
  select event_id, epoch_us(ts) // 1000 as ts_ms, cast(user_id as varchar) as mid, cast(user_id as varchar) as uid,
    page_id, lag(page_id) over (partition by user_id, cast(ts as date) order by ts, event_id) as last_page_id,
    case when k % 2 = 0 then 'keyword' else 'sku_id' end as item_type, p_name as item,
    cast(floor(value) as bigint) as during_time,
    cast(k % 3 as varchar) as vc, cast(k % 4 as varchar) as ch, cast(k % 5 as varchar) as ar,
    cast(event_id % 2 as varchar) as is_new,
    case when k % 3 = 0 then 'iOS 13.0' when k % 3 = 1 then 'Android 12.0' else 'Windows 10' end as os,
    'model-' || cast(k % 6 as varchar) as md, 'brand-' || cast(k % 4 as varchar) as ba,
    k % 10 = 0 as has_err, k % 10 = 1 as has_start, k
  from (select e.*, p.p_name,
          case event_type when 'view' then 'home' when 'click' then 'good_detail' when 'purchase' then 'order'
                          when 'signup' then 'login' else 'search' end as page_id
        from v_events_k e left join part p on p.p_partkey = e.event_id % (select count(*) from part)) x""", ["v_events_k"])

_view("v_order_info", """
  select o_orderkey as id, o_custkey as user_id, c_nationkey as province_id, o_orderdate as create_time,
    cast(o_totalprice as decimal(16,2)) as total_amount, o_orderstatus as order_status,
    substr(o_orderpriority, 1, 1) as type_code
  from orders join customer on o_custkey = c_custkey""")

_view("v_order_detail", """
  select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, l_partkey as sku_id, p_name as sku_name,
    l_shipdate as create_time, cast(l_quantity as int) as sku_num, cast(p_retailprice as decimal(16,2)) as order_price,
    cast(l_extendedprice as decimal(16,2)) as split_total_amount,
    cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) as decimal(18,4)) as split_activity_amount,
    cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as decimal(18,4)) as split_coupon_amount,
    l_suppkey as supp_id, l_discount, l_tax, l_returnflag,
    row_number() over (partition by l_orderkey, l_linenumber
       order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) as seq,
    count(*) over (partition by l_orderkey, l_linenumber) as n
  from lineitem join part on l_partkey = p_partkey""")

_view("v_order_detail_latest", "select * from v_order_detail where seq = n", ["v_order_detail"])

_view("v_activity", """
  select id as order_detail_id, supp_id % 10 as activity_id, supp_id % 7 as activity_rule_id
  from v_order_detail_latest where l_discount >= 0.05""", ["v_order_detail_latest"])

_view("v_coupon", """
  select id as order_detail_id, supp_id % 5 as coupon_id from v_order_detail_latest where l_tax >= 0.04""",
      ["v_order_detail_latest"])

_view("v_refund", """
  select id, order_id, sku_id, sku_num as refund_num, split_total_amount as refund_amount, create_time,
    cast(id % 3 + 1 as varchar) as refund_type, cast(id % 5 + 1 as varchar) as refund_reason_type,
    'reason of ' || cast(id as varchar) as refund_reason_txt
  from v_order_detail_latest where l_returnflag = 'R'""", ["v_order_detail_latest"])

_view("v_payment", """
  select order_id as id, order_id, o_custkey as user_id, cast(order_id % 5 + 1 as varchar) as payment_type,
    min(create_time) + to_seconds((order_id * 7919) % 2400) as callback_time
  from v_order_detail_latest join orders on o_orderkey = order_id group by order_id, o_custkey""",
      ["v_order_detail_latest"])

_view("v_refund_payment", """
  select id, order_id, sku_id, refund_amount as total_amount, create_time as callback_time,
    cast(id % 4 + 1 as varchar) as payment_type
  from v_refund where id % 2 = 0""", ["v_refund"])

_view("v_base_dic", """
  select distinct substr(o_orderpriority, 1, 1) as dic_code, substr(o_orderpriority, 3) as dic_name
  from orders where substr(o_orderpriority, 1, 1) <> '5'""")

_view("v_sku", """
  select p_partkey as sku_id, p_name as sku_name, p_partkey % 50 as spu_id, p_brand as tm_name,
    p_type as category3_id, length(p_type) as category2_id, length(p_type) % 2 as category1_id from part""")

_view("v_province", """
  select n_nationkey as province_id, n_name as province_name, n_regionkey as region_id from nation""")

_view("v_payment_event", "select user_id, event_id, ts from events where event_type = 'purchase'")
_view("v_detail_event", "select user_id, event_id, ts from events where event_type = 'click'")

_view("v_login", "select user_id, event_id, ts from events where event_type = 'signup'")

_view("v_customer_seen", """
  select c.*, coalesce(epoch_us(f.first_ts) // 1000, 1704067200000 + c_custkey * 60000) as seen_ms
  from customer c left join (select user_id, min(ts) as first_ts from events group by user_id) f on f.user_id = c_custkey""")

_view("v_user", """
  select c_custkey as uid, c_name as uname, case when c_custkey % 3 = 0 then null else 'M' end as gender,
    (c_custkey * 37) % 20000 as birthday_epoch_day, seen_ms as ts_ms from v_customer_seen""", ["v_customer_seen"])

_view("v_user_sup", """
  select c_custkey as uid, 150 + c_custkey % 50 as height, 'cm' as unit_height, 45 + c_custkey % 60 as weight,
    'kg' as unit_weight,
    seen_ms + ((c_custkey * 7919) % 900 - 450) * 1000 as ts_ms from v_customer_seen""", ["v_customer_seen"])

_view("v_comment", """
  select doc_id as id, o_custkey as user_id, doc_id % (select count(*) from part) as sku_id, doc_id as order_id,
    cast(1 + doc_id % 5 as varchar) as appraise, text as comment_txt,
    (epoch_us(o_orderdate) // 1000) + ((doc_id * 7919) % 181 - 90) * 1000 as ts_ms
  from documents join orders on doc_id = o_orderkey""")

_view("v_words", """
  select distinct w as word from (
    select unnest(regexp_split_to_array(lower(text), '\\s+') || regexp_split_to_array(lower(text), '[^\\p{L}]+')) as w
    from benchmark) t
  where w <> ''""")

_view("v_dic_version", """
  select dic_code, case when k = 0 then dic_name else dic_name || ' v' || k end as dic_name,
    lo + (hi - lo) * k // 4 as ts_ms, k = 2 and dic_code = '4' as deleted
  from (select substr(o_orderpriority, 1, 1) as dic_code, substr(o_orderpriority, 3) as dic_name,
          epoch_us(min(o_orderdate)) // 1000 as lo, epoch_us(max(o_orderdate)) // 1000 as hi
        from orders group by 1, 2) s, generate_series(0, 3) as g(k)
  where dic_code <> '5'""")


def with_views(body: str, *names: str) -> str:
    """``WITH`` clause holding the named views and their dependencies, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in order)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
