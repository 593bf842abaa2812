"""Source scans, record filters, routing and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions.scalars import md5_key
from emporia.operators import routing
from emporia.plans import common
from emporia.plans.oracle_views import with_views
from emporia.plans.registry import register
from emporia.sources import logs, sinks, standins
from emporia.sources.tables import table

E0 = standins.USER_EPOCH_MS

def _kv_sql(cols: list[str], times: tuple[str, ...] = ()) -> str:
    """Canonical text of the columns: ``k=v`` sorted by key, ``;``-joined, null as nothing."""
    parts = []
    for i, c in enumerate(sorted(cols)):
        value = _ts_txt(c) if c in times else f"cast({c} as varchar)"
        parts.append(f"'{';' if i else ''}{c}=' || coalesce({value}, '')")
    return " || ".join(parts)


def _ts_txt(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _cdc_branch(table_name: str, view: str, op: str, ts: str, where: str = "") -> str:
    cols = standins.CDC_COLUMNS[table_name]
    data = _kv_sql(cols, ("create_time", "callback_time"))
    return (f"select '{table_name}' as table_name, {op} as op, {ts} as ts_ms, "
            f"cast({sinks.PRIMARY_KEYS[table_name]} as varchar) as pk, {data} as data from {view} {where}")


# The change log per record, as SQL (one branch per shop table).
_CREATED = "epoch_us(create_time) // 1000"
_CART_SQL = """(select event_id as id, user_id, event_id % (select count(*) from part) as sku_id,
    1 + event_id % 3 as sku_num, ts from v_detail_event) c"""
CDC_ROWS_SQL = " union all ".join([
    _cdc_branch("order_info", "v_order_info", "'c'", _CREATED),
    _cdc_branch("order_detail", "v_order_detail", "case when seq = 1 then 'c' else 'u' end", f"{_CREATED} + seq"),
    _cdc_branch("order_detail_activity", "v_activity", "'c'", str(E0)),
    _cdc_branch("order_detail_coupon", "v_coupon", "'c'", str(E0)),
    _cdc_branch("order_refund_info", "v_refund", "'c'", _CREATED),
    _cdc_branch("payment_info", "v_payment", "'c'", "epoch_us(callback_time) // 1000"),
    _cdc_branch("refund_payment", "v_refund_payment", "'c'", "epoch_us(callback_time) // 1000"),
    _cdc_branch("base_dic", "v_base_dic", "'r'", str(E0)),
    _cdc_branch("base_province", "v_province", "'r'", str(E0)),
    _cdc_branch("base_province", "v_province", "'d'", str(E0 + 1000), "where province_id % 10 = 9"),
    _cdc_branch("sku_info", "v_sku", "'r'", str(E0)),
    _cdc_branch("cart_info", _CART_SQL, "'c'", "epoch_us(ts) // 1000"),
    _cdc_branch("comment_info", "v_comment", "'c'", "ts_ms"),
])

CDC_VIEWS = ("v_order_info", "v_order_detail", "v_activity", "v_coupon", "v_refund", "v_payment", "v_refund_payment",
             "v_base_dic", "v_province", "v_sku", "v_detail_event", "v_comment")

CDC_SQL = with_views(f"select table_name, op, ts_ms, pk, data from ({CDC_ROWS_SQL}) r", *CDC_VIEWS)


def _rows(c: DataFrame) -> DataFrame:
    """One row per change: table, op, time, key and the whole payload as text."""
    flat = routing.change_flat(c)
    pk = sinks.primary_key(F.col("table_name"), F.col("data"))
    return flat.select("table_name", "op", "ts_ms", pk.alias("pk"), routing.sorted_kv(F.col("data")).alias("data"))


def _with_noise(lines: DataFrame) -> DataFrame:
    """The lines and, beside some of them, null values and lines that are no change record (cut short, a number,
    a string, a list), in one pass."""
    kind = F.xxhash64("value") % 50
    noise = F.array("value", F.expr("substring(value, 1, length(value) - 3)"), F.lit("123"), F.lit('"a"'), F.lit("[1]"))
    null = F.array("value", F.lit(None).cast("string"))
    return lines.select(F.explode(F.when(kind == 0, noise).when(kind == 1, null).otherwise(F.array("value"))).alias("value"))


@register("cdc_scan", CDC_SQL)
def cdc_scan(spark, sf):
    """Raw change-log lines, null values and malformed lines among them, parsed into records."""
    return _rows(logs.read_cdc(spark, _with_noise(common.cdc_lines(spark, sf))))


@register("bootstrap_filter", CDC_SQL)
def bootstrap_filter(spark, sf):
    """The change log with bootstrap markers interleaved, markers dropped."""
    ops = F.when(F.col("op") == "r", F.array("op", F.lit("bootstrap-insert"))).otherwise(F.array("op"))
    return _rows(routing.drop_bootstrap(common.whole_cdc(spark, sf).withColumn("op", F.explode(ops))))


@register("dim_etl_filter", CDC_SQL)
def dim_etl_filter(spark, sf):
    """The change log plus foreign-db, bad-op and bad-ts records; filter keeps the shop's."""
    c = common.whole_cdc(spark, sf)
    tbl = routing.table_col(c)
    archive = F.create_map(F.lit("db"), F.lit("archive"), F.lit("table"), F.lit("base_dic"))

    def record(source, op, ts_ms):
        return F.struct(source.alias("source"), op.alias("op"), ts_ms.alias("ts_ms"))

    own = record(F.col("source"), F.col("op"), F.col("ts_ms"))
    noise = (F.when(tbl == "base_dic", F.array(own, record(archive, F.col("op"), F.col("ts_ms"))))
             .when(tbl == "base_province", F.array(own, record(F.col("source"), F.col("op"), F.lit(7).cast("bigint"))))
             .when(tbl == "sku_info", F.array(own, record(F.col("source"), F.lit("x"), F.col("ts_ms")))).otherwise(F.array(own)))
    noisy = c.select("before", "after", "table_name", F.explode(noise).alias("_r")).select("before", "after", "table_name", "_r.*")
    return _rows(routing.dim_etl(noisy, standins.CDC_DB))


@register("change_flat", CDC_SQL)
def change_flat(spark, sf):
    """``after`` unless empty else ``before``, for every change."""
    return _rows(common.whole_cdc(spark, sf))


@register("cdc_audit", with_views(f"""
select pk || '_' || cast(ts_ms as varchar) as id, any_value(op) as op, 'shop' as db, table_name,
  max(ts_ms) as ts_ms, cast(count(*) as bigint) as n_writes,
  any_value(case when op = 'd' then data end) as before, any_value(case when op <> 'd' then data end) as after
from ({CDC_ROWS_SQL}) r group by table_name, pk || '_' || cast(ts_ms as varchar)""", *CDC_VIEWS))
def cdc_audit(spark, sf):
    """K8: audit rows ``id=<pk>_<ts>`` with op, db, table, before and after (JSON, shown as sorted
    pairs); insert-or-update by id."""
    keys = ["table_name", "id"]
    details, others = standins.whole_cdc_parts(spark, sf)  # (no table is in both)
    audit = sinks.upsert_counts(sinks.cdc_audit(details, "key"), keys, dealt="key").unionByName(
        sinks.upsert_counts(sinks.cdc_audit(others), keys))
    kv = {c: routing.sorted_kv(F.from_json(c, "map<string,string>")) for c in ("before", "after")}
    return audit.withColumns(kv)


# ------------------------------------------------------------------ S2 / P2 / P8

@register("page_log_scan", with_views("""
select event_id, ts_ms, mid, uid, vc, ch, ar, is_new, os, md, ba, page_id, last_page_id, item_type, item,
  during_time, has_err, has_start from v_page_log""", "v_page_log"))
def page_log_scan(spark, sf):
    """Parse raw page-log lines into flat columns with event time."""
    return common.page_log(spark, sf).drop("et")


@register("dirty_split", with_views("""
select 'good' as kind, event_id, cast(null as varchar) as line from v_page_log
union all select 'dirty', null, unnest([cast(event_id as varchar), '"' || mid || '"', '[' || cast(event_id as varchar) || ']',
  '{"event_id":' || cast(event_id as varchar)]) from v_page_log where event_id % 50 = 0
union all select 'dirty', null, null from v_page_log where event_id % 50 = 0""", "v_page_log"))
def dirty_split(spark, sf):
    """Raw lines mixed with cut-off objects, numbers, strings, lists and nulls; each line by its kind."""
    lines = standins.page_log_json(spark, sf)
    some = standins.page_log(spark, sf).where(F.col("event_id") % 50 == 0)
    event = F.col("event_id").cast("string")
    noise = F.array(event, F.concat(F.lit('"'), "mid", F.lit('"')), F.concat(F.lit("["), event, F.lit("]")),
                    F.concat(F.lit('{"event_id":'), event), F.lit(None).cast("string"))
    good, dirty = routing.split_dirty(lines.unionByName(some.select(F.explode(noise).alias("value"))))
    return good.select(F.lit("good").alias("kind"), F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
                       F.lit(None).cast("string").alias("line")).unionByName(
        dirty.select(F.lit("dirty").alias("kind"), F.lit(None).cast("bigint").alias("event_id"),
                     F.col("value").alias("line")))


def _split(spark, sf):
    return routing.split_log(common.page_log(spark, sf, nested=True))


@register("log_err", with_views("""
select event_id, ts_ms as ts, mid, has_start from v_page_log where has_err""", "v_page_log"))
def log_err(spark, sf):
    """Error records (whole record, start or page)."""
    return _split(spark, sf)["err"].select("event_id", "ts", F.col("common")["mid"].alias("mid"),
                                           F.col("start").isNotNull().alias("has_start"))


@register("log_start", with_views("""
select event_id, ts_ms as ts, mid, has_err from v_page_log where has_start""", "v_page_log"))
def log_start(spark, sf):
    """Start records."""
    return _split(spark, sf)["start"].select("event_id", "ts", F.col("common")["mid"].alias("mid"),
                                             F.col("err").isNotNull().alias("has_err"))


@register("log_page", with_views("""
select event_id, ts_ms as ts, mid, page_id, last_page_id, during_time from v_page_log where not has_start""",
                                 "v_page_log"))
def log_page(spark, sf):
    """Page records (no start), without err, displays and actions."""
    p = _split(spark, sf)["page"]
    return p.select("event_id", "ts", F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"),
                    F.col("page")["last_page_id"].alias("last_page_id"),
                    F.col("page")["during_time"].alias("during_time"))


@register("log_display", with_views("""
select event_id, ts_ms as ts, mid, page_id, 'sku_id' as item_type, cast(event_id % 97 as varchar) as item, '1' as pos_id
from v_page_log where not has_start and k % 4 = 0
union all
select event_id, ts_ms, mid, page_id, 'activity_id', cast(event_id % 13 as varchar), '2'
from v_page_log where not has_start and k % 4 = 0""", "v_page_log"))
def log_display(spark, sf):
    """One row per display of a page record."""
    d = _split(spark, sf)["display"]
    return d.select("event_id", "ts", F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"),
                    F.col("display")["item_type"].alias("item_type"), F.col("display")["item"].alias("item"),
                    F.col("display")["pos_id"].alias("pos_id"))


@register("log_action", with_views("""
select event_id, mid, page_id, 'cart_add' as action_id, cast(event_id % 97 as varchar) as item,
  cast(ts_ms as varchar) as action_ts
from v_page_log where not has_start and k % 5 = 0""", "v_page_log"))
def log_action(spark, sf):
    """One row per action of a page record (actions carry no record ts)."""
    a = _split(spark, sf)["action"]
    return a.select("event_id", F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"),
                    F.col("action")["action_id"].alias("action_id"), F.col("action")["item"].alias("item"),
                    F.col("action")["ts"].alias("action_ts"))


# ------------------------------------------------------------------ S4-S8

@register("base_dic_scan", with_views("select dic_code, dic_name from v_base_dic", "v_base_dic"))
def base_dic_scan(spark, sf):
    """The dictionary dimension (``info.dic_name``), read back by dotted access."""
    dim = logs.read_base_dic(common.base_dic(common.cdc(spark, sf)))
    return dim.select("dic_code", F.col("info.dic_name").alias("dic_name"))


def category_tables(spark: SparkSession, sf: str):
    """Three-level category tables derived from the part catalogue."""
    p = table(spark, sf, "part")
    length = F.length("p_type").cast("bigint")
    c3 = p.select(F.col("p_type").alias("id"), F.lower("p_type").alias("name"),
                  length.alias("category2_id")).distinct()
    c2 = p.select(length.alias("id")).distinct().select(
        "id", F.concat(F.lit("c2-"), F.col("id").cast("string")).alias("name"), (F.col("id") % 2).alias("category1_id"))
    c1 = p.select((length % 2).alias("id")).distinct().select(
        "id", F.concat(F.lit("c1-"), F.col("id").cast("string")).alias("name"))
    return c3, c2, c1


def category_dim(c3: DataFrame, c2: DataFrame, c1: DataFrame) -> DataFrame:
    """category3 JOIN category2 JOIN category1, flattened."""
    a, b, c = c3.alias("c3"), c2.alias("c2"), c1.alias("c1")
    x = a.join(b, F.col("c3.category2_id") == F.col("c2.id")).join(c, F.col("c2.category1_id") == F.col("c1.id"))
    return x.select(F.col("c3.id").alias("c3id"), F.col("c3.name").alias("c3name"),
                    F.col("c2.id").alias("c2id"), F.col("c2.name").alias("c2name"),
                    F.col("c1.id").alias("c1id"), F.col("c1.name").alias("c1name"))


@register("dim_category_flat", """
with c3 as (select distinct p_type as id, lower(p_type) as name, length(p_type) as category2_id from part),
c2 as (select distinct length(p_type) as id from part),
c1 as (select distinct length(p_type) % 2 as id from part)
select c3.id as c3id, c3.name as c3name, c2.id as c2id, 'c2-' || cast(c2.id as varchar) as c2name,
  c1.id as c1id, 'c1-' || cast(c1.id as varchar) as c1name
from c3 join c2 on c3.category2_id = c2.id join c1 on c2.id % 2 = c1.id""")
def dim_category_flat(spark, sf):
    """The three-level category tables flattened into one row per level-3 category."""
    return category_dim(*category_tables(spark, sf))


def sku_dim(sku: DataFrame, spu: DataFrame, tm: DataFrame) -> DataFrame:
    """Sku JOIN spu JOIN trademark -> sku, spu, category3, trademark name."""
    x = sku.join(spu, "spu_id").join(tm, "tm_id")
    return x.select("sku_id", "spu_id", "spu_name", "category3_id", "tm_name")


@register("dim_sku_flat", """
select p_partkey as sku_id, p_partkey % 50 as spu_id, 'spu-' || cast(p_partkey % 50 as varchar) as spu_name,
  p_type as category3_id, p_brand as tm_name from part""")
def dim_sku_flat(spark, sf):
    """Sku JOIN spu JOIN trademark (all derived from the part catalogue)."""
    p = table(spark, sf, "part")
    tm_id = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    sku = p.select(F.col("p_partkey").alias("sku_id"), (F.col("p_partkey") % 50).alias("spu_id"),
                   tm_id.alias("tm_id"), F.col("p_type").alias("category3_id"))
    spu = sku.select("spu_id").distinct().select(
        "spu_id", F.concat(F.lit("spu-"), F.col("spu_id").cast("string")).alias("spu_name"))
    tm = p.select(tm_id.alias("tm_id"), F.col("p_brand").alias("tm_name")).distinct()
    return sku_dim(sku, spu, tm)


@register("csv_lines_parse", f"""
select c_custkey as empno, c_name as ename, c_nationkey as deptno, {E0} + c_nationkey * 1000 + c_custkey % 11 as ts
from customer""")
def csv_lines_parse(spark, sf):
    """Employee CSV lines ``empno,ename,deptno,ts`` -> typed rows."""
    lines = standins.emp_lines(spark, sf)
    return logs.read_csv_lines(lines, standins.EMP_SCHEMA)


# ------------------------------------------------------------------ P5-P7, K6, K7

@register("config_latest", """
select p_brand as source_table, p_type as source_type, 'dwd_' || cast(p_partkey as varchar) as sink_table,
  p_name as sink_columns
from (select *, row_number() over (partition by p_brand, p_type order by p_partkey desc) as rn from part) t
where rn = 1 and p_partkey % 11 <> 0""")
def config_latest(spark, sf):
    """The routing config after a change feed of creates, updates and deletes."""
    return sinks.fact_config(standins.config_feed(spark, sf))


@register("routed_facts", with_views(f"""
select 'dwd_trade_cart_add' as sink_table, 'c' as source_type, epoch_us(ts) // 1000 as ts_ms,
  {_kv_sql(['id', 'user_id', 'sku_id'])} as data
from (select event_id as id, user_id, event_id % (select count(*) from part) as sku_id, ts from v_detail_event) a
union all
select 'dwd_interaction_comment_info', 'c', ts_ms, {_kv_sql(['id', 'user_id', 'sku_id', 'appraise'])} from v_comment
union all
select 'dwd_trade_order_refund', 'c', epoch_us(create_time) // 1000,
  {_kv_sql(['id', 'order_id', 'sku_id', 'refund_num', 'refund_amount'])} from v_refund
union all
select 'dwd_trade_order_detail_update', 'u', epoch_us(create_time) // 1000 + seq,
  {_kv_sql(['id', 'sku_num', 'split_total_amount'])} from v_order_detail where seq > 1""",
    "v_detail_event", "v_comment", "v_refund", "v_order_detail"))
def routed_facts(spark, sf):
    """P5 (+P7, J16): config-driven fact routing of the change log."""
    c = common.cdc(spark, sf)
    out = routing.route_facts(c, sinks.fact_config(sinks.fact_feed(spark)))
    return out.select("sink_table", "source_type", "ts_ms", routing.sorted_kv(F.col("data")).alias("data"))


@register("routed_facts_as_of", with_views(f"""
with e as (select epoch_us(min(ts)) // 1000 as lo, epoch_us(max(ts)) // 1000 as hi from events),
o as (select epoch_us(min(o_orderdate)) // 1000 as lo, epoch_us(max(o_orderdate)) // 1000 as hi from orders),
cart as (select event_id as id, user_id, event_id % (select count(*) from part) as sku_id, 1 + event_id % 3 as sku_num,
  epoch_us(ts) // 1000 as ts_ms from v_detail_event)
select 'dwd_trade_cart_add' as sink_table, 'c' as source_type, ts_ms,
  case when ts_ms < lo + (hi - lo) // 3 then {_kv_sql(['id', 'user_id', 'sku_id', 'sku_num'])}
    else {_kv_sql(['id', 'user_id', 'sku_id'])} end as data
from cart, e where ts_ms >= lo
union all
select 'dwd_interaction_comment_info', 'c', ts_ms, {_kv_sql(['id', 'user_id', 'sku_id', 'appraise'])}
from v_comment, o where ts_ms >= lo
union all
select 'dwd_trade_order_refund', 'c', epoch_us(create_time) // 1000,
  {_kv_sql(['id', 'order_id', 'sku_id', 'refund_num', 'refund_amount'])} from v_refund, o where epoch_us(create_time) // 1000 >= lo
union all
select 'dwd_trade_order_detail_update', 'u', epoch_us(create_time) // 1000 + seq,
  {_kv_sql(['id', 'sku_num', 'split_total_amount'])} from v_order_detail, o
where seq > 1 and epoch_us(create_time) // 1000 + seq >= lo
union all
select 'dwd_trade_refund_pay', 'c', epoch_us(callback_time) // 1000, {_kv_sql(['id', 'order_id', 'total_amount'])}
from v_refund_payment, o where epoch_us(callback_time) // 1000 >= lo and epoch_us(callback_time) // 1000 < lo + (hi - lo) * 2 // 3""",
    "v_detail_event", "v_comment", "v_refund", "v_order_detail", "v_refund_payment"))
def routed_facts_as_of(spark, sf):
    """The change log routed by the config that held at each change's own time."""
    versions = standins.route_versions(spark, sf, sinks.FACT_ROUTE_FEED)
    out = routing.route_facts_as_of(common.cdc(spark, sf), versions)
    return out.select("sink_table", "source_type", "ts_ms", routing.sorted_kv(F.col("data")).alias("data"))


def _dim_oracle_rows(op_filter: bool) -> str:
    prov_del = f"""
union all
select 'dim_base_province', 'd', cast(province_id as varchar), {_kv_sql(['province_id', 'province_name'])}
from v_province where province_id % 10 = 9""" if not op_filter else ""
    keep = " where province_id % 10 <> 9" if op_filter else ""
    return f"""
select 'dim_base_dic' as sink_table, 'r' as op, dic_code as row_key, {_kv_sql(['dic_code', 'dic_name'])} as data
from v_base_dic
union all
select 'dim_base_province', 'r', cast(province_id as varchar), {_kv_sql(['province_id', 'province_name'])}
from v_province{keep}{prov_del}
union all
select 'dim_sku_info', 'r', cast(sku_id as varchar), {_kv_sql(['sku_id', 'sku_name', 'tm_name', 'category3_id'])}
from v_sku"""


@register("routed_dims", with_views(_dim_oracle_rows(False), "v_base_dic", "v_province", "v_sku"))
def routed_dims(spark, sf):
    """P6 (+P7): config-driven dimension routing: target, row key, op, pruned columns."""
    c = common.cdc(spark, sf)
    out = routing.route_dims(c, sinks.dim_config(sinks.dim_feed(spark)))
    return out.select("sink_table", "op", F.col("data")[F.col("sink_row_key")].alias("row_key"),
                      routing.sorted_kv(F.col("data")).alias("data"))


@register("dim_apply", with_views(f"""
select sink_table, row_key, md5(row_key) as row_md5, data from ({_dim_oracle_rows(True)}) t""",
    "v_base_dic", "v_province", "v_sku"))
def dim_apply(spark, sf):
    """K6: apply routed dimension changes: latest op per row key, deletes removed."""
    c = common.cdc(spark, sf)
    routed = routing.route_dims(c, sinks.dim_config(sinks.dim_feed(spark)))
    state = sinks.apply_dim_changes(routed)
    return state.select("sink_table", "row_key", md5_key(F.col("row_key")).alias("row_md5"),
                        routing.sorted_kv(F.col("data")).alias("data"))


# ------------------------------------------------------------------ K5

@register("day_partition", """
select event_id, event_type, case when event_id % 10 = 3 then 'error_bucket' else strftime(ts, '%Y%m%d') end as day
from events""")
def day_partition(spark, sf):
    """K5: day partition of each record (seconds promoted to ms); rows without time -> ``error_bucket``.

    Events arrive with second times for even ids, ms times for odd ids
    and, every tenth, without a time.
    """
    ts = F.col("ts").cast("timestamp")
    e = table(spark, sf, "events").select("event_id", "event_type", F.when(F.col("event_id") % 10 == 3, None)
                                          .when(F.col("event_id") % 2 == 0, F.unix_seconds(ts))
                                          .otherwise(F.unix_millis(ts)).alias("ts"))
    return sinks.with_day_partition(e, "ts").drop("ts")
