"""Projections, filters and routing over the change log and the page log.

Every function is a narrow transformation (no shuffle) except the
config-driven routers, which join against the current routing config (J16).
The config carries no hint: a routing config of a handful of rows is
broadcast from its measured size, a large one is joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.operators.versions import as_of_join

from emporia.functions.scalars import DATETIME, first_token, ms_to_ts, time_slot

# ------------------------------------------------------------------ P1

def table_col(cdc: DataFrame) -> Column:
    """Source table of a change record: the partition column when the log is
    stored partitioned by table, else ``source['table']``."""
    return F.col("table_name") if "table_name" in cdc.columns else F.col("source")["table"]


def fact_source(cdc: DataFrame, table: str, cols: list[str], ops: list[str] | None = None,
                keep_ts: bool = True) -> DataFrame:
    """Rows of one source table, ``after`` fields promoted to columns.

    When the log is stored partitioned by ``table_name`` the filter is a
    partition filter and the other tables are never read.
    """
    out = cdc.where(table_col(cdc) == table)
    if ops:
        out = out.where(F.col("op").isin(*ops))
    sel = [F.col("after")[c].alias(c) for c in cols]
    if keep_ts:
        sel += [F.col("op"), F.col("ts_ms")]
    return out.select(*sel)


def keyed_source(cdc: DataFrame, table: str, pk: str, cols: list[str], ops: list[str] | None = None,
                 keep_ts: bool = True) -> DataFrame:
    """:func:`fact_source` with the record key as ``key`` (made of the field ``pk`` where records carry none).

    A log dealt by its record key is grouped and joined by it without another shuffle. Null keys are empty:
    where they must not match, leave rows without ``pk`` out.
    """
    if "key" not in cdc.columns:
        cdc = cdc.withColumn("key", F.coalesce(F.coalesce("after", "before")[pk], F.lit("")))
    out = cdc.where(table_col(cdc) == table)
    if ops:
        out = out.where(F.col("op").isin(*ops))
    sel = [F.col("key").alias("key"), *[F.col("after")[c].alias(c) for c in cols]]
    return out.select(*sel, "op", "ts_ms") if keep_ts else out.select(*sel)


def latest_by_key(df: DataFrame, keys: list[str] | str, order: list[str] | str = "ts_ms") -> DataFrame:
    """Last version per key (K3 upsert semantics) as a partial aggregate:
    ``max_by(row, order)`` is combined map-side, so a hot key is reduced
    before the shuffle instead of being sorted in one task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


# ------------------------------------------------------------------ P2 / P3 / P4

def is_object(value: Column) -> Column:
    """Whether a line is a JSON object (not a number, string, list or broken text); null is not."""
    kind = F.schema_of_variant(F.try_parse_json(value))
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def split_dirty(raw: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, dirty) -- a record is dirty when it is not a JSON object."""
    ok = is_object(F.col(col))
    return raw.where(ok), raw.where(~ok)


def drop_bootstrap(cdc: DataFrame) -> DataFrame:
    """Drop bootstrap markers (``op`` starting with ``bootstrap-``)."""
    return cdc.where(~F.coalesce(F.col("op").startswith("bootstrap-"), F.lit(False)))


def dim_etl(cdc: DataFrame, db: str) -> DataFrame:
    """The dimension job's record filter."""
    return cdc.where((F.col("source")["db"] == db)
                     & F.col("op").isin("c", "u", "d", "r")
                     & (F.length(F.col("ts_ms").cast("string")) > 2))


# ------------------------------------------------------------------ P5 / P6 / P7

def current_config(changes: DataFrame, key_cols: list[str]) -> DataFrame:
    """Latest config row per key from its change feed; a delete removes the key.

    The payload is ``before`` for a delete and ``after`` otherwise.
    """
    payload = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    rows = changes.select(payload.alias("cfg"), "op", "ts_ms")
    rows = rows.select(*[F.col("cfg")[k].alias(k) for k in key_cols], "cfg", "op", "ts_ms")
    latest = latest_by_key(rows, key_cols, "ts_ms")
    return latest.where(F.col("op") != "d").drop("op", "ts_ms")


def _prune(m: Column, cols_csv: Column) -> Column:
    """Keep the map entries whose key is listed in a comma list."""
    allowed = F.split(cols_csv, ",")
    return F.map_filter(m, lambda k, v: F.array_contains(allowed, k))


def route_facts(cdc: DataFrame, config: DataFrame) -> DataFrame:
    """P5: keep change rows configured for a fact table (key ``table:op``
    with snapshot ``r`` read as insert ``c``), prune to the configured
    columns, attach the target table and ``ts_ms``.

    ``config``: ``source_table, source_type, sink_table, sink_columns``.
    """
    op = F.when(F.col("op") == "r", F.lit("c")).otherwise(F.col("op"))
    rows = cdc.select(table_col(cdc).alias("source_table"), op.alias("source_type"),
                      F.coalesce("after", "before").alias("data"), "ts_ms")
    cfg = config.select("source_table", "source_type", "sink_table", "sink_columns")
    out = rows.join(cfg, ["source_table", "source_type"])
    return out.select("sink_table", "source_table", "source_type",
                      _prune(F.col("data"), F.col("sink_columns")).alias("data"), "ts_ms")


def route_facts_as_of(cdc: DataFrame, versions: DataFrame) -> DataFrame:
    """P5 with J16's connected config: every change is routed by the config that held at its own time.

    ``versions``: ``source_table, source_type, sink_table, sink_columns, ts_ms, deleted``. Changes that no
    version routes leave first (the keys of the config are sent to the tasks), and the others keep only the
    columns that some version of their route lists.
    """
    keys = ["source_table", "source_type"]
    listed = versions.where(~F.coalesce(F.col("deleted"), F.lit(False))).groupBy(*keys).agg(
        F.concat_ws(",", F.collect_set("sink_columns")).alias("_listed"))
    op = F.when(F.col("op") == "r", F.lit("c")).otherwise(F.col("op"))
    rows = cdc.select(table_col(cdc).alias("source_table"), op.alias("source_type"),
                      F.coalesce("after", "before").alias("data"), "ts_ms")
    rows = rows.join(F.broadcast(listed), keys).select(*keys, _prune(F.col("data"), F.col("_listed")).alias("data"), "ts_ms")
    out = as_of_join(rows, versions, keys, deleted="deleted")
    return out.select("sink_table", "source_table", "source_type", _prune(F.col("data"), F.col("sink_columns")).alias("data"), "ts_ms")


def route_dims(cdc: DataFrame, config: DataFrame) -> DataFrame:
    """Keep change rows of configured dimension tables, prune the
    columns, attach ``op`` and the target (row key column, family)."""
    rows = cdc.select(table_col(cdc).alias("source_table"), "op",
                      F.coalesce("after", "before").alias("data"), "ts_ms")
    cfg = config.select("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
    out = rows.join(cfg, "source_table")
    return out.select("sink_table", "sink_family", "sink_row_key", "op",
                      _prune(F.col("data"), F.col("sink_columns")).alias("data"), "ts_ms")


# ------------------------------------------------------------------ P8

def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """Five outputs of the parsed page log.

    ``err``: every record with an ``err`` object (whole record);
    ``start``: records with ``start``; the rest are pages: ``display``
    and ``action`` explode their arrays (with common, page, ts -- actions
    carry no ts), ``page`` drops err, displays and actions.
    """
    err = log.where(F.col("err").isNotNull())
    start = log.where(F.col("start").isNotNull())
    pages = log.where(F.col("start").isNull())
    ident = [c for c in ("event_id",) if c in log.columns]
    display = pages.select(*ident, "common", "page", F.explode("displays").alias("display"), "ts")
    action = pages.select(*ident, "common", "page", F.explode("actions").alias("action"))
    page = pages.drop("err", "displays", "actions", "start")
    return {"err": err, "start": start, "page": page, "display": display, "action": action}


# ------------------------------------------------------------------ P9-P12

def home_or_detail(page_id: Column | None = None) -> Column:
    """P9."""
    return (page_id if page_id is not None else F.col("page_id")).isin("home", "good_detail")


def is_login(uid: str = "uid", last_page: str = "last_page_id") -> Column:
    """P10: a user id and a last page of ``login`` or none."""
    lp = F.col(last_page)
    return (F.col(uid).isNotNull() & (F.col(uid) != "")
            & ((lp == "login") | lp.isNull() | (lp == "")))


def is_search(last_page: str = "last_page_id", item_type: str = "item_type", item: str = "item") -> Column:
    """P11."""
    return (F.col(last_page) == "search") & (F.col(item_type) == "keyword") & F.col(item).isNotNull()


def has_key(*cols: str) -> Column:
    """Every key column present and non-empty."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return out


# ------------------------------------------------------------------ P13-P19

def user_base(users: DataFrame, as_of: str) -> DataFrame:
    """Rename, default gender ``home``, birthday-derived fields (H5-H8)."""
    from emporia.functions.scalars import age_on, decade, epoch_day_to_date, zodiac
    bday = epoch_day_to_date(F.col("birthday_epoch_day"))
    return users.select(
        F.col("uid"), F.col("uname"),
        F.coalesce(F.col("gender"), F.lit("home")).alias("gender"),
        F.date_format(bday, "yyyy-MM-dd").alias("birthday"),
        age_on(bday, as_of).alias("age"),
        decade(bday).alias("decade"),
        zodiac(bday).alias("constellation"),
        F.col("ts_ms"))


def user_sup(sup: DataFrame) -> DataFrame:
    """Height and weight with their units."""
    return sup.select("uid", F.concat(F.col("height").cast("string"), F.col("unit_height")).alias("height"),
                      F.concat(F.col("weight").cast("string"), F.col("unit_weight")).alias("weight"), "ts_ms")


def device_search(page: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Device fields and the search item (keyword items only); ``os``
    is its first token, a missing uid becomes ``home``; session, device id
    and new-visitor flag are dropped."""
    uid = F.when(F.col("uid").isNull() | (F.col("uid") == ""), F.lit("home")).otherwise(F.col("uid"))
    item = F.when(F.col("item_type") == "keyword", F.col("item"))
    return page.select(uid.alias("uid"), F.col("ar"), F.col("ba"), F.col("ch"), F.col("md"),
                       first_token(F.col("os")).alias("os"), item.alias("search_item"), F.col("ts_ms"),
                       *[F.col(c) for c in keep])


def order_base(orders: DataFrame) -> DataFrame:
    """Order projection with the pay-time slot (H9, session zone)."""
    ts = F.to_timestamp(F.col("create_time"), DATETIME)
    return orders.select("id", "user_id", "total_amount", "create_time",
                         time_slot(ts).alias("pay_time_slot"), "ts_ms")


def detail_base(details: DataFrame) -> DataFrame:
    """Order-detail projection: keys and counts as numbers, amounts as
    given, creation time in epoch ms."""
    return details.select(
        "id", "order_id", F.col("sku_id").cast("bigint").alias("sku_id"), "sku_name",
        F.col("sku_num").cast("bigint").alias("sku_num"), "order_price", "split_activity_amount",
        "split_coupon_amount", "split_total_amount",
        F.unix_millis(F.to_timestamp(F.col("create_time"), DATETIME)).alias("create_ms"), "ts_ms")


COMMENT_FIELDS = ["id", "user_id", "sku_id", "order_id", "appraise", "comment_txt"]


def comment_base(cdc: DataFrame, table: str) -> DataFrame:
    """Comment changes that carry a new row: origin (db, table, server id), op, time, comment fields."""
    rows = cdc.where((table_col(cdc) == table) & F.col("after").isNotNull())
    return rows.select(*[F.col("source")[k].alias(n) for k, n in
                         (("db", "db"), ("table", "table_name"), ("server_id", "server_id"))],
                       "op", "ts_ms", *[F.col("after")[c].alias(c) for c in COMMENT_FIELDS])


def change_flat(cdc: DataFrame) -> DataFrame:
    """``after`` unless empty, else ``before``; op and ts kept."""
    after_empty = F.col("after").isNull() | (F.size("after") == 0)
    data = F.when(after_empty, F.col("before")).otherwise(F.col("after"))
    return cdc.select(table_col(cdc).alias("table_name"), "op", "ts_ms", data.alias("data"))


def with_ds(df: DataFrame, ms_col: str = "ts_ms") -> DataFrame:
    """Day string ``ds`` (yyyyMMdd)."""
    return df.withColumn("ds", F.date_format(ms_to_ts(F.col(ms_col)), "yyyyMMdd"))


def sorted_kv(m: Column) -> Column:
    """Canonical text of a string map: ``k=v`` pairs sorted by key, ``;``-joined."""
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ";")
