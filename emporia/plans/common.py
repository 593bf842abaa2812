"""Shared inputs of the catalogue queries (stand-in streams as DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators import routing
from emporia.sources import logs, standins


def cdc(spark: SparkSession, sf: str) -> DataFrame:
    """The ODS change log in parsed form (lazy: a fact job plans only the branches of its tables)."""
    return standins.cdc(spark, sf)


def whole_cdc(spark: SparkSession, sf: str) -> DataFrame:
    """The same log for jobs that take every table of it."""
    return standins.whole_cdc(spark, sf)


def cdc_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The change log as a topic would carry it: JSON lines, column ``value``."""
    return whole_cdc(spark, sf).select(F.to_json(F.struct("before", "after", "source", "op", "ts_ms")).alias("value"))


def page_log(spark: SparkSession, sf: str, nested: bool = False) -> DataFrame:
    """The page log as raw JSON, parsed by S2."""
    return logs.read_page_log(spark, standins.page_log_json(spark, sf), nested=nested)


ORDER_DETAIL_COLS = ["id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price",
                     "split_total_amount", "split_activity_amount", "split_coupon_amount"]


def detail_versions(c: DataFrame) -> DataFrame:
    """Every order-detail version from the change log (P1), with its record key."""
    return routing.keyed_source(c, "order_detail", "id", ORDER_DETAIL_COLS, ops=["c", "u", "r"])


def detail_latest(c: DataFrame) -> DataFrame:
    """Order details as the upsert table holds them (K3: last version per id)."""
    return routing.latest_by_key(detail_versions(c).drop("op"), "key", "ts_ms")


def order_info(c: DataFrame) -> DataFrame:
    return routing.fact_source(c, "order_info", ["id", "user_id", "province_id", "create_time", "total_amount",
                                                  "order_status", "type_code"])


def base_dic(c: DataFrame) -> DataFrame:
    return routing.fact_source(c, "base_dic", ["dic_code", "dic_name"], keep_ts=False)


def ms_of(col: str) -> F.Column:
    return F.unix_millis(F.to_timestamp(F.col(col), "yyyy-MM-dd HH:mm:ss"))
