"""Named queries and their SQL oracles.

``@register(name, oracle)`` records a query builder ``(spark, sf_dir) ->
DataFrame`` with the DuckDB SQL that must give the same rows. The
oracle is optional: queries whose semantics SQL cannot state are
checked against a brute-force fixture in the tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Catalogue queries read zone-less timestamps as UTC, like the oracle."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco
