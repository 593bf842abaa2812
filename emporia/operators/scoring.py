"""User-profile scoring models (M1-M7).

Every score is ``round(weight x coefficient, 3)`` for six age bands. The
weights live in one small table keyed by (score, value); scoring is a
join against it (broadcast: its size is fixed by the model, a few dozen
rows) followed by one projection per band. Arithmetic is decimal, so the
rounding is exact half-up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions.scalars import round3

# The six age bands, in order.
BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

# Coefficient of each score.
COEFFICIENTS = {"device": "0.1", "search": "0.15", "pay_time": "0.1", "amount": "0.15", "brand": "0.2",
                "category": "0.3"}

# Weights before the coefficient, in band order.
WEIGHTS = [
    ("device", "iOS", "0.7", "0.6", "0.5", "0.4", "0.3", "0.2"),
    ("device", "Android", "0.8", "0.7", "0.6", "0.5", "0.4", "0.3"),
    ("search", "时尚与潮流", "0.9", "0.7", "0.5", "0.3", "0.2", "0.1"),
    ("search", "性价比", "0.2", "0.4", "0.6", "0.7", "0.8", "0.8"),
    ("search", "健康与养生", "0.2", "0.4", "0.6", "0.7", "0.8", "0.8"),
    ("search", "家庭与育儿", "0.1", "0.2", "0.4", "0.6", "0.8", "0.7"),
    ("search", "科技与数码", "0.8", "0.6", "0.4", "0.3", "0.2", "0.1"),
    ("search", "学习与发展", "0.4", "0.5", "0.6", "0.7", "0.8", "0.7"),
    ("pay_time", "凌晨", "0.2", "0.1", "0.1", "0.1", "0.1", "0.1"),
    ("pay_time", "早晨", "0.1", "0.1", "0.1", "0.1", "0.2", "0.3"),
    ("pay_time", "上午", "0.2", "0.2", "0.2", "0.2", "0.3", "0.4"),
    ("pay_time", "中午", "0.4", "0.4", "0.4", "0.4", "0.4", "0.3"),
    ("pay_time", "下午", "0.4", "0.5", "0.5", "0.5", "0.5", "0.4"),
    ("pay_time", "晚上", "0.8", "0.7", "0.6", "0.5", "0.4", "0.3"),
    ("pay_time", "夜间", "0.9", "0.7", "0.5", "0.3", "0.2", "0.1"),
    ("amount", "lt_1000", "0.8", "0.6", "0.4", "0.3", "0.2", "0.1"),
    ("amount", "1000_4000", "0.2", "0.4", "0.6", "0.7", "0.8", "0.7"),
    ("amount", "other", "0.1", "0.2", "0.3", "0.4", "0.5", "0.6"),
    ("brand", "TCL", "0.2", "0.3", "0.4", "0.5", "0.6", "0.7"),
    ("brand", "苹果", "0.9", "0.8", "0.7", "0.7", "0.7", "0.5"),
    ("brand", "联想", "0.9", "0.8", "0.7", "0.7", "0.7", "0.5"),
    ("brand", "小米", "0.9", "0.8", "0.7", "0.7", "0.7", "0.5"),
    ("brand", "欧莱雅", "0.5", "0.6", "0.8", "0.8", "0.9", "0.2"),
    ("brand", "香奈儿", "0.3", "0.4", "0.6", "0.8", "0.9", "0.2"),
    ("brand", "other", "0.1", "0.2", "0.3", "0.4", "0.5", "0.6"),
    ("category", "数码", "0.9", "0.8", "0.6", "0.4", "0.2", "0.1"),
    ("category", "手机", "0.9", "0.8", "0.6", "0.4", "0.2", "0.1"),
    ("category", "电脑办公", "0.9", "0.8", "0.6", "0.4", "0.2", "0.1"),
    ("category", "个护化妆", "0.9", "0.8", "0.6", "0.4", "0.2", "0.1"),
    ("category", "服饰内衣", "0.9", "0.8", "0.6", "0.4", "0.2", "0.1"),
    ("category", "家居家装", "0.2", "0.4", "0.6", "0.8", "0.9", "0.7"),
    ("category", "图书、音像、电子书刊", "0.2", "0.4", "0.6", "0.8", "0.9", "0.7"),
    ("category", "厨具", "0.2", "0.4", "0.6", "0.8", "0.9", "0.7"),
    ("category", "鞋靴", "0.2", "0.4", "0.6", "0.8", "0.9", "0.7"),
    ("category", "母婴", "0.2", "0.4", "0.6", "0.8", "0.9", "0.7"),
    ("category", "汽车用品", "0.2", "0.4", "0.6", "0.8", "0.9", "0.7"),
    ("category", "珠宝", "0.2", "0.4", "0.6", "0.8", "0.9", "0.7"),
    ("category", "家用电器", "0.2", "0.4", "0.6", "0.8", "0.9", "0.7"),
    ("category", "other", "0.1", "0.2", "0.4", "0.5", "0.8", "0.9"),
]

# Scores that fall back to their "other" row for an unknown value (an
# absent value -- null -- still gets no score).
WITH_DEFAULT = {"amount", "brand", "category"}


def weight_table(spark: SparkSession) -> DataFrame:
    """Wide weight table: ``score, value, w_<band>...`` (decimal(4,2))."""
    rows = [(s, v, *[Decimal(x) for x in w]) for s, v, *w in WEIGHTS]
    schema = "score string, value string, " + ", ".join(f"w_{b} decimal(4,2)" for b in BANDS)
    return spark.createDataFrame(rows, schema)


def amount_band(amount: Column) -> Column:
    """M4 value: < 1000; strictly between 1000 and 4000; otherwise (1000 itself is "other")."""
    return (F.when(amount < 1000, F.lit("lt_1000"))
            .when((amount > 1000) & (amount < 4000), F.lit("1000_4000"))
            .otherwise(F.lit("other")))


def score(df: DataFrame, name: str, value: Column, spark: SparkSession | None = None,
          prefix: str | None = None) -> DataFrame:
    """Add ``<prefix>_<band>`` columns for score ``name`` from ``value``.

    Unknown values score 0 for ``search``, fall back to ``other`` for the
    scores in ``WITH_DEFAULT`` and stay null (no score) otherwise; a null
    value never scores.
    """
    spark = spark or df.sparkSession
    prefix = prefix or name
    coef = F.lit(Decimal(COEFFICIENTS[name])).cast("decimal(4,2)")
    w = weight_table(spark).where(F.col("score") == name).drop("score")
    known = [v for s, v, *_ in WEIGHTS if s == name]
    val = value
    if name in WITH_DEFAULT:
        val = F.when(value.isNull(), F.lit(None)).when(value.isin(*known), value).otherwise(F.lit("other"))
    x = df.withColumn("_sv", val).join(F.broadcast(w.withColumnRenamed("value", "_sv")), "_sv", "left")
    for b in BANDS:
        s = round3(F.col(f"w_{b}") * coef)
        if name == "search":
            s = F.coalesce(s, F.lit(0).cast("decimal(4,2)"))
        x = x.withColumn(f"{prefix}_{b}", s.cast("double"))
    return x.drop("_sv", *[f"w_{b}" for b in BANDS])


def age_level(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """M7: sum the scores per band (missing = 0), keep the band with the
    largest sum; the first band wins a tie."""
    sums = []
    for b in BANDS:
        total = None
        for p in prefixes:
            term = F.coalesce(F.col(f"{p}_{b}").cast("decimal(10,3)"), F.lit(0).cast("decimal(10,3)"))
            total = term if total is None else total + term
        sums.append(total)
    arr = F.array(*sums)
    idx = F.array_position(arr, F.array_max(arr))
    x = df
    for b, s in zip(BANDS, sums):
        x = x.withColumn(f"total_{b}", s.cast("double"))
    return x.withColumn("age_level", F.element_at(F.array(*[F.lit(b) for b in BANDS]), idx.cast("int")))
