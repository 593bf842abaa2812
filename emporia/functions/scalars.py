"""Scalar column functions (Column -> Column).

All are compositions of built-in Spark SQL functions, so they stay inside
whole-stage code generation. Zone-dependent ones follow the session zone
(``spark.sql.session.timeZone``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------- time (H1-H3)

DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
DAY_KEY = "yyyyMMdd"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(_c(ms))


def ms_to_date(ms) -> Column:
    """H1: epoch ms -> 'yyyy-MM-dd'."""
    return F.date_format(ms_to_ts(ms), DATE)


def ms_to_datetime(ms) -> Column:
    """H1: epoch ms -> 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(ms_to_ts(ms), DATETIME)


def ms_to_day_key(ms) -> Column:
    """H1: epoch ms -> 'yyyyMMdd'."""
    return F.date_format(ms_to_ts(ms), DAY_KEY)


def datetime_to_ms(s, fmt: str = DATETIME) -> Column:
    """H2: 'yyyy-MM-dd HH:mm:ss' (or a date) string -> epoch ms."""
    return F.unix_millis(F.to_timestamp(_c(s), fmt))


def reformat(s, fmt: str = DATE) -> Column:
    """H3: SQL ``date_format`` over a time string."""
    return F.date_format(F.to_timestamp(_c(s)), fmt)


def ms_to_day(ms) -> Column:
    """Calendar day (DATE) of an epoch-ms instant."""
    return F.to_date(ms_to_ts(ms))


# ------------------------------------------------------------ numbers

def amount_product(a, b) -> Column:
    """H4: decimal(16,2) x decimal(16,2), exact (decimal(33,4))."""
    return _c(a).cast("decimal(16,2)") * _c(b).cast("decimal(16,2)")


def round3(x) -> Column:
    """Round to 3 decimals, half up."""
    return F.round(_c(x), 3)


def negate(x) -> Column:
    """Sign flip of an amount; null stays null."""
    return -_c(x)


# ------------------------------------------------------------ profile (H5-H9)

def epoch_day_to_date(n) -> Column:
    """H5: days since 1970-01-01 -> DATE."""
    return F.date_from_unix_date(_c(n).cast("int"))


def age_on(birthday, as_of: str) -> Column:
    """H6: whole years between ``birthday`` and the day ``as_of`` ('yyyy-MM-dd'):
    the year difference, less one when the birthday is still to come."""
    d, b = F.lit(as_of).cast("date"), _c(birthday)
    md = lambda x: F.month(x) * 100 + F.dayofmonth(x)
    return (F.year(d) - F.year(b) - F.when(md(d) < md(b), 1).otherwise(0)).cast("int")


def decade(birthday) -> Column:
    """H7: decade of birth (1990, 2000, ...)."""
    return (F.floor(F.year(_c(birthday)) / 10) * 10).cast("int")


# Zodiac signs and the month*100+day on which each begins.
ZODIAC_STARTS = [
    (120, "水瓶座"), (219, "双鱼座"), (321, "白羊座"), (420, "金牛座"), (521, "双子座"), (622, "巨蟹座"),
    (723, "狮子座"), (823, "处女座"), (923, "天秤座"), (1024, "天蝎座"), (1123, "射手座"), (1222, "摩羯座"),
]


def zodiac(birthday) -> Column:
    """H8: zodiac sign from month and day (Capricorn wraps the year end)."""
    md = F.month(_c(birthday)) * 100 + F.dayofmonth(_c(birthday))
    out = F.when(md < ZODIAC_STARTS[0][0], F.lit("摩羯座"))
    for (lo, name), (hi, _) in zip(ZODIAC_STARTS, ZODIAC_STARTS[1:] + [(1232, None)]):
        out = out.when((md >= lo) & (md < hi), F.lit(name))
    return out


# Time-of-day slots and the hour at which each ends.
TIME_SLOTS = [(6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上"), (24, "夜间")]


def time_slot(ts) -> Column:
    """H9: slot of the day for a timestamp (session zone)."""
    h = F.hour(_c(ts))
    out = None
    for end, name in TIME_SLOTS:
        out = F.when(h < end, F.lit(name)) if out is None else out.when(h < end, F.lit(name))
    return out


# ------------------------------------------------------------ strings

def first_token(s, sep: str = " ") -> Column:
    """First token of a split string."""
    return F.split(_c(s), sep).getItem(0)


def last_token(s, sep: str = ",") -> Column:
    """Last non-empty token (trailing separators are stripped first)."""
    stripped = F.regexp_replace(_c(s), f"(?:{sep})+$", "")
    return F.element_at(F.split(stripped, sep), -1)


def md5_key(s) -> Column:
    """MD5 row key."""
    return F.md5(_c(s).cast("string"))


def hash_bucket(s, buckets: int, fixed: dict[str, str] | None = None) -> Column:
    """bucket = (last 3 hex digits of md5) mod n, rendered with 4 digits.

    ``fixed`` pins known hot keys (lower-cased) to their own buckets, so a
    salt never sends a hot key to a shared bucket.
    """
    n = F.conv(F.substring(F.md5(_c(s).cast("string")), -3, 3), 16, 10).cast("int")
    out = F.lpad((n % buckets).cast("string"), 4, "0")
    if fixed:
        pinned = F.create_map(*[F.lit(x) for kv in fixed.items() for x in kv])
        out = F.coalesce(F.element_at(pinned, F.lower(_c(s).cast("string"))), out)
    return out


def snake_case(name: str) -> str:
    """camelCase field name -> snake_case."""
    out = []
    for ch in name:
        if ch.isupper():
            out.append("_" + ch.lower())
        else:
            out.append(ch)
    return "".join(out).lstrip("_")
