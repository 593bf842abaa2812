"""Operator 8: quality rules and robust multivariate outliers.

Per document five statistics are counted; a document fails the base rule
when it is too short or repeats itself. Of the others, transformed
statistic vectors are fitted per language and source with the minimum
covariance determinant: the share ``support`` of a group whose covariance
has the least determinant.

1. ``STARTS`` subsets per group of ``SUBSET`` rows each, drawn by hash (a
   ``floor`` is added to all variances, so few rows suffice);
2. two concentration steps for each: mean and covariance of the subset,
   then the share ``support`` of all rows that lie nearest;
3. the two starts with the least determinant go on until its logarithm
   moves by less than 0.01, and the lesser one is the estimate;
4. its covariance is brought to the scale of a normal sample (consistency
   factor), rows within the 97.5 % distance are fitted once more, and a row
   is rejected when its squared Mahalanobis distance from that last fit is
   above ``cutoff``.

With ``support`` 0.5, up to nearly half of a group can be odd in the same
way without moving the estimate. Only DataFrame functions; all groups and
starts advance together and a group never meets in one task: sums are
combined before the shuffle, and the nearest rows are taken by a histogram
of the distances.

Vectors are fixed-point integers, so their sums do not depend on the
order of rows. The histogram takes whole bins, so a subset has at least
the stated share. Null text counts as empty, null language or source as
a group of its own; groups with fewer than ``least_rows`` rows are too
small for an estimate. With ``pooled`` they are judged by that of their
language, or of all rows if the language is as small; else they keep
what the base rule keeps. Rows that repeat count as often as they are
there. An empty table gives an empty result; other columns are not looked
at. A text is counted whole in one task, however long it is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import cut, saved

_GAP = r"[\x20\x09-\x0D]+"
SCALE = 256          # fixed-point steps per unit of a transformed statistic
DIMS = 5
BIN = 16             # histogram bins per doubling of the squared distance
SUPPORT = 0.5        # share of a group that the determinant is taken of
SUBSET, STARTS = 3, 24  # rows a start and starts: with 42 % of a group odd, one start in five holds none of them


def statistics(docs: DataFrame, carry: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``carry`` columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(*carry, text.alias("_t"),
                        F.filter(F.split(text, _GAP), lambda w: w != "").alias("_w"),
                        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    three = split.select(
        *carry, F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", _GAP, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(
            F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))).alias("_g"))
    # Texts without a repeated window (most) need no sort.
    kept = [*carry, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    order = three.select(*kept, F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.array_sort(
        F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    twice = order.select(*kept, F.sort_array(F.transform(
        F.filter("_s", lambda x, i: F.coalesce(x["h"] == F.get("_s", i - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get("_s", i + 1)["h"], F.lit(False))), lambda x: x["i"])).alias("_p"))
    # Each window covers its three words; a later window that overlaps adds only the words after.
    covered = F.aggregate(F.transform("_p", lambda p, i: F.least(F.lit(3), F.coalesce(
        F.get("_p", i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return twice.select(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics as fixed-point integers (n_words > 0)."""
    n = F.col("n_words")
    parts = [F.log1p(n) / 2, 2 * F.log(F.col("word_chars") / n), F.log1p(50 * F.col("n_symbols") / F.col("word_chars")),
             F.log1p(100 * F.col("n_dup_lines") / n) / 2, F.log1p(10 * F.col("n_repeat_words") / n)]
    return [F.round(p * SCALE).cast("long").alias(f"x{i}") for i, p in enumerate(parts)]


_X = [f"x{i}" for i in range(DIMS)]
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
_M, _W = [f"m{i}" for i in range(DIMS)], [f"w{i}{j}" for i, j in _PAIRS]
_START = ["lang", "source", "start"]


def _chi2(x: float, k: int) -> float:
    """Distribution function of chi-squared with an odd number of degrees of freedom."""
    total, n = math.erf(math.sqrt(x / 2)), 1
    while n < k:
        total -= (x / 2) ** (n / 2) * math.exp(-x / 2) / math.gamma(n / 2 + 1)
        n += 2
    return total


def _chi2_point(share: float, k: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, k) < share else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of a normal sample is to be multiplied with."""
    return share / _chi2(_chi2_point(share, DIMS), DIMS + 2)


def _few(estimate: DataFrame) -> DataFrame:
    """Checkpoint of a table of groups and starts; read by few tasks, so that its later shuffles write few files."""
    return cut(estimate).coalesce(8)


def _moments(rows: DataFrame) -> DataFrame:
    """Per group and start the count, sums and sums of products, all whole numbers."""
    return rows.groupBy(*_START).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"s_{x}") for x in _X),
        *(F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p_{i}{j}") for i, j in _PAIRS))


def _estimate(moments: DataFrame, floor: float, factor: float = 1.0) -> DataFrame:
    """Mean, inverse Cholesky factor and log-determinant of the covariance, in units of the vector.

    ``floor`` is added to every variance: statistics that are zero in
    nearly all rows would otherwise give a singular covariance.
    """
    out = moments.select(*_START, "n", *(
        (F.col(f"s_{x}") / F.col("n") / SCALE).alias(f"m{i}") for i, x in enumerate(_X)), *(
        (F.lit(factor) * (F.col(f"p_{i}{j}") - F.col(f"s_x{i}").cast("double") * F.col(f"s_x{j}") / F.col("n")) / F.col("n")
         / (SCALE * SCALE) + (F.lit(floor * floor) if i == j else F.lit(0.0))).alias(f"c{i}{j}") for i, j in _PAIRS))
    for i, j in _PAIRS:  # row by row, as the factor is defined
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    out = _few(out)
    for j in range(DIMS):
        for i in range(j, DIMS):
            total = F.lit(1.0 if i == j else 0.0)
            for k in range(j, i):
                total = total - F.col(f"l{i}{k}") * F.col(f"w{k}{j}")
            out = out.withColumn(f"w{i}{j}", total / F.col(f"l{i}{i}"))
    logdet = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(DIMS)), F.lit(0.0))
    return out.select(*_START, *_M, *_W, logdet.alias("logdet"))


def _of_group(a: str = "", b: str = "_") -> Column:
    return (F.col(f"{a}lang").eqNullSafe(F.col(f"{b}lang"))) & (F.col(f"{a}source").eqNullSafe(F.col(f"{b}source")))


def _d2() -> Column:
    """Squared distance of rows that carry their estimate's columns."""
    away = [F.col(f"x{i}") / SCALE - F.col(f"m{i}") for i in range(DIMS)]
    total = F.lit(0.0)
    for i in range(DIMS):
        total = total + F.pow(sum((F.col(f"w{i}{j}") * away[j] for j in range(i + 1)), F.lit(0.0)), 2)
    return total.alias("d2")


def _distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2`` from their group's one estimate; null without one."""
    e = estimate.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *_M, *_W)
    return rows.join(e, _of_group(), "left").select(*rows.columns, _d2())


def _each_start(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Every row once per start of its group, with ``d2``; a group's estimates come to its rows as one array."""
    e = (estimate.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source"))
         .agg(F.collect_list(F.struct("start", *_M, *_W)).alias("_e")))
    out = rows.join(e, _of_group()).select("lang", "source", *_X, F.explode("_e").alias("_e"))
    return out.select("lang", "source", *_X, "_e.*").select(*_START, *_X, _d2())


def _nearest(rows: DataFrame, support: float) -> DataFrame:
    """The rows of the lowest distance bins that together hold the share ``support`` of their group."""
    binned = rows.withColumn("_b", F.floor(F.log2(F.greatest("d2", F.lit(2.0 ** -20))) * BIN).cast("int"))
    w = Window.partitionBy(*_START)
    # At most a few hundred bins per group and start reach the window.
    limit = (binned.groupBy(*_START, "_b").agg(F.count(F.lit(1)).alias("c"))
             .withColumn("upto", F.sum("c").over(w.orderBy("_b"))).withColumn("all", F.sum("c").over(w))
             .filter(F.col("upto") >= F.lit(support) * F.col("all"))
             .groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("start").alias("_start"))
             .agg(F.min("_b").alias("_most")))
    return binned.join(limit, _of_group() & (F.col("start") == F.col("_start"))).filter("_b <= _most").select(*_START, *_X)


def _concentrated(rows: DataFrame, estimate: DataFrame, support: float, floor: float, factor: float = 1.0) -> DataFrame:
    return _estimate(_moments(_nearest(_each_start(rows, estimate), support)), floor, factor)


def _least(estimate: DataFrame, many: int) -> DataFrame:
    """The ``many`` starts of every group with the least determinants."""
    w = Window.partitionBy("lang", "source").orderBy("logdet", "start")
    return estimate.withColumn("_r", F.row_number().over(w)).filter(f"_r <= {many}").drop("_r")


def _first_subsets(rows: DataFrame, starts: int) -> DataFrame:
    """``SUBSET`` rows per group and start: of as many shares of the rows, the one with the least hash."""
    each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(starts - 1))).alias("start")).withColumn("_h", F.xxhash64("_id", "start"))
    return (each.groupBy(*_START, F.pmod("_h", F.lit(SUBSET)).alias("_p")).agg(F.min_by(F.struct(*_X), "_h").alias("_x"))
            .select(*_START, "_x.*"))


def least_determinant(rows: DataFrame, support: float = SUPPORT, starts: int = STARTS, least_rows: int = 50,
                      floor: float = 0.3, most_steps: int = 10) -> DataFrame:
    """The minimum-covariance-determinant estimate of every group with ``least_rows``; rows: lang, source, _id, x0, ..."""
    enough = rows.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(enough.filter(F.col("_n") >= least_rows), _of_group()).select(*rows.columns)
    estimate = _few(_estimate(_moments(_first_subsets(rows, starts)), floor))
    for _ in range(2):
        estimate = _few(_concentrated(rows, estimate, support, floor))
    estimate = _few(_least(estimate, 2))
    for _ in range(most_steps):
        last = estimate
        estimate = _few(_concentrated(rows, last, support, floor))
        before = last.select(*(F.col(c).alias(f"_{c}") for c in (*_START, "logdet")))
        falls = estimate.join(before, _of_group() & (F.col("start") == F.col("_start")))
        if (falls.agg(F.max(F.abs(F.col("_logdet") - F.col("logdet")))).first()[0] or 0) < 0.01:
            break
    return _least(estimate, 1)


def robust_fit(rows: DataFrame, support: float = SUPPORT, starts: int = STARTS, least_rows: int = 50,
               floor: float = 0.3) -> DataFrame:
    """Location and scatter per (lang, source): the least determinant, made consistent, then refitted on the rows within."""
    best = _few(least_determinant(rows, support, starts, least_rows, floor))
    scaled = _few(_concentrated(rows, best, support, floor, consistency(support)))
    inside = _each_start(rows, scaled).filter(F.col("d2") <= _chi2_point(0.975, DIMS))
    return _few(_estimate(_moments(inside), floor, consistency(0.975)))


def for_small_groups(rows: DataFrame, estimate: DataFrame, support: float, starts: int, least_rows: int) -> DataFrame:
    """``estimate`` with one for each of the other groups: that of its language, else that of all rows."""
    known = estimate.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"))
    small = cut(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_n")).join(known, _of_group(), "left_anti"))
    if small.isEmpty():
        return estimate
    none = F.lit(None).cast("string")
    by_lang = robust_fit(rows.withColumn("source", none), support, starts, least_rows)
    of_lang = small.join(by_lang.drop("source").withColumnRenamed("lang", "_lang"),
                         F.col("lang").eqNullSafe(F.col("_lang"))).select(*estimate.columns)
    out = estimate.unionByName(of_lang)
    still = small.join(by_lang.select(F.col("lang").alias("_lang")), F.col("lang").eqNullSafe(F.col("_lang")), "left_anti")
    if still.isEmpty():
        return out
    of_all = robust_fit(rows.withColumn("lang", none).withColumn("source", none), support, starts, 1)
    return out.unionByName(still.crossJoin(of_all.drop("lang", "source")).select(*estimate.columns))


def quality(docs: DataFrame, cutoff: float = 30.0, support: float = SUPPORT, starts: int = STARTS,
            least_rows: int = 50, pooled: bool = False) -> DataFrame:
    """Per row: doc_id, the five statistics, base_failed, kept, d2 (squared distance, null where none applies)."""
    stats = saved(statistics(docs).withColumn("base_failed", base_failed()))
    good = stats.filter(~F.col("base_failed")).select("*", *vector())
    rows = good.select("lang", "source", F.xxhash64("doc_id", *_X).alias("_id"), *_X)
    estimate = robust_fit(rows, support, starts, least_rows)
    if pooled:
        estimate = for_small_groups(rows, estimate, support, starts, least_rows)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = _distance(good, estimate).select(*names, "d2")
    failed = stats.filter("base_failed").select(*names, F.lit(None).cast("double").alias("d2"))
    return judged.unionByName(failed).select(
        *names, (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"), "d2")
