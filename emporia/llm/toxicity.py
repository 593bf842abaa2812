"""Operator 5: toxicity by a classifier chain.

Categories are predicted in a fixed order by logistic models over the
presence of words and of 4- and 5-byte strings inside words. A later
model also sees the probabilities of the earlier categories; for its
training these come from models that did not see the row (out of fold).
Models are fitted on a bounded sample of labelled rows (``most_labels``,
those with the smallest hash of doc_id, so the same at every layout) and
on the ``features`` strings per category that separate its rows best.
Every whole text is scored.

Null or empty text has no feature and gets the models' base rate. Rows
of ``docs`` are scored one by one, so repeated ids or rows stay. Labels
with null are left out; of a repeated doc_id the largest labels count;
without labels of both kinds a category has its base rate and rejects
nothing. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import SMALL_STEP, saved, steps
from emporia.llm.hashing import _SPACE, BYTE_LOWER, U, Prefix, mix, words

SIZES = (4, 5)
FOLDS = 5


def features(buf: np.ndarray, offs: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the words and strings in words of every row; distinct, sorted by row and hash.

    With ``wanted`` (sorted hashes) only those.
    """
    if not len(buf):
        return np.zeros(0, U), np.zeros(0, np.int64)
    if wanted is not None:
        sieve = np.zeros(1 << 20, bool)
        sieve[(wanted >> U(44)).astype(np.int64)] = True
    prefix = Prefix(buf, BYTE_LOWER)
    s, e, row = words(buf, offs)
    found = [(prefix.of(s, e), row)]
    gap = np.concatenate([[0], np.cumsum(_SPACE[buf])])
    for n in SIZES:
        if len(buf) < n:
            continue
        h = mix(prefix.fixed(n), n)
        inside = gap[n:] == gap[:-n]
        if wanted is not None:
            inside &= sieve[(h >> U(44)).astype(np.int64)]
        at = np.flatnonzero(inside)
        row = np.searchsorted(offs, at, "right") - 1
        same = at + n <= offs[row + 1]
        found.append((h[at[same]], row[same]))
    h, row = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
    if wanted is not None:
        place = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
        keep = wanted[place] == h
        h, row = h[keep], row[keep]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


@dataclass
class Chain:
    """Fitted models: ``weights[k]`` over [features, earlier probabilities, 1] of category ``names[k]``."""

    names: list[str]
    wanted: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def predict(self, h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Probabilities, rows x categories."""
        column = np.searchsorted(self.wanted, h)
        out = np.zeros((rows, len(self.names)))
        n = len(self.wanted)
        for k, w in enumerate(self.weights):
            score = np.bincount(row, w[column], minlength=rows) + out[:, :k] @ w[n:n + k] + w[n + k]
            out[:, k] = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        return out


@dataclass
class Presence:
    """Rows x features of zeros and ones, as the places of the ones."""

    row: np.ndarray
    column: np.ndarray
    rows: int
    columns: int

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.rows)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, r[self.row], self.columns)

    def take(self, keep: np.ndarray) -> "Presence":
        """The rows where ``keep`` is true."""
        number = np.cumsum(keep) - 1
        on = keep[self.row]
        return Presence(number[self.row[on]], self.column[on], int(keep.sum()), self.columns)


def logistic(x: Presence, more: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 8) -> np.ndarray:
    """Weights of a ridge logistic regression over [x, more] by Newton steps, each solved by conjugate gradients.

    The last column of ``more`` is the constant and not shrunk.
    """
    n = x.columns
    shrink = np.full(n + more.shape[1], ridge)
    shrink[-1] = 1e-6
    w = np.zeros(len(shrink))
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))

    def dot(v: np.ndarray) -> np.ndarray:
        return x.dot(v[:n]) + more @ v[n:]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate([x.back(r), more.T @ r])

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(dot(w), -30, 30)))
        g = back(p - y) + shrink * w
        if np.abs(g).max() < 1e-4 * len(y):
            break
        d = p * (1 - p)
        scale = np.concatenate([x.back(d), (more * more).T @ d]) + shrink + 1e-9
        step, rest = np.zeros(len(w)), g.copy()
        z = rest / scale
        way, size = z.copy(), rest @ z
        first = size
        for _ in range(20):
            h = back(d * dot(way)) + shrink * way
            a = size / (way @ h)
            step += a * way
            rest -= a * h
            z = rest / scale
            new = rest @ z
            if new < 1e-4 * first:
                break
            way, size = z + (new / size) * way, new
        w = w - step
    return w


def threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1 on out-of-fold probabilities; halfway to the next row below."""
    if not y.any() or y.all():
        return 1.1
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    last = np.ones(len(p), bool)
    last[:-1] = p[:-1] != p[1:]
    hit = np.cumsum(y)
    f1 = np.where(last, 2 * hit / (np.arange(1, len(p) + 1) + y.sum()), -1)
    k = int(np.argmax(f1))
    return float((p[k] + (p[k + 1] if k + 1 < len(p) else 0)) / 2)


def fit_chain(names: list[str], wanted: np.ndarray, x: Presence, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """``labels``: rows x categories in chain order."""
    chain = Chain(names, wanted)
    more = np.ones((x.rows, 1))  # earlier probabilities, then the constant
    for k in range(len(names)):
        y = labels[:, k].astype(float)
        apart = np.full(x.rows, y.mean() if len(y) else 0.0)
        for f in range(FOLDS):
            train = fold != f
            if train.any() and not train.all() and 0 < y[train].sum() < train.sum():
                w = logistic(x.take(train), more[train], y[train])
                score = x.take(~train).dot(w[:x.columns]) + more[~train] @ w[x.columns:]
                apart[~train] = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        if 0 < y.sum() < len(y):
            chain.weights.append(logistic(x, more, y))
            chain.thresholds.append(threshold(apart, labels[:, k] > 0))
        else:
            w = np.zeros(x.columns + more.shape[1])
            w[-1] = 30.0 if len(y) and y.all() else -30.0
            chain.weights.append(w)
            chain.thresholds.append(1.1)
        more = np.hstack([more[:, :-1], apart[:, None], more[:, -1:]])
    return chain


def train(docs: DataFrame, labels: DataFrame, names: list[str], most_labels: int = 16384, per_category: int = 1200,
          least_rows: int = 3) -> Chain:
    """Fit the chain for the 0/1 columns ``names`` of ``labels``; the driver sees the chosen features of the sample only."""
    clean = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(*(F.max(F.col(n).cast("int")).alias(f"_y{k}") for k, n in enumerate(names)))
             .dropna().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels))
    # At most most_labels rows of a few bytes: the texts are found without a shuffle.
    sample = saved(docs.select("doc_id", "text").join(F.broadcast(clean), "doc_id")
                   .withColumn("_fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")))
    ys = [f"_y{k}" for k in range(len(names))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.stack([batch.column(y).to_numpy(zero_copy_only=False) for y in ys], axis=1)
            for i, j, buf, offs in steps(batch, most=SMALL_STEP):
                h, row = features(buf, offs)
                keys, inverse = np.unique(h, return_inverse=True)
                cols = [keys.view(np.int64), np.bincount(inverse, minlength=len(keys))]
                cols += [np.bincount(inverse, label[i:j, k][row], len(keys)).astype(np.int64) for k in range(len(ys))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "n", *ys])

    totals = sample.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(y), F.lit(0)).alias(y) for y in ys)).first()
    counts = (sample.mapInArrow(count, "h bigint, n bigint, " + ", ".join(f"{y} bigint" for y in ys))
              .groupBy("h").agg(*(F.sum(c).alias(c) for c in ("n", *ys))).filter(F.col("n") >= least_rows))
    chosen: set[int] = set()
    for y in ys:
        pos, neg = totals[y], totals["n"] - totals[y]
        if pos and neg:
            # How much the string tells about the category: the likelihood ratio against independence.
            total = float(totals["n"])
            tell = F.lit(0.0)
            for both, of_rows, of_kind in (
                    (F.col(y), F.col("n"), pos), (F.col("n") - F.col(y), F.col("n"), neg),
                    (pos - F.col(y), total - F.col("n"), pos), (neg - F.col("n") + F.col(y), total - F.col("n"), neg)):
                tell = tell + F.when(both > 0, both * F.log(both * total / (of_rows * F.lit(float(of_kind))))).otherwise(0.0)
            score = F.round(tell, 9)
            chosen.update(r["h"] for r in counts.orderBy(score.desc(), "h").limit(per_category).select("h").collect())
    wanted = np.sort(np.array(sorted(chosen), np.int64).view(U)) if chosen else np.zeros(1, U)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in steps(batch, most=SMALL_STEP):
                h, row = features(buf, offs, wanted)
                column = np.searchsorted(wanted, h).astype(np.int32)
                ends = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(column)),
                     *(batch.column(c).slice(i, j - i) for c in ("_fold", *ys))], names=["doc_id", "f", "_fold", *ys])

    got = sample.mapInArrow(rows, "doc_id bigint, f array<int>, _fold int, "
                            + ", ".join(f"{y} int" for y in ys)).orderBy("doc_id").collect()
    count = np.array([len(r["f"]) for r in got], np.int64)
    column = np.concatenate([np.zeros(0, np.int64), *(np.array(r["f"], np.int64) for r in got)])
    x = Presence(np.repeat(np.arange(len(got)), count), column, len(got), len(wanted))
    label = np.array([[r[y] for y in ys] for r in got], int).reshape(len(got), len(ys))
    return fit_chain(names, wanted, x, label, np.array([r["_fold"] for r in got], int))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """Per row of ``docs``: doc_id, p_<category> for every category, <last category> as boolean."""
    target = chain.names[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in steps(batch, most=SMALL_STEP):
                p = chain.predict(*features(buf, offs, chain.wanted), j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), *(pa.array(p[:, k].copy()) for k in range(p.shape[1])),
                     pa.array(p[:, -1] >= chain.thresholds[-1])],
                    names=["doc_id", *(f"p_{n}" for n in chain.names), target])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"p_{n} double" for n in chain.names) + f", {target} boolean")


#: Chain order over the label table: low quality first, its probability helps toxicity.
CATEGORIES = ["low_quality", "toxic"]


def label_columns(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic").alias("toxic"))


def toxicity(docs: DataFrame, labels: DataFrame, most_labels: int = 16384) -> DataFrame:
    """Train on the labelled rows of ``docs`` and score all of them."""
    return score(docs, train(docs, label_columns(labels), CATEGORIES, most_labels))


def reject_toxic(docs: DataFrame, labels: DataFrame, most_labels: int = 16384) -> DataFrame:
    """``docs`` without the rows judged toxic; all columns stay."""
    chain = train(docs, label_columns(labels), CATEGORIES, most_labels)
    cols = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in steps(batch, most=SMALL_STEP):
                p = chain.predict(*features(buf, offs, chain.wanted), j - i)
                yield batch.slice(i, j - i).filter(pa.array(p[:, -1] < chain.thresholds[-1]))

    return docs.mapInArrow(run, docs.schema).select(*cols)
