"""Operator 10: language-model scores with stupid backoff.

Every word is scored by the longest n-gram ending at it that other
documents hold: S = count(n-gram) / count(its first n-1 words), times
``ALPHA`` for every shorter step taken; a single word by its share of
all words; a word that no other document holds counts as one more step
over a share of 1 / (words + 1). Counts are over all other rows: a row's
own n-grams are taken off, else a text would always find itself. The
document score is the sum of the logarithms.

Relational form: documents are dealt into batches of about
``batch_bytes``. An n-gram that one batch alone holds needs no table, as
its count there is the count of the corpus. So batches first send the
upper bits of the hashes of their distinct n-grams (enough bits that few
are equal by chance) to tables partitioned by the range of the hash,
which answer with a bit each: met in another batch or not. Only those
met again are sent whole with their count in the batch; there the counts
of all batches are summed, and the answers go back to the batch, where
each document's sum is made. Upper bits that are equal by chance only
send an n-gram more. n-grams travel as sorted hashes in packed runs
(differences as Rice codes), so no row per occurrence is shuffled. A
frequent n-gram is one entry per batch, never a hot key. A batch and a
table partition are held whole by one task; both are bounded by their
number, which grows with the corpus.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lowered; n-grams do not cross
rows. Null or empty text: no words, score 0, null mean. Every row gets a
score, repeated rows too (they are "other documents" for each other).
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import steps
from emporia.llm.hashing import U, grams, word_hashes

ALPHA = 0.4
ORDER = 2


def planes(x: np.ndarray) -> bytes:
    """Little-endian bytes, all lowest bytes first, then the next ones."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def packed(x: np.ndarray, base: int = 0) -> bytes:
    """Sorted numbers from ``base`` on: Rice codes of their differences."""
    if not len(x):
        return b""
    gap = np.diff(x, prepend=U(base))
    k = max(0, (int(x[-1] - U(base)) // len(x)).bit_length() - 1)
    low = np.unpackbits(gap.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - k:]
    ends = np.cumsum((gap >> U(k)).astype(np.int64) + 1) - 1
    high = np.zeros(int(ends[-1]) + 1, np.uint8)
    high[ends] = 1
    return len(x).to_bytes(4, "little") + bytes([k]) + np.packbits(low).tobytes() + np.packbits(high).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    """The numbers of ``packed`` less their base."""
    if not raw:
        return np.zeros(0, U)
    n, k = int.from_bytes(raw[:4], "little"), raw[4]
    at = 5 + (n * k + 7) // 8
    low = np.zeros((n, 64), np.uint8)
    low[:, 64 - k:] = np.unpackbits(np.frombuffer(raw[5:at], np.uint8), count=n * k).reshape(n, k)
    high = np.diff(np.flatnonzero(np.unpackbits(np.frombuffer(raw[at:], np.uint8))), prepend=-1) - 1
    return np.cumsum((high.astype(U) << U(k)) | np.packbits(low, axis=1).view(">u8").ravel().astype(U), dtype=U)


def batch_grams(table: pa.Table, order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(words per row, for every n: (hash, row) of the n-grams in reading order)."""
    hs, rows, first = [np.zeros(0, U)], [np.zeros(0, np.int64)], 0
    for batch in table.select(["text"]).to_batches():
        for i, _, buf, offs in steps(batch):
            h, row = word_hashes(buf, offs)
            hs.append(h)
            rows.append(row + first + i)
        first += batch.num_rows
    h, row = np.concatenate(hs), np.concatenate(rows)
    out = [(h, row)]
    for n in range(2, order + 1):
        g = grams(h, n)
        inside = row[:len(g)] == row[n - 1:] if len(g) else np.zeros(0, bool)
        out.append((g[inside], row[:len(g)][inside]))
    return np.bincount(row, minlength=first), out


def share(keys: np.ndarray, parts: int) -> np.ndarray:
    """End of every hash range in sorted ``keys``."""
    borders = [(k << 64) // parts for k in range(1, parts)]
    return np.append(np.searchsorted(keys, np.array(borders, U), "left"), len(keys)) if parts > 1 else np.array([len(keys)])


def others(h: np.ndarray, row: np.ndarray, met: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Per occurrence how often rows other than its own hold the n-gram.

    ``met``: of the sorted distinct n-grams, whether another batch was
    asked; ``sums``: the counts in the corpus of those.
    """
    order = np.argsort(h, kind="stable")  # rows stay in order within an n-gram
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    total = np.diff(np.flatnonzero(new), append=len(h))
    total[met] = sums
    pair = new.copy()
    pair[1:] |= row[1:] != row[:-1]
    own = np.diff(np.flatnonzero(pair), append=len(h))
    out = np.empty(len(h), np.int64)
    out[order] = total[np.cumsum(new) - 1] - own[np.cumsum(pair) - 1]
    return out


def scores(counts: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]], replies: list[tuple[np.ndarray, np.ndarray]],
           all_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sum of logarithms, words scored by an n-gram of the full order) per row.

    ``replies``: for every n the last two arguments of ``others``.
    """
    rows, order = len(counts), len(found)
    rest = (all_words - counts).astype(np.float64)
    row = found[0][1]
    first = np.concatenate([[0], np.cumsum(counts)])[:-1][row] if len(row) else row
    at = np.arange(len(row)) - first
    single = others(*found[0], *replies[0])
    with np.errstate(divide="ignore"):
        log = np.where(single > 0, np.log(np.maximum(single, 1)) - np.log(np.maximum(rest[row], 1)),
                       math.log(ALPHA) - np.log(rest[row] + 1))
    top = np.bincount(row[single > 0], minlength=rows) if order == 1 else np.zeros(rows, np.int64)
    last = single
    for n in range(2, order + 1):
        # Word i > n-2 of a row ends the n-gram number i-n+1 of that row.
        here = np.flatnonzero(at >= n - 1)
        mine = others(*found[n - 1], *replies[n - 1])
        # The context is the (n-1)-gram that starts where the n-gram starts.
        per_row = np.maximum(counts - n + 2, 0)
        start = np.concatenate([[0], np.cumsum(per_row)])[:-1]
        context = last[start[row[here]] + at[here] - n + 1]
        hit = mine > 0
        log[here] = np.where(hit, np.log(np.maximum(mine, 1)) - np.log(np.maximum(context, 1)),
                             log[here] + math.log(ALPHA))
        last = mine
        if n == order:
            top += np.bincount(row[here][hit], minlength=rows)
    return np.bincount(row, log, rows), top


def backoff_scores(docs: DataFrame, order: int = ORDER, batch_bytes: int = 8 << 20) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_full (words scored by a whole n-gram), log_score, mean_log."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, math.ceil(total / batch_bytes))
    rows = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("_b"))

    shift = U(64 - min(64, total.bit_length() + 2))

    def base(p: int) -> int:
        return (p << 64) // batches

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        n_, part, tops = [], [], []
        for n, (h, _) in enumerate(batch_grams(table, order)[1], 1):
            distinct = np.unique(h)
            ends = share(distinct, batches)
            for p, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
                if b > a:
                    n_.append(n)
                    part.append(p)
                    tops.append(packed(distinct[a:b] >> shift, base(p) >> int(shift)))
        return pa.table({"n": pa.array(n_, pa.int32()), "part": pa.array(part, pa.int32()),
                         "_b": pa.array([key[0].as_py()] * len(n_), pa.int32()), "tops": pa.array(tops, pa.binary())})

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        tops = [unpacked(t.as_py()) for t in table.column("tops")]
        once = [t[np.concatenate([[True], t[1:] != t[:-1]])] for t in tops]
        every, count = np.unique(np.concatenate(once), return_counts=True)
        met = [np.packbits(count[np.searchsorted(every, t)] > 1).tobytes() for t in tops]
        return pa.table({"n": table.column("n"), "part": table.column("part"), "_b": table.column("_b"),
                         "size": pa.array([len(t) for t in tops], pa.int32()), "met": pa.array(met, pa.binary())})

    def send(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        found = batch_grams(table, order)[1]
        replies = replies.sort_by([("n", "ascending"), ("part", "ascending")])
        keys, counts, n_, at = [], [], 0, 0
        for n, p, size, met in zip(*(replies.column(c).to_pylist() for c in ("n", "part", "size", "met"))):
            if n != n_:
                n_, at = n, 0
                distinct, count = np.unique(found[n - 1][0], return_counts=True)
            mine = at + np.flatnonzero(np.unpackbits(np.frombuffer(met, np.uint8), count=size))
            at += size
            keys.append(packed(distinct[mine], base(p)))
            counts.append(planes(count[mine]))
        return pa.table({"n": replies.column("n"), "part": replies.column("part"), "_b": replies.column("_b"),
                         "size": replies.column("size"), "met": replies.column("met"), "keys": pa.array(keys, pa.binary()),
                         "counts": pa.array(counts, pa.binary())})

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        keys = [unpacked(k.as_py()) for k in table.column("keys")]
        counts = [from_planes(c.as_py()) for c in table.column("counts")]
        every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        summed = np.zeros(len(every), U)
        np.add.at(summed, inverse, np.concatenate(counts))
        back, at = [], 0
        for k in keys:
            back.append(planes(summed[inverse[at:at + len(k)]]))
            at += len(k)
        return pa.table({"n": table.column("n"), "part": table.column("part"), "_b": table.column("_b"),
                         "size": table.column("size"), "met": table.column("met"), "totals": pa.array(back, pa.binary())})

    met = (rows.groupBy("_b").applyInArrow(ask, "n int, part int, _b int, tops binary")
           .groupBy("n", "part").applyInArrow(meet, "n int, part int, _b int, size int, met binary"))
    sent = rows.groupBy("_b").cogroup(met.groupBy("_b")).applyInArrow(
        send, "n int, part int, _b int, size int, met binary, keys binary, counts binary")
    answers = sent.groupBy("n", "part").applyInArrow(answer, "n int, part int, _b int, size int, met binary, totals binary")
    all_words = _words(docs)

    def total_score(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        counts, found = batch_grams(table, order)
        replies = replies.sort_by([("n", "ascending"), ("part", "ascending")])
        got: list[tuple[list, list]] = [([np.zeros(0, bool)], [np.zeros(0, np.int64)]) for _ in found]
        for n, size, met, totals in zip(*(replies.column(c).to_pylist() for c in ("n", "size", "met", "totals"))):
            got[n - 1][0].append(np.unpackbits(np.frombuffer(met, np.uint8), count=size) > 0)
            got[n - 1][1].append(from_planes(totals).astype(np.int64))
        log, top = scores(counts, found, [(np.concatenate(m), np.concatenate(t)) for m, t in got], all_words)
        n = pa.array(counts, pa.int64())
        mean = pa.array(np.divide(log, counts, out=np.zeros(len(log)), where=counts > 0), pa.float64(), mask=counts == 0)
        return pa.table({"doc_id": table.column("doc_id"), "n_words": n, "n_full": pa.array(top, pa.int64()),
                         "log_score": pa.array(log, pa.float64()), "mean_log": mean})

    return rows.groupBy("_b").cogroup(answers.groupBy("_b")).applyInArrow(
        total_score, "doc_id bigint, n_words bigint, n_full bigint, log_score double, mean_log double")


def _words(docs: DataFrame) -> int:
    """Number of words of all texts."""
    gaps = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.agg(F.sum(gaps.cast("long"))).first()[0] or 0
