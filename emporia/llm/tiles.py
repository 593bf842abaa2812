"""Operator 11: phrase collocations, counted in direct-address tiles.

Per language, texts are cut into pieces at punctuation and line ends and
these into words. Phrases of two words are pairs of words; phrases of n
words are pairs of overlapping phrases of n-1 words, so one routine counts
every length, each in one pass over the texts:

* the frequent symbols (words, then phrases) of the length before are
  ranked by frequency; the first ``head`` of them are numbered by rank, any
  other keeps its 64-bit hash as its name;
* the plane of (rank, rank) pairs is split into tiles of ``SIDE`` x ``SIDE``.
  A tile that a task meets often enough is counted in a dense array
  (``bincount`` over the address within the tile); the other tiles, and
  pairs with a symbol outside of the head, as sorted (left, right, count) runs;
* Spark sums the tasks' counts per pair, pairs below ``least`` go, and the
  rest are the symbols of the next length, ranked anew.

A phrase can only be frequent if both its parts are, so a pass counts only
pairs of symbols that the length before kept. Tasks know these from the
head (at most ``head`` numbers) and a bit map of fixed size over the hashes
of the others; the map may let a few rare pairs through, which the sums
then remove. Both are bounded whatever the input.

A phrase's score is the least, over its cuts into two parts, of
floor(2000000 a / (l + r)); a phrase inside a longer one that has at least
80 % of its occurrences is dropped. All counts are exact 64-bit integers, the
score's product is taken in decimals.

Null languages count as ``und``, null texts as empty; repeated rows and
ids count as rows of their own; ties go to the smaller phrase. Very long
texts are counted in parts cut between pieces. Other columns are not looked
at, whatever they are called. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import STEP_BYTES, ragged, saved, steps, text_column
from emporia.llm.hashing import _LOWER, BYTE, Prefix, Table, U, mix

LONGEST = 4
SIDE = 1 << 10

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".,;:!?"]] = True
_END[0x0A:0x0E] = True
_GAP = _END.copy()
_GAP[[0x20, 0x09]] = True
_SIGN = U(1 << 63)


# --- words and keys

def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(lowered bytes, row offsets, first row); a row of several steps is cut after ends of pieces."""
    for i, _, buf, offs in steps(batch):
        buf = _LOWER[buf]
        if len(offs) > 2 or len(buf) <= 2 * STEP_BYTES:
            yield buf, offs, i
            continue
        ends = np.flatnonzero(_END[buf]) + 1
        a = 0
        while a < len(buf):
            k = int(np.searchsorted(ends, a + STEP_BYTES))
            z = int(ends[k]) if k < len(ends) else len(buf)
            yield buf[a:z], np.array([0, z - a]), i
            a = z


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word, and whether it is in the piece of the word before."""
    if not len(buf):
        e = np.zeros(0, np.int64)
        return e, e, e, np.zeros(0, bool)
    inside = ~_GAP[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < len(buf))]
    first[at], last[at - 1] = inside[at], inside[at - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offs, s, "right") - 1
    ends = np.concatenate([[0], np.cumsum(_END[buf])])
    same = np.zeros(len(s), bool)
    same[1:] = (row[1:] == row[:-1]) & (ends[s[1:]] == ends[e[:-1]])
    return s, e, row, same


def _named(h: np.ndarray) -> np.ndarray:
    """A hash as a negative long: ranks are not negative."""
    return (h | _SIGN).view(np.int64)


def word_keys(buf: np.ndarray, s: np.ndarray, e: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Keys of words; ``lang`` holds the hash of every word's language."""
    return _named(mix(Prefix(buf, BYTE).of(s, e) ^ lang)) if len(s) else np.zeros(0, np.int64)


def joined(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Keys of the phrases of n words whose first and last n-1 words have the keys given."""
    return _named(mix(left.view(U) * U(0x9E3779B97F4A7C15) + mix(right.view(U), n)))


def _languages(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Of every row its language's number; the languages and their hashes."""
    col = text_column(batch, "lang").dictionary_encode()
    names = col.dictionary.to_pylist()
    return col.indices.to_numpy(), names, np.array([xxhash.xxh64_intdigest(x) for x in names], U)


# --- what a task knows of the length before

class Known:
    """The frequent symbols of one length: ranks of the head, a bit map over the rest."""

    def __init__(self, keys: np.ndarray, bits: int, bitmap: np.ndarray):
        self.keys, self.bits, self.bitmap = keys, bits, bitmap
        self.table = Table(max(10, int(len(keys) * 2 + 2).bit_length()))
        self.table.add(keys.view(U), np.arange(len(keys), dtype=np.int32))

    def symbols(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols, and which of them may be frequent (all that are, and few others)."""
        rank = self.table.find(keys.view(U)).astype(np.int64)
        at = ((keys.view(U) << U(1)) >> U(64 - self.bits)).astype(np.int64)
        set_ = (self.bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return np.where(rank >= 0, rank, keys), (rank >= 0) | set_

    def names(self, symbols: np.ndarray) -> np.ndarray:
        """Keys of symbols."""
        if not len(self.keys):
            return symbols
        return np.where(symbols >= 0, self.keys[np.maximum(symbols, 0)], symbols)


def known(grams: DataFrame, head: int, bits: int) -> Known:
    """What tasks need of ``grams`` (key, a); the driver reads ``head`` rows and 2**bits bits at most."""
    size = F.floor(F.log2(F.col("a")) * 64)
    sizes = sorted(((r.s, r.c) for r in grams.groupBy(size.alias("s")).agg(F.count(F.lit(1)).alias("c")).collect()), reverse=True)
    least, room = 1 << 62, head
    for s, c in sizes:  # whole classes of about equal frequency, from the most frequent down
        if c > room:
            break
        least, room = s, room - c
    top = grams.filter(size >= least).select("key", "a").toArrow()
    keys, a = top.column("key").to_numpy(), top.column("a").to_numpy()
    at = F.shiftrightunsigned(F.shiftleft("key", 1), 64 - bits) + 1
    maps = (grams.filter(size < least).select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).toArrow())
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    for b, m in zip(maps.column("b").to_pylist(), maps.column("m")):
        part = np.frombuffer(m.as_buffer(), np.uint8)
        room = bitmap[(b - 1) * 4096:b * 4096]
        room[:] = part[:len(room)]
    return Known(keys[np.lexsort((keys, -a))], bits, bitmap)


# --- counting

def _runs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted pairs with their counts. Pairs are ordered by a hash; were two to share it, a pair may come in several runs."""
    order = np.argsort(mix(left.view(U) * U(3) + mix(right.view(U))))
    left, right = left[order], right[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    at = np.flatnonzero(new)
    return left[at], right[at], np.diff(np.append(at, len(left)))


class Tiles:
    """Pair counts of one task.

    Pairs gather up to ``flush``; then tiles with one pair per ``sparse``
    cells or more go to their dense array (at most ``most`` of these are
    kept, of 32-bit counts: one task's pairs) and the others leave as sorted runs.
    """

    def __init__(self, head: int, flush: int = 1 << 20, sparse: int = 16, most: int = 16):
        self.wide = max(1, -(-head // SIDE))
        self.flush, self.sparse, self.most = flush, sparse, most
        self.dense: dict[int, np.ndarray] = {}
        self.waiting, self.n = [], 0

    def add(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple]:
        self.waiting.append((left, right))
        self.n += len(left)
        if self.n >= self.flush:
            yield self._sparse()

    def _sparse(self) -> tuple:
        left, right = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.n = [], 0
        tile = np.where((left >= 0) & (right >= 0), (left // SIDE) * self.wide + right // SIDE, self.wide**2)
        count = np.bincount(tile, minlength=self.wide**2 + 1)[:-1]
        often = np.flatnonzero(count * self.sparse >= SIDE * SIDE)
        for t in often[np.argsort(-count[often], kind="stable")].tolist():
            if t not in self.dense and len(self.dense) < self.most:
                self.dense[t] = np.zeros(SIDE * SIDE, np.int32)
        rest = np.ones(len(left), bool)
        for t, cells in self.dense.items():
            mine = tile == t
            cells += np.bincount((left[mine] % SIDE) * SIDE + right[mine] % SIDE, minlength=SIDE * SIDE).astype(np.int32)
            rest &= ~mine
        return _runs(left[rest], right[rest])

    def finish(self) -> Iterator[tuple]:
        if self.waiting:
            yield self._sparse()
        for t, cells in self.dense.items():
            at = np.flatnonzero(cells)
            yield at // SIDE + t // self.wide * SIDE, at % SIDE + t % self.wide * SIDE, cells[at].astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def _merged(waiting: list[tuple]) -> pa.RecordBatch:
    keys, counts, langs, texts = zip(*waiting)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
    first = pa.array(order[at])
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays(langs).take(first), pa.concat_arrays(texts).take(first), pa.array(keys[order][at]),
         pa.array(np.add.reduceat(counts[order], at))], names=["lang", "word", "key", "a"])


def count_words(docs: DataFrame, flush: int = 1 << 20) -> DataFrame:
    """lang, word, key, a of all words; the word '' stands for all of the language's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n, total = [], 0, {}
        for batch in batches:
            lang, names, hashes = _languages(batch)
            for buf, offs, i in _parts(batch):
                s, e, row, _ = words(buf, offs)
                if not len(s):
                    continue
                of = lang[row + i]
                keys, first, count = np.unique(word_keys(buf, s, e, hashes[of]), return_index=True, return_counts=True)
                for k, c in enumerate(np.bincount(of, minlength=len(names)).tolist()):
                    total[names[k]] = total.get(names[k], 0) + c
                lens = e[first] - s[first]
                offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                text = pa.Array.from_buffers(pa.string(), len(first), [
                    None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(buf[ragged(s[first], lens)].tobytes())])
                waiting.append((keys, count, pa.array(names, pa.string()).take(pa.array(of[first])), text))
                n += len(keys)
                if n >= flush:
                    yield _merged(waiting)
                    waiting, n = [], 0
        if waiting:
            yield _merged(waiting)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([""] * len(total), pa.string()), pa.array([0] * len(total), pa.int64()),
             pa.array(list(total.values()), pa.int64())], names=["lang", "word", "key", "a"])

    return (_texts(docs).mapInArrow(run, "lang string, word string, key bigint, a bigint")
            .groupBy("lang", "word", "key").agg(F.sum("a").alias("a")))


def count_phrases(docs: DataFrame, n: int, before: Known, least: int) -> DataFrame:
    """key, left, right, a of the phrases of n words met ``least`` times; left and right name their first and last n-1 words."""
    sent = docs.sparkSession.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = sent.value
        tiles = Tiles(len(k.keys))

        def out(x: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in x], names=["left", "right", "a"])

        for batch in batches:
            lang, _, hashes = _languages(batch)
            for buf, offs, i in _parts(batch):
                s, e, row, same = words(buf, offs)
                if len(s) < n:
                    continue
                keys, whole = word_keys(buf, s, e, hashes[lang[row + i]]), np.ones(len(s), bool)
                for m in range(2, n):
                    whole = whole[:-1] & whole[1:] & (same[1:] if m == 2 else True)
                    keys = joined(keys[:-1], keys[1:], m)
                at = np.flatnonzero(whole)
                symbol, often = k.symbols(keys[at])
                # Neighbours overlap by all words but one; words are neighbours only inside a piece.
                pair = (at[1:] == at[:-1] + 1) & often[:-1] & often[1:]
                if n == 2:
                    pair &= same[1:]
                hit = np.flatnonzero(pair)
                for x in tiles.add(symbol[hit], symbol[hit + 1]):
                    yield out(x)
        for x in tiles.finish():
            yield out(x)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (sent.value.names(batch.column(c).to_numpy()) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(joined(left, right, n)), pa.array(left), pa.array(right), batch.column(2)],
                                             names=["key", "left", "right", "a"])

    pairs = (_texts(docs).mapInArrow(run, "left bigint, right bigint, a bigint").groupBy("left", "right")
             .agg(F.sum("a").alias("a")).filter(F.col("a") >= least))
    return pairs.mapInArrow(named, "key bigint, left bigint, right bigint, a bigint")


# --- candidates

def _scored(cuts: list[tuple[str, str]]) -> Column:
    """(score, k, l, r) of the cut with the lowest score; ``cuts`` name the columns of l and r by k."""
    def one(k: int, left: str, right: str) -> Column:
        score = F.expr(f"cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div cast(`{left}` + `{right}` as decimal(19,0))")
        return F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    return F.array_min(F.array(*(one(k, x, y) for k, (x, y) in enumerate(cuts, 1))))


def _extended(grams: DataFrame, shorter: DataFrame, left: dict, right: dict) -> DataFrame:
    """``grams`` with columns of the phrases' first and last parts, under new names, and the phrase itself."""
    a = shorter.select(F.col("key").alias("left"), "lang", F.col("phrase").alias("_p"), *(F.col(c).alias(x) for c, x in left.items()))
    z = shorter.select(F.col("key").alias("right"), "last", *(F.col(c).alias(x) for c, x in right.items()))
    return grams.join(a, "left").join(z, "right").withColumn("phrase", F.concat_ws(" ", "_p", "last")).drop("_p")


def _not_inside(phrases: DataFrame, longer: DataFrame, share: int = 80) -> DataFrame:
    """Phrases without a longer one around them that has ``share`` percent of their occurrences.

    Phrases longer by one word suffice: one that is longer by two lies
    around a phrase longer by one that is at least as frequent.
    """
    around = (longer.select(F.col("left").alias("key"), "a").unionAll(longer.select(F.col("right").alias("key"), "a"))
              .groupBy("key").agg(F.max("a").alias("_most")))
    return phrases.join(around, "key", "left").filter(f"_most is null or 100 * _most < {share} * a").drop("_most")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, head: int = 1 << 16, bits: int = 26) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two to four words of every language."""
    found = saved(count_words(docs).filter(f"a >= {least} or word = ''"))
    grams = found.filter("word != ''").select("key", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a")
    totals = found.filter("word = ''").select("lang", F.col("a").alias("n"))
    table, counted = {1: grams}, {}
    sides = {2: ({"a": "f_first"}, {"a": "f_last"}), 3: ({"f_first": "f_first", "a": "a_front"}, {"f_last": "f_last", "a": "a_back"}),
             4: ({"f_first": "f_first", "a_front": "a_two", "a": "a_front"}, {"f_last": "f_last", "a_back": "a_end", "a": "a_back"})}
    cuts = {2: [("f_first", "f_last")], 3: [("f_first", "a_back"), ("a_front", "f_last")],
            4: [("f_first", "a_back"), ("a_two", "a_end"), ("a_front", "f_last")]}
    for n in range(2, LONGEST + 1):
        counted[n] = saved(count_phrases(docs, n, known(table[n - 1], head, bits), least))
        table[n] = saved(_extended(counted[n], table[n - 1], *sides[n]))
    candidates = None
    for n in range(2, LONGEST + 1):
        rows = _not_inside(table[n], counted[n + 1]) if n < LONGEST else table[n]
        rows = rows.select("lang", "phrase", "a", _scored(cuts[n]).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
        candidates = rows if candidates is None else candidates.unionAll(rows)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within shares of a language, so that no task orders all its phrases.
    for by in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(64))], ["lang"]):
        candidates = candidates.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(f"rank <= {top}")
    return candidates.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
