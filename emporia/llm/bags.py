"""Operator 12: ranked lexical search over bags, with bag deduplication.

A document matters to a set of search items only by its *bag*: how often
it holds each word of the items' vocabulary, and its length norm m. Many
documents share a bag (copies, short texts, texts that differ outside of
the vocabulary), so

1. every whole text is cut to its bag in one pass over the documents
   (numpy inside Arrow batches) and the bags are stored with two 64-bit
   hashes;
2. rows with equal (hashes, bag, m) form one class: hashed by the first
   two, verified by the bag itself, counted before the shuffle;
3. the classes give every word's document frequency, and each class is
   scored once; a task keeps the best ``top`` classes of every item;
4. the best classes' members are added by ascending doc_id.

A class has a member at least, so the ``top`` best documents of an item lie in
its ``top`` first classes by (score, smallest doc_id): what step 4 reads is
bounded by items x top, and step 3 loses nothing.

Terms are the maximal runs of digits, letters and bytes above 0x7F; A-Z
are lowered. With N documents that hold a term, L terms in all and n in
one document: m = 100 - 75 + (75 n N) div L, a term's weight
floor(1000 ln((2N+2)/(2 df+1))), and a document's score the sum over the
item's terms (repeats count) of w * ((10**9 tf) div (1000 tf + 8 m)).

Items are taken in blocks of about ``block_terms`` (item, term) entries, so
what is sent to the tasks is bounded; each block is one pass over the
documents. An item longer than that is a block of its own.

Every row of the item table is a query of its own: a row given twice
gives its result twice. Items and documents without terms (null, empty)
match nothing. A null doc_id comes after all others; rows that repeat a
doc_id are ranked one by one. No document or no item gives an empty result.
Other columns are not looked at, whatever they are called. A text is held whole in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import ragged, saved, steps
from emporia.llm.hashing import BYTE_LOWER, Prefix, Table, U, mix

_INSIDE = np.zeros(256, bool)
for _a, _z in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _INSIDE[_a:_z + 1] = True

RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"
_LAST = (1 << 63) - 1


def terms(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every term of every row."""
    if not len(buf):
        return np.zeros(0, U), np.zeros(0, np.int64)
    inside = _INSIDE[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # A row's end also ends its last term.
    at = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < len(buf))]
    first[at] = inside[at]
    last[at - 1] = inside[at - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Prefix(buf, BYTE_LOWER).of(s, e), np.searchsorted(offs, s, "right") - 1


class Vocabulary:
    """Numbers 0, 1, ... of a set of term hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.table = Table(max(10, int(len(self.hashes) * 2 + 2).bit_length()))
        self.table.add(self.hashes, np.arange(len(self.hashes), dtype=np.int32))

    def bags(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every row its number of terms; and the rows' bags as (term, count) entries with their offsets."""
        h, row = terms(buf, offs)
        rows = len(offs) - 1
        term = self.table.find(h)
        met = term >= 0
        key, count = np.unique(row[met] * len(self.hashes) + term[met], return_counts=True)
        entries = np.empty((len(key), 2), "<u4")
        entries[:, 0], entries[:, 1] = key % len(self.hashes), count
        ends = np.searchsorted(key, np.arange(rows + 1) * len(self.hashes))
        return np.bincount(row, minlength=rows), entries, ends


def _binary(entries: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of ``entries`` (8 bytes each) as a binary column."""
    offsets = pa.py_buffer(((ends - ends[0]) * 8).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(entries).tobytes())])


def _entries(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The entries of a binary column and the rows' offsets in them."""
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int32, len(col) + 1, col.offset * 4).astype(np.int64)
    flat = np.frombuffer(data, "<u4", (o[-1] - o[0]) // 4, o[0]).reshape(-1, 2) if o[-1] > o[0] else np.zeros((0, 2), "<u4")
    return flat, (o - o[0]) // 8


def item_postings(items: DataFrame) -> DataFrame:
    """(row, item_id, term, tf): the distinct terms of every item, one row of entries per item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("item_id"))
            for i, j, buf, offs in steps(batch):
                h, row = terms(buf, offs)
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                tf = np.diff(np.append(at, len(h)))
                ends = np.searchsorted(row[at], np.arange(j - i + 1))
                flat = np.empty((len(at), 2), "<u8")
                flat[:, 0], flat[:, 1] = h[at], tf
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array([flat[a:z].tobytes() for a, z in zip(ends[:-1], ends[1:])], pa.binary()),
                     pa.array(np.diff(ends))], names=["item_id", "postings", "n_terms"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id bigint, postings binary, n_terms bigint").filter("n_terms > 0")


class Block:
    """The items of one pass: vocabulary, and of every term its (item, count) entries."""

    def __init__(self, rows: list):
        self.ids = [r.item_id for r in rows]
        flat = np.concatenate([np.frombuffer(r.postings, "<u8").reshape(-1, 2) for r in rows])
        item = np.repeat(np.arange(len(rows)), [r.n_terms for r in rows])
        self.vocabulary = Vocabulary(flat[:, 0].astype(U))
        term = self.vocabulary.table.find(flat[:, 0].astype(U)).astype(np.int64)
        order = np.lexsort((item, term))
        self.item, self.times = item[order], flat[order, 1].astype(np.int64)
        self.begin = np.searchsorted(term[order], np.arange(len(self.vocabulary.hashes) + 1))
        self.most = int(np.bincount(item, weights=flat[:, 1].astype(np.float64)).max())  # terms of the longest item


def _bags(docs: DataFrame, block) -> DataFrame:
    """doc_id, n, bag, k1, k2 of every document with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = block.value.vocabulary
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for i, j, buf, offs in steps(batch):
                n, entries, ends = vocabulary.bags(buf, offs)
                part = pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(n), _binary(entries, ends)], names=["doc_id", "n", "bag"])
                yield part.filter(pa.array(n > 0))

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, n bigint, bag binary")
    return found.withColumns({"k1": F.xxhash64("bag"), "k2": F.xxhash64(F.lit(1), "bag")})


def _frequencies(classes: DataFrame, size: int) -> np.ndarray:
    """Documents per term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            flat, ends = _entries(batch.column(0))
            members = batch.column(1).to_numpy()
            np.add.at(total, flat[:, 0], np.repeat(members, np.diff(ends)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    got = (classes.select("bag", "members").mapInArrow(run, "term bigint, df bigint")
           .groupBy("term").agg(F.sum("df").alias("df")).toArrow())
    df = np.zeros(size, np.int64)
    df[got.column("term").to_numpy()] = got.column("df").to_numpy()
    return df


class _Best:
    """The best classes of every item met so far, by (score, first doc_id)."""

    def __init__(self, top: int, items: int):
        self.top, self.rows = top, np.zeros((0, 6), np.int64)  # item, -score, first, k1, k2, m
        self.least = np.ones(items, np.int64)  # a score below this has no place any more

    def add(self, score: np.ndarray, ids: list[np.ndarray]) -> None:
        """Scores of new classes as (class, item) rows, and their first, k1, k2 and m."""
        if len(score) > self.top:
            self.least = np.maximum(self.least, np.partition(score, -self.top, axis=0)[-self.top])
        c, item = np.nonzero(score >= self.least)
        rows = np.concatenate([self.rows, np.stack([item, -score[c, item], *(x[c] for x in ids)], 1)])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        start = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if len(rows) else np.zeros(0, np.int64)
        place = np.arange(len(rows)) - np.repeat(start, np.diff(np.append(start, len(rows))))
        self.rows = rows[place < self.top]
        full = self.rows[place[place < self.top] == self.top - 1]
        self.least[full[:, 0]] = np.maximum(self.least[full[:, 0]], -full[:, 1])


def _score(flat: np.ndarray, ends: np.ndarray, m: np.ndarray, weight: np.ndarray, block: Block) -> np.ndarray:
    """Scores of a few classes for all items of the block, as (class, item) rows; int64 throughout."""
    items = len(block.ids)
    term, tf = flat[:, 0].astype(np.int64), flat[:, 1].astype(np.int64)
    owner = np.repeat(np.arange(len(m)), np.diff(ends))
    part = weight[term] * ((10**9 * tf) // (1000 * tf + 8 * m[owner]))
    lens = block.begin[term + 1] - block.begin[term]
    at = ragged(block.begin[term], lens)
    cell = np.repeat(owner, lens) * items + block.item[at]
    value = np.repeat(part, lens) * block.times[at]
    if int(weight.max(initial=0)) * 10**6 * block.most < 1 << 53:  # sums of doubles are exact
        return np.bincount(cell, weights=value.astype(np.float64), minlength=len(m) * items).astype(np.int64).reshape(-1, items)
    total = np.zeros(len(m) * items, np.int64)
    np.add.at(total, cell, value)
    return total.reshape(-1, items)


#: (class, item, term) entries that are scored at a time.
_AT_ONCE = 1 << 20


def _best_classes(classes: DataFrame, block, weight, top: int) -> DataFrame:
    """(item, score, first, k1, k2, m): the best classes of every item in every task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, w = block.value, weight.value
        best = _Best(top, len(b.ids))
        width = np.diff(b.begin)
        for batch in batches:
            cols = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            flat, ends = _entries(cols["bag"])
            ids = [cols[c].to_numpy() for c in ("first", "k1", "k2", "m")]
            work = np.concatenate([[0], np.cumsum(width[flat[:, 0]])])[ends]
            i = 0
            while i < len(batch):
                room = min(int(np.searchsorted(work, work[i] + _AT_ONCE, "right")) - 1, i + max(1, _AT_ONCE // len(b.ids)))
                j = max(i + 1, room)
                score = _score(flat[ends[i]:ends[j]], ends[i:j + 1] - ends[i], ids[3][i:j], w, b)
                best.add(score, [x[i:j] for x in ids])
                i = j
        r = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (r[:, 0], -r[:, 1], r[:, 2], r[:, 3], r[:, 4], r[:, 5])],
                                         names=["item", "score", "first", "k1", "k2", "m"])

    schema = "item bigint, score bigint, first bigint, k1 bigint, k2 bigint, m bigint"
    found = classes.select("bag", "first", "k1", "k2", "m").mapInArrow(run, schema)
    order = [F.desc("score"), F.asc("first"), F.asc("k1")]
    # Tasks' lists are merged in two steps, so no item gathers those of all tasks at once.
    for by in (["item", F.pmod(F.hash("k1"), F.lit(64))], ["item"]):
        found = found.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(f"_r <= {top}").drop("_r")
    return found


def _search_block(docs: DataFrame, rows: list, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    block = Block(rows)
    sent = spark.sparkContext.broadcast(block)
    bags = saved(_bags(docs, sent))
    total, length = bags.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not total:
        return None
    m = F.expr(f"25 + (75 * n * {total}L) div {length}L")
    # Rows without a word of the vocabulary score nothing.
    bags = bags.filter(F.octet_length("bag") > 0).withColumn("m", m)
    classes = saved(bags.groupBy("k1", "k2", "m", "bag").agg(
        F.count(F.lit(1)).alias("members"), F.coalesce(F.min("doc_id"), F.lit(_LAST)).alias("first")))
    df = _frequencies(classes, len(block.vocabulary.hashes))
    weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    best = saved(_best_classes(classes, sent, spark.sparkContext.broadcast(weight), top))
    # At most top classes an item: the members that can be in a result are their first ones.
    asked = best.select("k1", "k2", "m").distinct()
    place = Window.partitionBy("k1", "k2", "m").orderBy(F.asc_nulls_last("doc_id"))
    members = (bags.select("doc_id", "k1", "k2", "m").join(F.broadcast(asked), ["k1", "k2", "m"], "left_semi")
               .withColumn("_r", F.row_number().over(place)).filter(f"_r <= {top}").drop("_r"))
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = (best.join(members, ["k1", "k2", "m"]).withColumn("rank", F.row_number().over(rank)).filter(f"rank <= {top}"))
    names = spark.createDataFrame(list(enumerate(block.ids)), "item bigint, item_id bigint")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = 10, block_terms: int = 1 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every row of ``items``."""
    spark = docs.sparkSession
    postings = saved(item_postings(items))
    entries = postings.agg(F.sum("n_terms")).first()[0] or 0
    blocks = -(-entries // block_terms)
    postings = postings.withColumn("_b", F.pmod(F.xxhash64("item_id", "postings"), F.lit(max(1, blocks))))
    found = []
    for k in range(blocks):
        part = postings.filter(F.col("_b") == k).collect()
        ranked = _search_block(docs, part, top) if part else None
        if ranked is not None:
            found.append(ranked)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], RESULT)
