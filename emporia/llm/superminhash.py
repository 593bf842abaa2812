"""Operator 1: near-duplicates by SuperMinHash.

Every shingle of a text draws a random permutation of the signature's
slots, one slot per round, and a random fraction; round j offers the
value j + fraction to the slot drawn in round j. A slot keeps its
smallest value. As a later round cannot beat an earlier one, a text is
done with the first round after which all its slots are filled: long
texts after one round, short ones after more. The ranks of one shingle
exclude each other, which lowers the variance of the estimate compared
with independent hash functions.

Bands of slots propose candidates; a candidate pair is a link only if
the full shingle sets pass the threshold. Texts with equal sets are one
node. Candidates come in two rounds: every member of a band bucket with
the bucket's smallest node; then, in buckets whose members these links
do not join into one group, the members outside of the largest group
with all members of other groups whose longer signatures (``LONG`` slots
of two bits, made for the members of such buckets only) agree in
``AGREE`` slots. So a bucket of copies costs one candidate per member, no
pair of different groups is left out, and only pairs near the threshold
are written out, each by the first band that the two share. (Agreement
in fewer slots happens to a pair at similarity 0.75 about once in
100,000.)

A document's set: distinct five-word shingles of the A-Z-lowered text;
with fewer words the whole sequence; without words (null, empty, blank
text) the empty set, linked with nothing. Rows that repeat a doc_id keep
a row each. A row without doc_id has no name in a group: it comes back
with a null component and kept. Other columns are ignored; an empty
table gives an empty result. A text is held whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import SMALL_STEP, cut, row_key, saved, steps
from emporia.llm.graph import components
from emporia.llm.hashing import U, mix, shingles

SHINGLE = 5
SLOTS, BAND = 128, 4   # 32 bands of 4: a pair at similarity 0.75 is missed about 5 times in a million
PERCENT = 75
# Two-bit slots agree with probability 0.8125 at similarity 0.75: 1664 of 2048 with a deviation of 17.7 (of
# the first 256: 208, deviation 6.2, looked at first).
LONG, AGREE = 2048, 1589
HEAD, AGREE_HEAD = 256, 180
_LOW_BITS = 0x5555555555555555
#: Numbers of the permutations held at a time (two bytes each), and the text of a step that makes long signatures.
_HELD = 1 << 21
LONG_BYTES = 1 << 16


def signatures(h: np.ndarray, row: np.ndarray, rows: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of every row's elements (distinct hashes, sorted by row): rows x slots; round and 48-bit fraction.

    Slots of a row without elements hold the largest number.
    """
    sig = np.full(rows * slots, ~U(0))
    draw = mix(h, 21)
    np.minimum.at(sig, row * slots + _slot(draw, slots, 0), _fraction(draw))
    count = np.bincount(row, minlength=rows)
    open_ = (count > 0) & (sig.reshape(rows, slots) == ~U(0)).any(axis=1)
    ends = np.cumsum(count)
    todo = np.flatnonzero(open_)
    while len(todo):  # a bounded number of elements at a time: their permutations are held
        take = max(1, int(np.searchsorted(np.cumsum(count[todo]), _HELD // slots, "right")))
        _later_rounds(sig, h, todo[:take], (ends - count)[todo[:take]], count[todo[:take]], slots)
        todo = todo[take:]
    return sig.reshape(rows, slots)


def _slot(draw: np.ndarray, slots: int, j: int) -> np.ndarray:
    """A number from j to slots - 1 out of the upper 32 bits."""
    return j + (((draw >> U(32)) * U(slots - j)) >> U(32)).astype(np.int64)


def _fraction(draw: np.ndarray) -> np.ndarray:
    return mix(draw, 22) >> U(16)


def _later_rounds(sig: np.ndarray, h: np.ndarray, rows: np.ndarray, start: np.ndarray, count: np.ndarray,
                  slots: int) -> None:
    """Rounds from the second on for rows with open slots; each element shuffles its own permutation step by step."""
    of = np.repeat(np.arange(len(rows)), count)
    e = h[np.repeat(start, count) + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)]
    perm = np.tile(np.arange(slots, dtype=np.int16), (len(e), 1))
    active = np.arange(len(e))
    for j in range(slots):
        draw = mix(e[active], 21 + 100 * j)
        k = _slot(draw, slots, j)
        drawn = perm[active, k]
        perm[active, k] = perm[active, j]
        perm[active, j] = drawn
        if j:
            np.minimum.at(sig, rows[of[active]] * slots + drawn, (U(j) << U(48)) + _fraction(draw))
        full = (sig.reshape(-1, slots)[rows] != ~U(0)).all(axis=1)
        if full.all():
            break
        active = active[~full[of[active]]]


def bands(sig: np.ndarray, band: int = BAND) -> np.ndarray:
    """rows x bands: a hash of each band's slots, different for different bands."""
    rows, slots = sig.shape
    parts = mix(sig, 31).reshape(rows, slots // band, band)
    out = np.zeros(parts.shape[:2], U)
    for k in range(band):
        out = mix(out ^ parts[:, :, k], 32 + k)
    return mix(out + np.arange(slots // band, dtype=U)[None, :] * U(0x9E3779B97F4A7C15), 40)


def sketch(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, _h, n_shingles, set_a, set_b (128-bit digest of the set), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in steps(batch, most=SMALL_STEP):
                h, row = shingles(buf, offs, SHINGLE)
                rows = j - i
                count = np.bincount(row, minlength=rows)
                total = np.zeros((2, rows), U)
                for k in (0, 1):  # sums do not depend on the order of the set
                    np.add.at(total[k], row, mix(h, 51 + k))
                b = bands(signatures(h, row, rows)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, rows), batch.column("_h").slice(i, rows), pa.array(count), pa.array(total[0].view(np.int64)),
                     pa.array(total[1].view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * b.shape[1]),
                                              pa.array(b.ravel()))],
                    names=["doc_id", "_h", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select(*row_key(), "text").mapInArrow(
        run, "doc_id bigint, _h bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose full shingle sets have 100 * common >= percent * union; ``texts``: node, text."""
    t = texts.select("node", "text")
    both = (pairs.join(t.withColumnsRenamed({"node": "u", "text": "ut"}), "u")
            .join(t.withColumnsRenamed({"node": "v", "text": "vt"}), "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, center_set = None, np.zeros(0, U)  # centers come in runs of rows; only the last one's set is held
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            v_of = batch.column("v").to_pylist()
            for i, j, buf, offs in steps(batch, "ut", SMALL_STEP):
                h, row = shingles(buf, offs, SHINGLE)
                cut_at = np.searchsorted(row, np.arange(j - i + 1))
                for k in range(j - i):
                    if v_of[i + k] != center:
                        center = v_of[i + k]
                        one = pa.RecordBatch.from_arrays([batch.column("vt").slice(i + k, 1)], names=["text"])
                        center_set = next((shingles(b, o, SHINGLE)[0] for _, _, b, o in steps(one)), center_set[:0])
                    a = h[cut_at[k]:cut_at[k + 1]]
                    common = len(np.intersect1d(a, center_set, assume_unique=True))
                    keep[i + k] = 100 * common >= percent * (len(a) + len(center_set) - common)
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return both.select("u", "v", "ut", "vt").mapInArrow(run, "u bigint, v bigint")


def two_bits(sig: np.ndarray) -> np.ndarray:
    """Two hashed bits of every slot, 32 slots to a number: rows x (slots / 32)."""
    two = (mix(sig, 60) & U(3)).reshape(len(sig), -1, 32)
    return np.bitwise_or.reduce(two << (np.arange(32, dtype=U) * U(2)), axis=2)


def long_signatures(texts: DataFrame) -> DataFrame:
    """(node, long) of ``texts`` (node, text): ``two_bits`` of ``LONG`` slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in steps(batch, most=LONG_BYTES):
                h, row = shingles(buf, offs, SHINGLE)
                two = two_bits(signatures(h, row, j - i, LONG)).view(np.int64)
                ends = np.arange(j - i + 1, dtype=np.int32) * two.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), pa.array(two.ravel()))],
                    names=["node", "long"])

    return texts.mapInArrow(run, "node bigint, long array<bigint>")


def _unequal(a: str, b: str, slots: int) -> Column:
    """In how many of the first slots two ``two_bits`` columns differ."""
    total = F.lit(0)
    for k in range(slots // 32):
        x = F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k)))
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_LOW_BITS)))
    return total


def _unsettled(members: DataFrame, group: DataFrame) -> DataFrame:
    """band, node, size, g, top: the members of buckets that hold several groups; ``top`` is the largest one."""
    placed = (members.join(group, "node", "left")
              .select("band", "node", "size", F.coalesce("component", "node").alias("g")))
    counts = placed.groupBy("band", "g").agg(F.count(F.lit(1)).alias("c"))
    top = (counts.groupBy("band").agg(F.max(F.struct("c", "g")).alias("m"), F.count(F.lit(1)).alias("k"))
           .filter("k > 1").select("band", F.col("m.g").alias("top")).repartition("top", "band"))
    return saved(placed.join(top, "band"))


def _sized(pairs: DataFrame) -> DataFrame:
    """Pairs (x, sx, y, sy) as (u, v), u > v, whose sizes the threshold allows; distinct."""
    ok = (F.col("x") != F.col("y")) & (100 * F.least("sx", "sy") >= PERCENT * F.greatest("sx", "sy"))
    return pairs.filter(ok).select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()


def _cross_pairs(left: DataFrame, sketches: DataFrame) -> DataFrame:
    """The members outside of the largest group with all members of other groups with a similar signature."""
    rows = saved(left.join(sketches, "node"))
    x = rows.filter("g != top").select("band", F.col("node").alias("x"), F.col("size").alias("sx"),
                                       F.col("g").alias("gx"), F.col("long").alias("lx"), F.col("bands").alias("bx"))
    y = rows.select("band", "top", F.col("node").alias("y"), F.col("size").alias("sy"), F.col("g").alias("gy"),
                    F.col("long").alias("ly"), F.col("bands").alias("by"))
    near = ((F.col("gx") != F.col("gy")) & ((F.col("gy") == F.col("top")) | (F.col("x") < F.col("y")))
            & (100 * F.least("sx", "sy") >= PERCENT * F.greatest("sx", "sy"))
            & (_unequal("lx", "ly", HEAD) <= HEAD - AGREE_HEAD) & (_unequal("lx", "ly", LONG) <= LONG - AGREE)
            & (F.array_min(F.array_intersect("bx", "by")) == F.col("band")))
    return _sized(x.join(y, "band").filter(near))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    return _grouped(docs).drop("_h")


def _grouped(docs: DataFrame) -> DataFrame:
    sketches = saved(sketch(docs))
    # Texts with the same set are one node, named by their smallest id; hot groups of copies shrink before the shuffle.
    nodes = saved(sketches.filter("n_shingles > 0 and doc_id is not null")
                  .groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("size")))
    first = sketches.join(nodes, ["set_a", "set_b"]).filter("doc_id = node")
    buckets = first.select("node", "size", F.explode("bands").alias("band")).distinct()
    shared = buckets.groupBy("band").agg(F.min("node").alias("v"), F.max("node").alias("w")).filter("v < w")
    # (Dealt out by other columns first: a join straight on an aggregate could not be split at a hot bucket.)
    members = saved(buckets.join(shared.select("band", "v").repartition("v", "band"), "band"))
    texts = saved(docs.select(F.col("doc_id").alias("node"), "text")
                  .join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")))
    tested = cut(members.filter("node != v").select(F.col("node").alias("u"), "v").distinct())
    links = cut(confirmed(tested, texts))
    group = components(links)
    left = _unsettled(members.select("band", "node", "size"), group)
    few = left.select("node").distinct()
    own = first.join(few, "node", "left_semi").groupBy("node").agg(F.min("bands").alias("bands"))
    long = long_signatures(texts.join(few, "node", "left_semi")).join(own, "node")
    pairs = cut(_cross_pairs(left, long).join(tested, ["u", "v"], "left_anti"))
    if not pairs.isEmpty():
        links = links.unionByName(cut(confirmed(pairs, texts)))
        group = components(links)
    named = nodes.join(group, "node", "left").select("set_a", "set_b", F.coalesce("component", "node").alias("_c"))
    out = sketches.drop("bands").join(named, ["set_a", "set_b"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("_c")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "_h", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; of rows with equal doc_id and text one, the smallest.

    Rows without doc_id stay. Columns must have an order (no maps).
    """
    # The row as one column: no name can clash.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), *row_key())
    gone = (_grouped(docs).filter("not kept").select(F.col("doc_id").alias("_d"), F.col("_h").alias("_g"))
            .distinct().repartition("_g", "_d"))
    same = (F.col("doc_id") == F.col("_d")) & (F.col("_h") == F.col("_g"))
    kept = rows.join(gone, same, "left_anti")
    # Only ids and hashes are counted; repeated rows are rare and only they meet in an aggregate with their text.
    twice = saved(rows.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_d"), F.col("_h").alias("_g"))
                  .agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
    if twice.isEmpty():
        return kept.select("_row.*")
    one = kept.join(twice, same).groupBy("doc_id", "_h").agg(F.min("_row").alias("_row"))
    return kept.join(twice, same, "left_anti").select("_row.*").unionByName(one.select("_row.*"))
