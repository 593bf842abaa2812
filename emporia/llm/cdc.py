"""Operator 9: substring dedup by content-defined chunking.

A gear rolling hash over the bytes of a text sets chunk borders where
its upper bits are zero, so borders depend on the 32 bytes before them
only and an insertion moves no border beyond its own neighbourhood.
Chunks are compared by a 128-bit digest, after a first pass has told by
64-bit hashes which of them cannot occur twice. A chunk whose digest occurs
more than once in the corpus is *repeated*; a maximal run of repeated
chunks of at least ``min_run`` bytes is a repeated passage. Of every
digest the first occurrence (smallest doc_id, then position) stays and
the others inside repeated passages are removed.

Null or empty text: no chunk, nothing removed. Rows that share an id but
not the text are documents of their own; a row given twice is one
document whose first occurrences stay in both rows. Extra columns are
ignored; an empty table gives an empty result. A text is held whole in
one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import ragged, raw_bytes, row_key, saved, steps, text_column
from emporia.llm.hashing import BYTE, Prefix

GEAR = (BYTE >> np.uint64(32)).astype(np.uint32)
WINDOW = 32


def gear(buf: np.ndarray) -> np.ndarray:
    """h[i] = 2 h[i-1] + G[b[i]] mod 2**32, i.e. a hash of the last 32 bytes, by doubling the window."""
    h = GEAR[buf]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def borders(buf: np.ndarray, mask_bits: int, shortest: int, longest: int) -> np.ndarray:
    """Ends of the chunks of one text.

    A border needs ``shortest`` bytes since the last one; a stretch
    without border is cut after ``longest`` bytes.
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64)
    ends, last = [], 0
    for c in (np.flatnonzero((gear(buf) >> np.uint32(32 - mask_bits)) == 0) + 1).tolist():
        while c - last > longest:
            last += longest
            ends.append(last)
        if c - last >= shortest:
            last = c
            ends.append(c)
    while n - last > longest:
        last += longest
        ends.append(last)
    if last < n:
        ends.append(n)
    return np.array(ends, np.int64)


def _cut_up(buf: np.ndarray, offs: np.ndarray, sizes: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the chunks of all rows of a step."""
    row, start, end = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(len(offs) - 1):
        a, b = int(offs[k]), int(offs[k + 1])
        e = borders(buf[a:b], *sizes) + a
        if len(e):
            row.append(np.full(len(e), k))
            start.append(np.concatenate([[a], e[:-1]]))
            end.append(e)
    return np.concatenate(row), np.concatenate(start), np.concatenate(end)


def met_again(docs: DataFrame, sizes: tuple[int, int, int], flush: int = 1 << 20) -> DataFrame:
    """d: 64-bit hashes of chunks that occur twice or more; tasks send a hash and its count once per ``flush`` chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            d, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(d.view(np.int64)), pa.array(count)], names=["d", "n"])

        for batch in batches:
            for _, _, buf, offs in steps(batch):
                _, start, end = _cut_up(buf, offs, sizes)
                held.append(Prefix(buf).of(start, end))
                n += len(start)
                if n >= flush:
                    yield out()
                    held, n = [], 0
        if n:
            yield out()

    counted = docs.select("text").mapInArrow(run, "d bigint, n bigint")
    return counted.groupBy("d").agg(F.sum("n").alias("n")).filter("n > 1").select("d")


def bit_map(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bits 0 to 2**bits - 1, set at the upper ``bits`` bits of every hash ``d``: 2**bits / 8 bytes whatever the input."""
    at = F.shiftrightunsigned("d", 64 - bits) + 1
    parts = (hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).toArrow())
    out = np.zeros((1 << bits) // 8, np.uint8)
    for b, m in zip(parts.column("b").to_pylist(), parts.column("m")):
        part = out[(b - 1) * 4096:b * 4096]
        part[:] = np.frombuffer(m.as_buffer(), np.uint8)[:len(part)]
    return out


def chunks(docs: DataFrame, sizes: tuple[int, int, int], bits: int = 26) -> DataFrame:
    """(doc_id, _h, pos, len, d1, d2): the chunks that may occur twice, with their 128-bit digests.

    A map of 2**bits bits over the hashes met twice tells which chunks
    need not be looked at again. It lets all others through, repeated or
    not; on a corpus that fills it, everything passes and only the
    shuffles grow.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bit_map(met_again(docs, sizes), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("_h")
            for i, _, buf, offs in steps(batch):
                row, start, end = _cut_up(buf, offs, sizes)
                at = (Prefix(buf).of(start, end) >> np.uint64(64 - bits)).astype(np.int64)
                often = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                row, start, end = row[often], start[often], end[often]
                if not len(row):
                    continue
                raw = memoryview(buf)
                digests = [hashlib.blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(start.tolist(), end.tolist())]
                take = pa.array(row + i)
                d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), keys.take(take), pa.array((start - offs[row]).astype(np.int32)),
                     pa.array((end - start).astype(np.int32)), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())],
                    names=["doc_id", "_h", "pos", "len", "d1", "d2"])

    return docs.select(*row_key(), "text").mapInArrow(run, "doc_id bigint, _h bigint, pos int, len int, d1 bigint, d2 bigint")


def substring_dedup(docs: DataFrame, min_run: int = 128, mask_bits: int = 6, shortest: int = 32,
                    longest: int = 512, bits: int = 26) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated, kept_text.

    ``n_removed`` and ``n_spans`` count the removed bytes and their
    maximal runs, ``n_repeated`` the bytes of repeated passages, first
    occurrences included; ``kept_text`` holds the bytes left.
    """
    all_chunks = saved(chunks(docs, (mask_bits, shortest, longest), bits))
    # One row per digest that occurs twice or more: counts and the first place are summed before the shuffle.
    twice = (all_chunks.groupBy("d1", "d2")
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "pos", "_h")).alias("first"))
             .filter("n > 1").drop("n").repartition("first", "d1", "d2"))
    repeated = (all_chunks.join(twice, ["d1", "d2"])
                .select("doc_id", "_h", "pos", "len",
                        F.struct("doc_id", "pos", "_h").eqNullSafe(F.col("first")).alias("keep"))
                .groupBy("doc_id", "_h")
                .agg(F.array_sort(F.collect_set(F.struct("pos", "len", "keep"))).alias("spans")))
    rows = docs.select(*row_key(), "text").alias("r")
    joined = (rows.join(repeated.alias("s"), F.col("r.doc_id").eqNullSafe(F.col("s.doc_id"))
                        & (F.col("r._h") == F.col("s._h")), "left")
              .select("r.doc_id", "r.text", F.col("s.spans.pos").alias("pos"), F.col("s.spans.len").alias("len"),
                      F.col("s.spans.keep").alias("keep")))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = raw_bytes(text_column(batch))
            pos, size, keep = (batch.column(c).to_pylist() for c in ("pos", "len", "keep"))
            out: list[list] = [[], [], [], [], [], []]
            for k in range(batch.num_rows):
                text = buf[offs[k]:offs[k + 1]]
                row = strip_one(text, pos[k], size[k], keep[k], min_run)
                for col, v in zip(out, row):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string()),
                 pa.array(out[4], pa.int64()), pa.array(out[5], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated", "kept_text"])

    return joined.mapInArrow(strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                    "kept_sha256 string, n_repeated bigint, kept_text binary")


def strip_one(text: np.ndarray, pos: list | None, size: list | None, keep: list | None, min_run: int) -> tuple:
    """(bytes, removed, spans, sha of the rest, repeated, rest) of one text."""
    gone = np.zeros(len(text) + 2, bool)
    repeated = 0
    if pos:
        p, n, first = np.array(pos), np.array(size), np.array(keep)
        run = np.cumsum(np.concatenate([[1], (p[1:] != p[:-1] + n[:-1])])) - 1
        long = np.bincount(run, n)[run] >= min_run
        repeated = int(n[long].sum())
        drop = long & ~first
        gone[ragged(p[drop], n[drop]) + 1] = True
    rest = text[~gone[1:-1]].tobytes()
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return len(text), len(text) - len(rest), spans, hashlib.sha256(rest).hexdigest(), repeated, rest
