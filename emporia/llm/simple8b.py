"""Operator 2: token ids in Simple-8b words.

A 64-bit word holds a 4-bit selector and 60 data bits: as many ids of
equal width as fit. Ids wider than 60 bits are escapes: their word holds
an index into a list kept beside the words. Ids are packed in blocks of
``BLOCK``; the word offset of every block is stored, so a reader can
start at any block and a whole segment is decoded without a loop over
words.

A store is a folder of Parquet files, written by Spark's committer and
so safe against lost executors. One row is a segment: the ids of a run
of documents (each followed by the end id) in ascending doc_id order,
null first, rows that repeat an id ordered by a hash of their text.
Segments know the ids before them in their shard (a range of doc_id);
a reader adds the totals of the shards before. Null text counts as
empty and yields the end id only; an empty table gives an empty store.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.llm.common import lists, ragged, steps
from emporia.llm.hashing import Prefix, Table, words
from emporia.session import checkpoint_dir

# Fixed values of the format: ids per word and their width, by selector.
COUNT = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTH = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
ESCAPE = 14
BLOCK = 128
U = np.uint64


_SMALL = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of every id (0 for 0), exact for 64 bits."""
    if ids.size and ids.max() < len(_SMALL):
        return _SMALL[ids.astype(np.int64)]
    high = (ids >> U(32)).astype(np.float64)
    low = (ids & U(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)


def _first_fit(bits: np.ndarray) -> np.ndarray:
    """For every place in a block the selector that takes the most ids from there on.

    A place that fits a selector fits all later ones (fewer, wider
    ids), so every step looks only at places that fitted the one before.
    """
    blocks, wide = bits.shape
    best = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    most, reach, s = bits.copy(), 1, ESCAPE - 1
    while s >= 0:
        while reach < COUNT[s]:
            np.maximum(most[:, :wide - reach], bits[:, reach:], out=most[:, :wide - reach])
            reach += 1
        fits = most[:, :BLOCK] <= WIDTH[s]
        best[fits] = s
        s -= 1
        if np.count_nonzero(fits) < fits.size // 16:
            break
    at = np.flatnonzero(best == s + 1)
    at = at // BLOCK * wide + at % BLOCK
    flat, top = bits.ravel(), most.ravel()[at]
    while s >= 0 and len(at):
        while reach < COUNT[s]:
            top = np.maximum(top, flat[at + reach])
            reach += 1
        fits = top <= WIDTH[s]
        at, top = at[fits], top[fits]
        best[at // wide, at % wide] = s
        s -= 1
    return best


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of every block, escaped ids)."""
    ids = ids.astype(U)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, U)
    wide = BLOCK + int(COUNT[0])
    grid = np.zeros((blocks, wide), U)  # padded: the last word of a block may reach beyond it
    flat = np.zeros(blocks * BLOCK, U)
    flat[:len(ids)] = ids
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    bits = np.zeros((blocks, wide), np.uint8)
    bits[:, :BLOCK] = _widths(grid[:, :BLOCK])
    best = _first_fit(bits)
    # All blocks advance together, one word per round.
    at, row = np.zeros(blocks, np.int64), np.arange(blocks)
    rows, places, chosen = [], [], []
    while len(row):
        s = best[row, at]
        rows.append(row)
        places.append(at)
        chosen.append(s)
        at = at + COUNT[s]
        more = at < BLOCK
        row, at = row[more], at[more]
    row, place, sel = np.concatenate(rows), np.concatenate(places), np.concatenate(chosen)
    order = np.argsort(row, kind="stable")
    row, place, sel = row[order], place[order], sel[order]
    words = sel.astype(U) << U(60)
    for s in range(ESCAPE):
        pick = np.flatnonzero(sel == s)
        for k in range(COUNT[s] if len(pick) else 0):
            words[pick] |= grid[row[pick], place[pick] + k] << U(k * int(WIDTH[s]))
    pick = np.flatnonzero(sel == ESCAPE)
    words[pick] |= np.arange(len(pick), dtype=U)
    return words, np.searchsorted(row, np.arange(blocks)), grid[row[pick], place[pick]]


def unpack(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of a segment (uint64)."""
    if not n_ids:
        return np.zeros(0, U)
    sel = (words >> U(60)).astype(np.int64)
    data = words & U((1 << 60) - 1)
    count = COUNT[sel]
    before = np.cumsum(count) - count
    block = np.searchsorted(first, np.arange(len(words)), "right") - 1
    place = before - before[first][block]
    out = np.zeros(len(first) * BLOCK, U)
    for s in np.unique(sel).tolist():
        pick = np.flatnonzero(sel == s)
        for k in range(COUNT[s]):
            inside = place[pick] + k < BLOCK
            p = pick[inside]
            if s == ESCAPE:
                value = escapes[data[p].astype(np.int64)]
            else:
                value = (data[p] >> U(k * int(WIDTH[s]))) & U((1 << int(WIDTH[s])) - 1)
            out[block[p] * BLOCK + place[p] + k] = value
    return out[:n_ids]


class Memo(dict):
    """piece -> number; the pieces met for the first time are listed in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Rows:
    """Growing list of id runs in one flat array."""

    def __init__(self) -> None:
        self.flat, self.ends, self.n, self.used = np.zeros(1 << 12, np.uint32), np.zeros(1 << 10, np.int64), 0, 0

    def add(self, runs: list) -> None:
        lens = np.fromiter(map(len, runs), np.int64, len(runs))
        self.append(np.fromiter((x for r in runs for x in r), np.uint32, int(lens.sum())), np.cumsum(lens))

    def append(self, ids: np.ndarray, ends: np.ndarray) -> None:
        """Add the runs of ``ids`` that end at ``ends``."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(ends) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.ends[self.n:self.n + len(ends)] = self.used + ends
        self.n += len(ends)
        self.used += len(ids)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the runs one after the other, length of each)."""
        ends = self.ends[numbers]
        starts = np.where(numbers > 0, self.ends[np.maximum(numbers - 1, 0)], 0)
        return self.flat[ragged(starts, ends - starts)], ends - starts


class WordEncoder:
    """Ids of whole texts as the tokenizers library gives them, from the ids of their words.

    Right for tokenizers that drop white space, never join across it
    and mark the last token of a word: the text is split at ASCII white
    space, every piece goes through the library once, and repeated
    pieces are looked up by a 64-bit hash.
    """

    MOST_PIECES, MOST_CORES = 900_000, 700_000  # remembered; then the memory starts afresh

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._fresh()

    def _fresh(self) -> None:
        self._forget_pieces()
        self.cores, self.core_rows = Memo(), Rows()  # letters, or what else the library got at once

    def _forget_pieces(self) -> None:
        self.seen, self.rows = Table(21), Rows()  # pieces by their hash

    def _bounded(self) -> None:
        if len(self.cores) > self.MOST_CORES or self.core_rows.used > 8 * self.MOST_CORES:
            self._fresh()
        elif self.rows.n > self.MOST_PIECES or self.rows.used > 8 * self.MOST_PIECES:
            self._forget_pieces()  # learnt again from the cores, without the library

    def _library(self) -> None:
        """Ids of the new cores. Plain words go in one text: each ends with its first closing token."""
        new, self.cores.new = self.cores.new, []
        plain = np.fromiter((c.isalpha() and max(c) <= "\xff" for c in new), bool, len(new))
        rest = [c for c, p in zip(new, plain.tolist()) if not p]
        runs = [e.ids for e in self.tok.encode_batch_fast(rest, add_special_tokens=False)]
        other = Rows()
        other.add(runs)
        words = [c for c, p in zip(new, plain.tolist()) if p]
        for k in range(0, len(words), 2000):
            ids = np.array(self.tok.encode(" ".join(words[k:k + 2000]), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(words[k:k + 2000]):
                raise ValueError("the tokenizer does not close every word once")
            other.append(ids, ends)
        place = np.empty(len(new), np.int64)
        place[~plain] = np.arange(len(rest))
        place[plain] = len(rest) + np.arange(len(words))
        ids, lens = other.take(place)
        self.core_rows.append(ids, np.cumsum(lens))

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces. Letters and the punctuation after them are separate for the tokenizer."""
        parts = []
        for w in pieces:
            core = w.rstrip(".,;:!?*$%&#")
            if core.isalpha():
                parts.append(core.lower() if core.isascii() else core)
                parts.append(w[len(core):])
            else:
                parts.append(w)
                parts.append("")
        numbers = np.fromiter(map(self.cores.__getitem__, parts), np.int64, len(parts))
        if self.cores.new:
            self._library()
        ids, lens = self.core_rows.take(numbers)
        self.rows.append(ids, np.cumsum(lens)[1::2])

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number per text) of UTF-8 texts and their offsets."""
        self._bounded()
        start, end, row = words(buf, offs)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        h = Prefix(buf).of(start, end)
        numbers = self.seen.find(h)
        miss = np.flatnonzero(numbers < 0)
        if len(miss):
            keys, first, of = np.unique(h[miss], return_index=True, return_inverse=True)
            raw, at = buf.tobytes(), miss[first]
            known = self.rows.n
            self._learn([raw[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist())])
            self.seen.add(keys, known + np.arange(len(keys)))
            numbers[miss] = known + of
        ids, lens = self.rows.take(numbers)
        total = np.concatenate([[0], np.cumsum(lens)])
        return ids, np.diff(total[np.searchsorted(row, np.arange(len(offs)))])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


_SEGMENT = ("shard int, seq int, ids_before bigint, n_ids bigint, doc_ids array<bigint>, doc_lens array<int>, "
            "block_words array<int>, words binary, escapes binary")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizer file and write the store at ``path``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        shard, seq, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for i, j, buf, offs in steps(batch):
                ids, lens = enc.encode(buf, offs)
                full = np.full(len(ids) + (j - i), end_id, np.uint32)
                ends = np.cumsum(lens)
                full[ragged(np.concatenate([[0], ends[:-1]]) + np.arange(j - i), lens)] = ids
                words, first, escapes = pack(full)
                n = len(full)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "seq": pa.array([seq], pa.int32()),
                    "ids_before": pa.array([before], pa.int64()), "n_ids": pa.array([n], pa.int64()),
                    "doc_ids": pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()),
                                                        batch.column("doc_id").slice(i, j - i)),
                    "doc_lens": lists((lens + 1).astype(np.int32), np.array([0, j - i])),
                    "block_words": lists(first.astype(np.int32), np.array([0, len(first)])),
                    "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
                    "escapes": pa.array([escapes.astype("<u8").tobytes()], pa.binary())})
                seq, before = seq + 1, before + n

    key = F.xxhash64(F.coalesce("text", F.lit("")))
    (docs.select("doc_id", "text", key.alias("_h")).repartitionByRange("doc_id", "_h")
     .sortWithinPartitions("doc_id", "_h").select("doc_id", "text").mapInArrow(encode, _SEGMENT)
     .write.option("compression", "zstd").parquet(path))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The store's rows with ``base``: ids in all segments before. Totals per shard, not ids, meet in one task."""
    stored = spark.read.schema(_SEGMENT).parquet(path)
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    ahead = totals.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("_ahead"))
    # One row per task that wrote: bounded by the number of range partitions, and broadcast so that no payload is shuffled.
    return stored.join(F.broadcast(ahead), "shard").withColumn("base", F.col("_ahead") + F.col("ids_before")).drop("_ahead")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store: doc_id, start, n_tokens, ids_crc32, ids (little-endian unsigned 32-bit integers)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["words"], "<u8"), np.array(row["block_words"], np.int64),
                             np.frombuffer(row["escapes"], "<u8"), row["n_ids"])
                raw = memoryview(ids.astype("<u4").tobytes())
                lens = np.array(row["doc_lens"], np.int64)
                ends = np.cumsum(lens)
                parts = [raw[4 * a:4 * b] for a, b in zip((ends - lens).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["base"] + ends - lens), pa.array(lens),
                     pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                     pa.array([bytes(p) for p in parts], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    # A handful of segments per Arrow batch is enough: each holds megabytes of text.
    return (segments(spark, path).drop("shard", "seq", "ids_before")
            .mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"))


def token_output(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the store (in the shared folder unless ``path`` is given) and read it back."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/tokens/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(spark, path)
