"""Operator 3: long repeated substrings by a run-length index.

Removed is every byte covered by a string of ``length`` bytes that also
starts anywhere else in the corpus, the same text included; matches do
not cross texts and are judged on the input.

How the corpus reaches the index: of every window of ``length`` bytes
the smallest hash of its 32-byte strings marks an anchor. Equal windows
have equal anchors, so windows are compared only within an anchor key.
Consecutive windows with one anchor form a segment. A segment met twice
is repeated as a whole and is counted before any shuffle; only keys with
different segments need a closer look, at one copy of each of them.

The index over such a block of segments: suffix order by doubling, the
Burrows-Wheeler transform kept as runs (symbol, start, occurrences
before), and the suffix positions at run ends. Matching statistics are
streamed from right to left through all segments of the block at once:
a step left maps the interval of rows that share the next ``length``
bytes through the runs; while two rows are left, the match with another
place goes on, and where it breaks off the stream is anchored again at
its own row. Keys with more than ``most_kinds`` different segments are
counted window by window instead, combined before the shuffle: exact
too, and no task ever holds a hot key.

Null or short text: nothing removed. Rows that repeat count as documents
of their own, so both lose what they share. Other columns are ignored;
an empty table gives an empty result. A text is held whole in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import ragged, raw_bytes, row_key, saved, steps, text_column
from emporia.llm.hashing import U, Prefix, mix

LENGTH = 400
GRAM = 32
BLOCK_BYTES = 2 << 20
# Shorter repeats are reported, not removed: every repeat of REACH bytes shows in a sampled string of SAMPLE bytes.
SAMPLE, REACH = 128, 298


def window_anchors(key: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` places the place of its smallest key, the first of equal ones."""
    n = len(key) - width + 1
    place = (key & ~U(0xFFFFFFFF)) | np.arange(len(key), dtype=U)
    blocks = -(-len(key) // width)
    grid = np.full(blocks * width, ~U(0))
    grid[:len(key)] = place
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    return (np.minimum(ahead[:n], behind[width - 1:width - 1 + n]) & U(0xFFFFFFFF)).astype(np.int64)


def segments(buf: np.ndarray, offs: np.ndarray, length: int, prefix: Prefix, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, bytes, anchor key, content hash) of the segments of every row; ``key``: hash of every GRAM bytes."""
    none = np.zeros(0, np.int64)
    width = length - GRAM + 1
    lens = np.diff(offs)
    if len(buf) < length or lens.max() < length:
        return none, none, none, none.view(U), none.view(U)
    anchor = window_anchors(key, width)
    # Window starts whose whole window lies in one row, and where a new segment begins.
    count = np.maximum(lens - length + 1, 0)
    starts = ragged(offs[:-1], count)
    row = np.repeat(np.arange(len(lens)), count)
    a = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (a[1:] != a[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    begin, end = starts[first], starts[last] + length
    return row[first], begin - offs[row[first]], end - begin, key[a[first]], prefix.of(begin, end)


def samples(offs: np.ndarray, prefix: Prefix, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, content hash) of strings of ``SAMPLE`` bytes that start at the smallest key of REACH - SAMPLE + 1
    places: two equal stretches of ``REACH`` bytes hold the same sample, whatever stands around them."""
    width = REACH - SAMPLE + 1
    count = np.maximum(np.diff(offs) - REACH + 1, 0)
    if not count.any():
        none = np.zeros(0, np.int64)
        return none, none, none.view(U)
    row = np.repeat(np.arange(len(count)), count)
    a = window_anchors(key, width)[ragged(offs[:-1], count)]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (row[1:] != row[:-1])
    row, a = row[new], a[new]
    return row, a - offs[row], prefix.of(a, a + SAMPLE)


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a list of byte strings."""

    def __init__(self, text: np.ndarray, lens: np.ndarray, depth: int):
        """``text``: the strings one after the other; ``depth``: bytes that a match must have."""
        m = len(lens)
        self.size = n = len(text) + m  # every string is followed by an end mark of its own, smaller than any byte
        ends = np.cumsum(lens) + np.arange(m)
        self.begin = ends - lens
        symbol = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        symbol[inside] = text.astype(np.int64) + m
        symbol[ends] = np.arange(m)
        self._sort(symbol, m, depth)
        # The transform: the symbol before each suffix; 0 stands for the mark before a string's start.
        before = np.zeros(n, np.int64)
        before[1:] = np.where(inside[:-1], symbol[:-1] - m + 1, 0)
        transform = before[self.order]
        head = np.ones(n, bool)
        head[1:] = transform[1:] != transform[:-1]
        start = np.flatnonzero(head)
        symbols, runs = transform[start], np.diff(np.append(start, n))
        self.run_ends = self.order[start + runs - 1]  # sampled suffix positions
        by = np.lexsort((start, symbols))
        start, symbols, runs = start[by], symbols[by], runs[by]
        total = np.cumsum(runs) - runs
        first = np.ones(len(by), bool)
        first[1:] = symbols[1:] != symbols[:-1]
        opening = total[np.flatnonzero(first)][np.cumsum(first) - 1]
        self.run_key, self.run_len, self.run_before = symbols * (n + 1) + start, runs, total - opening
        # Rows before the first suffix that starts with a byte: end marks, then the smaller bytes.
        each = np.bincount(text, minlength=256) if len(text) else np.zeros(256, np.int64)
        self.below = m + np.cumsum(each) - each
        self.symbol = symbol - m

    def _sort(self, symbol: np.ndarray, m: int, depth: int) -> None:
        """Suffix order by doubling; only suffixes that still have equals are sorted again."""
        n = len(symbol)
        bits = int(m + 256).bit_length()
        take = max(1, min(62 // bits, depth))
        packed = np.zeros(n, np.int64)
        padded = np.concatenate([symbol, np.zeros(take, np.int64)])
        for k in range(take):
            packed = (packed << bits) | padded[k:k + n]
        rank = np.empty(n, np.int64)
        order = np.argsort(packed, kind="stable")
        rank[order], same = _groups(packed[order], np.arange(n))
        open_ = order[same]
        known, self.group = take, None
        while True:
            if known == depth and self.group is None:
                self.group = rank.copy()  # first row with the same ``depth`` bytes
            if not len(open_):
                break
            # Never past ``depth`` in one step, so that the rows equal up to it are met.
            add = min(known, depth - known) if known < depth else known
            key = rank[open_] * (n + 1) + rank[np.minimum(open_ + add, n - 1)]
            by = np.argsort(key, kind="stable")
            open_, key = open_[by], key[by]
            old = rank[open_]
            fresh = np.ones(len(old), bool)
            fresh[1:] = old[1:] != old[:-1]
            base = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            new, same = _groups(key, old + np.arange(len(old)) - base)
            rank[open_] = new
            open_ = open_[same]
            known += add
        if self.group is None:
            self.group = rank
        self.row = rank
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is in the transform above ``row``, from the runs."""
        k = np.searchsorted(self.run_key, (symbol + 1) * (self.size + 1) + row, "right") - 1
        k_start = self.run_key[k] - (symbol + 1) * (self.size + 1)
        mine = (k >= 0) & (k_start >= 0)
        return np.where(mine, self.run_before[k] + np.minimum(row - k_start, self.run_len[k]), 0)

    def left(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Row border after a step left by ``symbol``."""
        return self.below[symbol] + self.before(symbol, row)

    def repeated(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(string, start) of the windows that also start elsewhere; ``windows``: number of window starts per string.

        Streams all strings from their last window to their first.
        """
        group_size = np.bincount(self.group, minlength=self.size)
        text = np.argsort(-windows, kind="stable")
        text = text[windows[text] > 0]
        at = self.begin[text] + windows[text] - 1
        low = self.group[at]
        high = low + group_size[low]
        found_text, found_at = [], []
        while len(text):
            hit = high - low >= 2
            found_text.append(text[hit])
            found_at.append(at[hit])
            on = at > self.begin[text]
            text, at, low, high = text[on], at[on] - 1, low[on], high[on]
            c = self.symbol[at]
            low, high = self.left(c, low), self.left(c, high)
            lost = high - low < 2  # no other place has this byte before the match: anchor at the own row
            low[lost] = self.group[at[lost]]
            high[lost] = low[lost] + group_size[low[lost]]
        text = np.concatenate(found_text) if found_text else np.zeros(0, np.int64)
        at = np.concatenate(found_at) if found_at else np.zeros(0, np.int64)
        return text, at - self.begin[text]


def _groups(key: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: the place of the first equal one, and whether there are equals."""
    fresh = np.ones(len(key) + 1, bool)
    fresh[1:-1] = key[1:] != key[:-1]
    first = np.flatnonzero(fresh[:-1])[np.cumsum(fresh[:-1]) - 1] if len(key) else np.zeros(0, np.int64)
    return places[first], ~(fresh[:-1] & fresh[1:])


def spans_of(text: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, bytes) of the runs of consecutive window starts."""
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(text)) - 1
    return text[first], start[first], start[last] - start[first] + length if len(first) else first


_OCCURRENCE = "doc_id bigint, _h bigint, key bigint, seg bigint, start int, len int"


def occurrences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every segment of every row, and every sample (without bytes and key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, buf, offs in steps(batch):
                if len(buf) < min(length, REACH):
                    continue
                prefix = Prefix(buf)
                grams = mix(prefix.fixed(GRAM), 61)
                row, start, size, key, seg = segments(buf, offs, length, prefix, grams)
                row2, start2, seg2 = samples(offs, prefix, grams)
                none = np.zeros(len(row2), np.int64)
                row, start, size = (np.concatenate(x) for x in ((row, row2), (start, start2), (size, none)))
                key, seg = np.concatenate([key, none.view(U)]), np.concatenate([seg, seg2])
                if len(row):
                    take = pa.array(row + i)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(take), batch.column("_h").take(take),
                         pa.array(key.view(np.int64)), pa.array(seg.view(np.int64)),
                         pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))],
                        names=["doc_id", "_h", "key", "seg", "start", "len"])

    return docs.select(*row_key(), "text").mapInArrow(run, _OCCURRENCE)


def _same_row(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}._h") == F.col(f"{b}._h"))


def _bytes_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (doc_id, _h, key, start, len, n) with the bytes of each segment."""
    asked = wanted.groupBy("doc_id", "_h").agg(F.collect_list(F.struct("key", "start", "len", "n")).alias("w"))
    rows = docs.select(*row_key(), "text").alias("r")
    joined = (rows.join(asked.alias("s"), _same_row("r", "s"))
              .select("r.doc_id", "r._h", "r.text", "s.w.key", "s.w.start", "s.w.len", "s.w.n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = raw_bytes(text_column(batch))
            counts = np.diff(batch.column("key").offsets.to_numpy())
            take = np.repeat(np.arange(batch.num_rows), counts)
            key, start, size, n = (batch.column(c).flatten() for c in ("key", "start", "len", "n"))
            a, b = start.to_numpy().astype(np.int64) + offs[take], size.to_numpy().astype(np.int64)
            for lo in range(0, len(take), 2000):
                part = slice(lo, lo + 2000)
                flat = buf[ragged(a[part], b[part])]
                ends = np.concatenate([[0], np.cumsum(b[part])]).astype(np.int32)
                data = pa.Array.from_buffers(pa.binary(), len(ends) - 1,
                                             [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())])
                rows_ = pa.array(take[part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows_), batch.column("_h").take(rows_), key.slice(lo, 2000),
                     start.slice(lo, 2000), n.slice(lo, 2000), data],
                    names=["doc_id", "_h", "key", "start", "n", "text"])

    return joined.mapInArrow(run, "doc_id bigint, _h bigint, key bigint, start int, n bigint, text binary")


_SPAN = "doc_id bigint, _h bigint, start int, len int"


def _indexed(members: DataFrame, length: int) -> DataFrame:
    """Repeated spans of the segments (members: rows of ``_bytes_of``) that are met once, by the index of their block."""

    def look(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        batch = rows.to_batches()[0]
        buf, offs = raw_bytes(text_column(batch))
        lens = np.diff(offs)
        once = batch.column("n").to_numpy(zero_copy_only=False) == 1
        index = RunIndex(buf, lens, length)
        text, at = index.repeated(np.where(once, lens - length + 1, 0))
        text, first, size = spans_of(text, at, length)
        take = pa.array(text)
        begin = batch.column("start").to_numpy(zero_copy_only=False)[text] + first
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("_h").take(take), pa.array(begin.astype(np.int32)),
             pa.array(size.astype(np.int32))], names=["doc_id", "_h", "start", "len"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by key: a block ends at a key border, and holds BLOCK_BYTES or the segments of one key.
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            offs = raw_bytes(text_column(batch))[1]
            borders = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
            if held and key[0] == held[-1].column("key")[-1].as_py():
                borders = borders[1:]
            begin = 0
            for b in borders:
                if size + offs[b] - offs[begin] >= BLOCK_BYTES:
                    held.append(batch.slice(begin, b - begin))
                    yield look(pa.Table.from_batches(held))
                    held, size, begin = [], 0, b
            held.append(batch.slice(begin))
            size += offs[-1] - offs[begin]
        if size:
            yield look(pa.Table.from_batches(held))

    return members.repartition("key").sortWithinPartitions("key").mapInArrow(run, _SPAN)


def _counted(members: DataFrame, length: int) -> DataFrame:
    """The same for hot keys: every window by its hash, counted in the whole key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in steps(batch, most=BLOCK_BYTES // 16):
                count = np.diff(offs) - length + 1
                at = ragged(offs[:-1], count)
                row = np.repeat(np.arange(i, j), count)
                prefix = Prefix(buf)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("_h").take(take),
                     pa.array((batch.column("start").to_numpy(zero_copy_only=False)[row] + at - offs[row - i]).astype(np.int32)),
                     batch.column("key").take(take), pa.array(prefix.of(at, at + length).view(np.int64)),
                     batch.column("n").take(take)], names=["doc_id", "_h", "start", "key", "w", "n"])

    windows = members.mapInArrow(run, "doc_id bigint, _h bigint, start int, key bigint, w bigint, n bigint")
    twice = windows.groupBy("key", "w").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key", "w")
    return (windows.filter("n = 1").join(twice, ["key", "w"])
            .select("doc_id", "_h", "start", F.lit(length).alias("len")))


def _shared(sampled: DataFrame) -> DataFrame:
    """doc_id, _h, shared: how many of a row's samples occur elsewhere too."""
    twice = sampled.groupBy("seg").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").repartition("c", "seg")
    return sampled.join(twice, "seg", "left_semi").groupBy("doc_id", "_h").agg(F.count(F.lit(1)).alias("shared"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, most_kinds: int = 2048) -> DataFrame:
    """(doc_id, _h, spans, shared) of rows that have any: array of (start, len) of the bytes to remove, overlapping,
    and the number of samples that occur elsewhere."""
    stored = saved(occurrences(docs, length))
    found = stored.filter("len > 0")
    keys = found.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    # (Aggregates are dealt out by another column before a join: only then Spark can split a hot key there.)
    again = saved(found.join(keys.repartition("c", "key").select("key"), "key"))
    kinds = saved(again.groupBy("key", "seg").agg(F.count(F.lit(1)).alias("n"),
                                                  F.min(F.struct("doc_id", "_h", "start", "len")).alias("f")))
    whole = (again.join(kinds.filter("n > 1").select("key", "seg"), ["key", "seg"])
             .select("doc_id", "_h", "start", "len"))
    several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    several = several.repartition("kinds", "key")
    members = saved(_bytes_of(docs, kinds.join(several, "key").select("key", "n", "f.*"))
                    .join(several, "key"))
    part = _indexed(members.filter(F.col("kinds") <= most_kinds).drop("kinds"), length)
    hot = _counted(members.filter(F.col("kinds") > most_kinds).drop("kinds"), length)
    spans = whole.unionByName(part).unionByName(hot).select(
        "doc_id", "_h", F.struct("start", "len").alias("span"), F.lit(0).cast("bigint").alias("shared"))
    none = F.lit(None).cast(spans.schema["span"].dataType)
    return (spans.unionByName(_shared(stored.filter("len = 0")).select("doc_id", "_h", none.alias("span"), "shared"))
            .groupBy("doc_id", "_h").agg(F.collect_set("span").alias("spans"), F.max("shared").alias("shared")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, most_kinds: int = 2048) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared, kept_text.

    ``n_shared`` counts the row's sampled strings of ``SAMPLE`` bytes that
    occur elsewhere too; a row that repeats ``REACH`` bytes or more of
    another place has one at least. Nothing is removed for it.
    """
    spans = repeated_spans(docs, length, most_kinds)
    rows = docs.select(*row_key(), "text").alias("r")
    joined = (rows.join(spans.alias("s"), _same_row("r", "s"), "left")
              .select("r.doc_id", "r.text", "s.spans.start", "s.spans.len", F.coalesce("s.shared", F.lit(0)).cast("bigint").alias("n_shared")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = raw_bytes(text_column(batch))
            start, size = batch.column("start").to_pylist(), batch.column("len").to_pylist()
            out: list[list] = [[], [], [], [], []]
            for k in range(batch.num_rows):
                text = buf[offs[k]:offs[k + 1]]
                level = np.zeros(len(text) + 2, np.int64)
                if start[k]:
                    a = np.array(start[k], np.int64) + 1
                    np.add.at(level, a, 1)
                    np.add.at(level, a + np.array(size[k], np.int64), -1)
                gone = np.cumsum(level) > 0
                rest = text[~gone[1:-1]].tobytes()
                for col, v in zip(out, (len(text), len(text) - len(rest), int(np.count_nonzero(gone[1:] & ~gone[:-1])),
                                        hashlib.sha256(rest).hexdigest(), rest)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string()),
                 batch.column("n_shared"), pa.array(out[4], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared", "kept_text"])

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                  "kept_sha256 string, n_shared bigint, kept_text binary")
