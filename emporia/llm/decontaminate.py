"""Operator 7: benchmark decontamination by CGK embedding.

A document is contaminated by a benchmark item when some stretch of it
is within ``edits`` (a share of the item's words) of the item in edit
distance over words (A-Z lowered, split at white space).

The CGK random walk writes the symbol it stands on and moves on or stays
by a hash of step and symbol, so texts at small edit distance get
strings at small Hamming distance. Each repeat draws its own walk and
samples ``SAMPLED`` places of the string; a window is a candidate for
the items whose samples are equal in any repeat. The number of repeats
is chosen on the items themselves: copies of every item with the allowed
number of random edits must be met with the target recall. An item that
would take more than ``REPEATS`` repeats for that is not sampled: all
its windows are candidates, so its recall is 1 (the exact distance costs
less than so many walks). Candidates are decided by the exact edit
distance between the item and the best stretch around the window.

Windows: by the pigeonhole principle an item with the allowed edits
keeps a run of ``_seed`` unchanged words. Only windows of the item's
size that line up with such a run are embedded, within the row that
holds the run; this loses no match.

The items are taken in blocks of ``block_items`` to the driver and into
the tasks; a longer benchmark takes more passes. No shuffle is needed.

Null or empty text has no match; null or empty items match nothing; an
item without item_id is found under a null id.
Repeated rows and items count each. Extra columns are ignored; empty
tables give empty or clean results. A text is held whole in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import SMALL_STEP, ragged, steps
from emporia.llm.hashing import U, grams, mix, word_hashes

EDITS = 0.2
SEED = 3          # longest run of words used to line windows up
SAMPLED = 3
RECALL = 0.995
BLOCK_BYTES = 4 << 20  # texts of the items held at a time, or one longer item
REPEATS = 64      # items that need more walks are decided without
_MEASURED = 4096  # words up to which walks are tried; a copy of a longer item with all its edits meets too seldom
_WINDOWS = 2048   # embedded at a time
_CELLS = 1 << 20  # at most of the arrays of such windows


def allowed(n: np.ndarray, edits: float) -> np.ndarray:
    return np.floor(n * edits + 1e-9).astype(np.int64)


def walk(words: np.ndarray, size: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Sampled places of the CGK strings: rows x repeats, one hash of ``SAMPLED`` symbols each.

    ``words``: rows x longest, padded with 0; ``size``: words of each
    row; ``seeds``: one number per repeat.
    """
    rows, repeats = len(words), len(seeds)
    # The same places for equal sizes, as fractions of the first 2 * size symbols: the walk is rarely past the text there.
    share = (mix(seeds[:, None] + np.arange(SAMPLED, dtype=U)[None, :], 71) >> U(11)).astype(np.float64) / 2.0 ** 53
    place = (share[None, :, :] * (2 * size)[:, None, None]).astype(np.int64)
    at = np.zeros((rows, repeats), np.int64)
    out = np.repeat(mix(size.astype(U), 72)[:, None], repeats, axis=1)
    padded = np.hstack([words, np.zeros((rows, 1), U)])
    line = np.arange(rows)[:, None]
    last = place.max(axis=(1, 2)).max() if rows else -1
    for t in range(int(last) + 1):
        symbol = padded[line, np.minimum(at, size[:, None])]
        for k in range(SAMPLED):
            here = place[:, :, k] == t
            if here.any():
                out[here] = mix(out[here] ^ mix(symbol[here], 73 + k), 74)
        at += (mix(symbol ^ seeds[None, :], 80 + t) >> U(63)).astype(np.int64)
    return out


def distance(item: np.ndarray, item_size: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edit distance of each item to the best stretch of its text row, end of that stretch)."""
    rows, width = text.shape
    col = np.arange(width + 1)
    row = np.zeros((rows, width + 1), np.int64)  # a stretch may start anywhere
    best = row.min(axis=1)
    end = np.zeros(rows, np.int64)
    for i in range(item.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (item[:, i:i + 1] != text), row[:, 1:] + 1)
        new = np.minimum.accumulate(new - col, axis=1) + col
        row = new
        done = item_size == i + 1
        if done.any():
            best[done], end[done] = row[done].min(axis=1), row[done].argmin(axis=1)
    return best, end


class Items:
    """A block of benchmark items ready for search."""

    def __init__(self, ids: list[int], texts: list[str], edits: float = EDITS, recall: float = RECALL):
        col = pa.array([t or "" for t in texts], pa.string())
        batch = pa.RecordBatch.from_arrays([col], names=["text"])
        seqs: list[np.ndarray] = []
        for i, j, buf, offs in steps(batch):
            h, row = word_hashes(buf, offs)
            ends = np.searchsorted(row, np.arange(j - i + 1))
            seqs += [h[a:b] for a, b in zip(ends[:-1], ends[1:])]
        keep = [k for k, s in enumerate(seqs) if len(s)]
        self.ids = [ids[k] for k in keep]
        seqs = [seqs[k] for k in keep]
        self.size = np.array([len(s) for s in seqs], np.int64)
        self.most = allowed(self.size, edits)
        self.words = padded(seqs)
        self.seeds: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        run = np.clip((self.size - self.most) // (self.most + 1), 1, SEED)
        for n in np.unique(run).tolist():
            hs, item, at = [], [], []
            for k in np.flatnonzero(run == n):
                g = grams(seqs[k], n)
                hs.append(g)
                item.append(np.full(len(g), k))
                at.append(np.arange(len(g)))
            h, item, at = np.concatenate(hs), np.concatenate(item), np.concatenate(at)
            order = np.argsort(h, kind="stable")
            self.seeds.append((n, h[order], item[order], at[order]))
        needed = self._needed(recall)
        #: Items that the walks need not meet.
        self.exact = needed > REPEATS
        self.repeats = int(needed[~self.exact].max(initial=1))
        self.walks = mix(np.arange(self.repeats, dtype=U), 90)
        self.signs = np.zeros((len(seqs), self.repeats), U)
        if not self.exact.all():
            sampled = np.flatnonzero(~self.exact)
            words = self.words[sampled, :self.size[sampled].max()]
            self.signs[sampled] = walk(words, self.size[sampled], self.walks)

    def _needed(self, recall: float, copies: int = 4, walks: int = 128) -> np.ndarray:
        """Per item the repeats that meet a copy with the allowed edits with the target probability (inf: none do).

        Measured on edited copies of every item. The rarest met copy
        counts, less two standard errors, as the walks are a sample.
        """
        rng = np.random.default_rng(5)
        seeds = mix(np.arange(walks, dtype=U), 91)
        needed = np.full(len(self.size), math.inf)
        by_size = np.argsort(self.size, kind="stable")
        by_size = by_size[self.size[by_size] <= _MEASURED]
        at = 0
        while at < len(by_size):
            # Items of about the same size at a time.
            mine = by_size[at:at + max(1, _CELLS // (walks * copies * 2 * int(self.size[by_size[at]])))]
            at += len(mine)
            longest = int(self.size[mine].max())
            of = np.repeat(mine, copies)
            edited = []
            for k in of:
                s = self.words[k, :self.size[k]].tolist()
                for _ in range(self.most[k]):
                    p, kind = int(rng.integers(len(s))), int(rng.integers(3))
                    new = int(rng.integers(1, 1 << 62))
                    s[p:p + 1] = [[new], [], [s[p], new]][kind] if len(s) > 1 else [new]
                n = int(self.size[k])  # the window has the item's size
                edited.append(np.array((s + [1] * n)[:n], U))
            met = walk(padded(edited), self.size[of], seeds) == walk(self.words[of, :longest], self.size[of], seeds)
            p = met.mean(axis=1)
            p = (p - 2 * np.sqrt((p * (1 - p) + 1 / walks) / walks)).reshape(-1, copies).min(axis=1)
            some = p > 0
            needed[mine[some]] = np.ceil(math.log(1 - recall) / np.log1p(-p[some]))
        return needed


def padded(seqs: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(seqs), max([len(s) for s in seqs], default=0)), U)
    for k, s in enumerate(seqs):
        out[k, :len(s)] = s
    return out


def windows(h: np.ndarray, row: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, first word in ``h``, row) of the windows that line up with an unchanged run of an item's words; distinct.

    The row is that of the run: a text that lacks the item's first and last words begins and ends inside its window.
    """
    item, start, held = [], [], []
    for n, keys, of, at in items.seeds:
        if len(h) < n or not len(keys):
            continue
        g = grams(h, n)
        sieve = np.zeros(1 << 20, bool)
        sieve[(keys >> U(44)).astype(np.int64)] = True
        pos = np.flatnonzero(sieve[(g >> U(44)).astype(np.int64)] & (row[:len(g)] == row[n - 1:]))
        lo, hi = np.searchsorted(keys, g[pos], "left"), np.searchsorted(keys, g[pos], "right")
        k = ragged(lo, hi - lo)
        item.append(of[k])
        start.append(np.repeat(pos, hi - lo) - at[k])
        held.append(np.repeat(row[pos], hi - lo))
    if not item:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    all_ = np.unique(np.stack([np.concatenate(x) for x in (item, start, held)], axis=1), axis=0)
    return all_[:, 0], all_[:, 1], all_[:, 2]


def search(buf: np.ndarray, offs: np.ndarray, items: Items) -> list[np.ndarray]:
    """(row, item, edits, first word, end word) of the matches in a run of texts; the best per row and item."""
    h, row = word_hashes(buf, offs)
    edge = np.searchsorted(row, np.arange(len(offs)))
    item, start, held = windows(h, row, items)
    out = [np.zeros(0, np.int64)] * 5
    found: list[list[np.ndarray]] = []
    # Windows of like size at a time, the longest first.
    order = np.argsort(-items.size[item], kind="stable")
    item, start, held, lo = item[order], start[order], held[order], 0
    while lo < len(item):
        hi = lo + max(1, min(_WINDOWS, _CELLS // (2 * int(items.size[item[lo]]))))
        it = item[lo:hi]
        found.append(_decide(h, edge, items, it, start[lo:hi], items.size[it], held[lo:hi]))
        lo = hi
    if found:
        cols = [np.concatenate(c) for c in zip(*found)]
        order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
        cols = [c[order] for c in cols]
        first = np.ones(len(order), bool)
        first[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        out = [c[first] for c in cols]
    return out


def _decide(h: np.ndarray, edge: np.ndarray, items: Items, it: np.ndarray, st: np.ndarray, size: np.ndarray,
            row: np.ndarray) -> list[np.ndarray]:
    """LSH and exact test of windows (item, start) within the words of ``row``."""
    begin, end = edge[row], edge[row + 1]
    width = int(size.max())
    place = st[:, None] + np.arange(width)[None, :]
    inside = (place >= begin[:, None]) & (place < end[:, None]) & (np.arange(place.shape[1])[None, :] < size[:, None])
    view = np.where(inside, h[np.clip(place, 0, len(h) - 1)], U(0))
    near = items.exact[it]
    ask = np.flatnonzero(~near)
    if len(ask):
        near[ask] = (walk(view[ask], size[ask], items.walks) == items.signs[it[ask]]).any(axis=1)
    it, st, row, begin, end, size = (x[near] for x in (it, st, row, begin, end, size))
    if not len(it):
        return [np.zeros(0, np.int64)] * 5
    slack = int(items.most[it].max())
    place = (st - slack)[:, None] + np.arange(width + 2 * slack)[None, :]
    inside = ((place >= begin[:, None]) & (place < end[:, None])
              & (np.arange(place.shape[1])[None, :] < (size + 2 * slack)[:, None]))
    # No item word is 1 (a hash): words beyond the row or window match nothing.
    view = np.where(inside, h[np.clip(place, 0, len(h) - 1)], U(1))
    edits, stop = distance(items.words[it, :width], size, view)
    ok = edits <= items.most[it]
    last = np.minimum(st - slack + stop, end) - begin
    return [row[ok], it[ok], edits[ok], np.maximum(last - size, 0)[ok], last[ok]]


_HITS = "array<struct<item_id:bigint,edits:int,first_word:int,end_word:int>>"


def contamination(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL,
                  block_items: int = 5000) -> DataFrame:
    """All columns of ``docs`` (but for one named hits) with ``hits``: item_id, edits and place of every benchmark item found in the text."""
    cols = [c for c in docs.columns if c != "hits"]
    out = docs.withColumn("hits", F.array().cast(_HITS))
    # Items of one size class (up to 4 KB, then a factor of 16 each) are held together, so a long one pads no others.
    size_class = F.greatest(F.lit(0), F.floor((F.log2(F.octet_length("text") + 1) - 8) / 4))
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text", size_class.alias("c")).filter("text is not null")
    classes = items.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).orderBy("c").collect()
    schema = out.schema
    for c, b, blocks in [(r.c, b, k) for r in classes for k in [math.ceil(max(r.n / block_items, r.b / BLOCK_BYTES, 1))] for b in range(k)]:
        # A bounded part of the stated query set at a time.
        mine = items.filter((F.col("c") == c) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)).orderBy("item_id", "text").collect()
        block = Items([r["item_id"] for r in mine], [r["text"] for r in mine], edits, recall)

        def run(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = batch.column("hits").to_pylist()
                for i, _, buf, offs in steps(batch, most=SMALL_STEP):
                    row, item, n, first, end = search(buf, offs, block)
                    for r, k, e, a, z in zip(row.tolist(), item.tolist(), n.tolist(), first.tolist(), end.tolist()):
                        hits[i + r] = [*hits[i + r], {"item_id": block.ids[k], "edits": e, "first_word": a,
                                                      "end_word": z}]
                yield batch.set_column(batch.schema.get_field_index("hits"), "hits",
                                       pa.array(hits, batch.schema.field("hits").type))

        out = out.mapInArrow(run, schema)
    return out.select(*cols, "hits")


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_items, item_ids (sorted), least_edits, contaminated, kept."""
    ids = F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["item_id"])))
    hit = F.size("hits") > 0
    return found.select("doc_id", F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
                        F.array_min(F.transform("hits", lambda x: x["edits"])).alias("least_edits"),
                        hit.alias("contaminated"), (~hit).alias("kept"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")  # as one column: no name can clash
    return contamination(rows, benchmark, edits).filter(F.size("hits") == 0).select("_row.*")
