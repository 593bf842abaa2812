"""Vectorised hashes of bytes, words and substrings (64 bits, wrapping)."""

from __future__ import annotations

import numpy as np

U = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1          # odd, hence invertible modulo 2**64
_INV = pow(_MULT, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser with full avalanche (the public splitmix64 one)."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A random 64-bit value for every byte, and the same with A-Z read as a-z.
BYTE = mix(np.arange(256, dtype=U), 7)
BYTE_LOWER = BYTE[_LOWER]
_pow = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """M**i and M**-i for i < n."""
    if len(_pow[0]) < n:
        size = max(n, 1 << 16)
        for k, m in enumerate((_MULT, _INV)):
            p = np.full(size, U(m))
            p[0] = U(1)
            _pow[k] = np.multiply.accumulate(p)
    return _pow[0][:n], _pow[1][:n]


class Prefix:
    """Prefix sums of byte * M**i: the hash of any substring in two look-ups."""

    def __init__(self, buf: np.ndarray, table: np.ndarray = BYTE):
        p, self.inv = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, U)
        np.cumsum(table[buf] * p[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start] + (end - start).astype(U))

    def fixed(self, width: int) -> np.ndarray:
        """Unmixed hashes of all substrings of ``width`` bytes."""
        return (self.sums[width:] - self.sums[:-width]) * self.inv[:len(self.sums) - width]


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words ``[^\\x20\\x09-\\x0D]+`` of every row."""
    if not len(buf):
        e = np.zeros(0, np.int64)
        return e, e, e
    gap = _SPACE[buf]
    begin = np.ones(len(buf), bool)
    begin[1:] = gap[:-1]
    begin[offs[:-1][offs[:-1] < len(buf)]] = True
    finish = np.ones(len(buf), bool)
    finish[:-1] = gap[1:]
    last = offs[1:] - 1
    finish[last[last >= 0]] = True
    solid = ~gap
    s, e = np.flatnonzero(begin & solid), np.flatnonzero(finish & solid) + 1
    return s, e, np.searchsorted(offs, s, "right") - 1


def word_hashes(buf: np.ndarray, offs: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word; A-Z count as a-z when ``lower``."""
    s, e, row = words(buf, offs)
    if not len(s):
        return np.zeros(0, U), row
    return Prefix(buf, BYTE_LOWER if lower else BYTE).of(s, e), row


_FACTORS = [int(x) | 1 for x in mix(np.arange(64, dtype=U), 11)]


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (rows are not looked at)."""
    out = np.zeros(max(0, len(h) - n + 1), U)
    for k in range(n):
        out += h[k:len(h) - n + 1 + k] * U(_FACTORS[k])
    return mix(out, n)


def shingles(buf: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct ``n``-word shingles of every row, sorted by row.

    A row with fewer words has its whole word sequence as its one
    shingle; a row without words has none.
    """
    h, row = word_hashes(buf, offs)
    rows = len(offs) - 1
    count = np.bincount(row, minlength=rows)
    g = grams(h, n)
    inside = row[:len(g)] == row[n - 1:] if len(g) else np.zeros(0, bool)
    hs, rs = [g[inside]], [row[:len(g)][inside]]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        first = np.concatenate([[0], np.cumsum(count)])[short]
        for k in range(1, n):
            pick = count[short] == k
            if pick.any():
                total = np.zeros(int(pick.sum()), U)
                for i in range(k):
                    total += h[first[pick] + i] * U(_FACTORS[i])
                hs.append(mix(total, 100 + k))
                rs.append(short[pick])
    h, row = np.concatenate(hs), np.concatenate(rs)
    # Sorted by row and upper hash bits; equal hashes become neighbours.
    bits = max(1, int(rows).bit_length())
    order = np.argsort((row.astype(U) << U(64 - bits)) | (h >> U(bits)))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


class Table:
    """Open-addressing table of 64-bit keys (not 0) with small numbers, looked up for whole arrays."""

    def __init__(self, bits: int):
        self.bits, self.keys, self.values, self.n = bits, np.zeros(1 << bits, U), np.zeros(1 << bits, np.int32), 0

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every key its slot or the empty one where its search ends, and whether it is there."""
        slot = (mix(keys, 3) >> U(64 - self.bits)).astype(np.int64)
        there = self.keys[slot] == keys
        open_ = np.flatnonzero(~there & (self.keys[slot] != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            k = self.keys[slot[open_]]
            there[open_] = k == keys[open_]
            open_ = open_[(k != 0) & (k != keys[open_])]
        return slot, there

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for those not there."""
        slot, there = self._slots(keys)
        return np.where(there, self.values[slot], -1)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there yet; beyond half its room the table starts afresh."""
        if self.n + len(keys) > len(self.keys) // 2:
            self.keys[:] = 0
            self.n = 0
        self.n += len(keys)
        while len(keys):
            slot, _ = self._slots(keys)
            _, first = np.unique(slot, return_index=True)
            self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]
