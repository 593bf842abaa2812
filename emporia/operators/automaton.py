"""Multi-pattern search: one automaton for a whole word list.

A trie of the listed words with failure links, written out as a dense
table over the bytes that occur in the list: the next state is one look-up
per byte of text, whatever the number of words. Texts are read from the
Arrow buffers without decoding. They are cut into stretches that overlap
by the longest word, and all stretches of a step advance together, one
byte at a time, so the work grows with the text alone.
"""

from __future__ import annotations

from collections import deque

import numpy as np

STRETCH = 512


class Automaton:
    """Finds which of ``words`` (UTF-8, not empty, distinct) occur in texts; words are named by their place in the list."""

    def __init__(self, words: list[bytes]):
        self.classes = np.zeros(256, np.uint8)  # 0: bytes of no word
        used = sorted(set(b"".join(words)))
        self.classes[used] = np.arange(1, len(used) + 1)  # UTF-8 uses fewer than 256 bytes
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for n, word in enumerate(words):
            state = 0
            for c in self.classes[np.frombuffer(word, np.uint8)].tolist():
                if c not in children[state]:
                    children[state][c] = len(children)
                    children.append({})
                state = children[state][c]
            ends[state] = n
        self.longest = max(map(len, words), default=1)
        self.table = np.zeros((len(children), len(used) + 1), np.int32)
        found: list[tuple[int, ...]] = [()] * len(children)
        queue = deque((s, c, 0) for c, s in children[0].items())
        self.table[0, list(children[0])] = list(children[0].values())
        while queue:  # by depth: a state's failure link is shallower, so its row is complete
            state, c, fail = queue.popleft()
            self.table[state] = self.table[fail]
            found[state] = ((ends[state],) if state in ends else ()) + found[fail]
            for c, child in children[state].items():
                queue.append((child, c, int(self.table[fail, c])))
                self.table[state, c] = child
        self.found_ends = np.cumsum([len(x) for x in found])
        self.found = np.array([n for x in found for n in x], np.int64)
        self.count = np.array([len(x) for x in found])

    def rows(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, word) pairs, distinct and sorted, of the texts ``buf[offs[k]:offs[k + 1]]``."""
        back, own = self.longest - 1, max(STRETCH, 4 * self.longest)
        pieces = -(-np.diff(offs) // own)
        row = np.repeat(np.arange(len(pieces)), pieces)
        start = offs[row] + (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * own
        end = np.minimum(start + own, offs[row + 1])
        start = np.maximum(start - back, offs[row])
        order = np.argsort(start - end, kind="stable")  # longest first: those still open are a prefix
        row, start, left = row[order], start[order], (end - start)[order]
        state = np.zeros(len(row), np.int32)
        symbols = self.classes[buf]
        hits, shorter = [], start[:0] if not len(left) else -left
        for t in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(shorter, -t))  # stretches with more than t bytes
            state = self.table[state[:n], symbols[start[:n] + t]]
            hit = np.flatnonzero(self.count[state])
            if len(hit):
                hits.append(np.unique(row[hit] * len(self.count) + state[hit]))
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = np.unique(np.concatenate(hits))
        row, state = seen // len(self.count), seen % len(self.count)
        many = self.count[state]
        at = np.arange(int(many.sum())) + np.repeat(self.found_ends[state] - np.cumsum(many), many)
        words = len(self.found) + 1
        pairs = np.unique(np.repeat(row, many) * words + self.found[at])
        return pairs // words, pairs % words
