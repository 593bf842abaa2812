"""Operator 4: byte-level BPE as a streaming transducer, and its decoder.

Encoding reads bytes from left to right. For every prefix of a
pre-token there is exactly one token that can end it: the one that does
not get merged differently with the token before it (``Merges.stays``).
A later token starts at one of the last ``lookahead`` positions, the
length of the longest token, so a border on the path of all of these
is final: tokens before it are emitted and their bytes forgotten. Memory
is constant in the length of the text. Pre-tokens that come again are
looked up in a bounded memory. Decoding maps ids to bytes and feeds an
incremental UTF-8 machine piece by piece.

Null text counts as empty: no ids, empty decoded text. Rows are treated
one by one: repeated ids or rows give repeated results, extra columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emporia.llm.common import SMALL_STEP, ragged, steps, text_column
from emporia.llm.hashing import U, Prefix, Table
from emporia.llm.simple8b import Memo, Rows

# The split pattern of this tokenizer family.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """Letter -> byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in same}
    for b in range(256):
        if b not in same:
            out[chr(0x100 + len(out) - len(same))] = b
    return out


class Merges:
    """Tables of one merge list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for s, i in vocab.items():
            self.bytes[i] = s.encode() if s in self.special else as_bytes(s)
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            pair = (vocab[a], vocab[b])
            self.rank.setdefault(pair, r)
            self.made.setdefault(vocab[a + b], (r, *pair))
        self._stays: dict[tuple[int, int], bool] = {}
        # Tokens that their own bytes never become are out of reach.
        self.ids: dict[bytes, int] = {}
        for s, i in vocab.items():
            if s not in self.special and (i not in self.made or self._whole(*self.made[i])):
                self.ids[self.bytes[i]] = i
        self.lookahead = max(map(len, self.ids))

    def _outer(self, t: int, side: int) -> list[tuple[int, int]]:
        """The outermost tokens of a token's merge tree at the left (1) or right (2), each with the rank at which it is merged away."""
        out, until = [], len(self.rank) + 1
        while True:
            out.append((t, until))
            if t not in self.made:
                return out
            until, t = self.made[t][0], self.made[t][side]

    def _crossed(self, a: int, b: int, below: int) -> bool:
        """Whether a merge of rank under ``below`` joins the end of ``a`` to the start of ``b`` before they are whole.

        Equal merges go from left to right: one inside ``a`` comes
        first, one inside ``b`` comes too late.
        """
        left = self._outer(b, 1)
        for x, x_until in self._outer(a, 2):
            for y, y_until in left:
                r = self.rank.get((x, y))
                if r is not None and r < below and r < x_until and r <= y_until:
                    return True
        return False

    def _whole(self, rank: int, a: int, b: int) -> bool:
        return not self._crossed(a, b, rank)

    def stays(self, a: int, b: int) -> bool:
        """Whether tokens ``a``, ``b`` side by side are what their joined bytes become."""
        known = self._stays.get((a, b))
        if known is None:
            if len(self._stays) > 200_000:
                self._stays.clear()
            known = self._stays[a, b] = not self._crossed(a, b, len(self.rank) + 1)
        return known


class Lockstep:
    """The transducer over many short pre-tokens at once: all advance by one byte per round."""

    MOST = 32  # bytes of a pre-token

    def __init__(self, merges: Merges):
        self.m = merges
        tokens = [(b, i) for b, i in merges.ids.items() if len(b) <= self.MOST]
        flat = np.frombuffer(b"".join(b for b, _ in tokens), np.uint8)
        ends = np.cumsum([len(b) for b, _ in tokens])
        starts = np.concatenate([[0], ends[:-1]])
        self.ids, self.pairs = Table(18), Table(20)
        self.ids.add(Prefix(flat).of(starts, ends), np.array([i for _, i in tokens]))
        self.length = np.fromiter(map(len, merges.bytes), np.int64, len(merges.bytes))

    def stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a.astype(U) << U(32)) + b.astype(U) + U(1)
        out = self.pairs.find(keys)
        if (out < 0).any():
            new = np.unique(keys[out < 0])
            left, right = (new - U(1)) >> U(32), (new - U(1)) & U(0xFFFFFFFF)
            self.pairs.add(new, np.fromiter((self.m.stays(x, y) for x, y in zip(left.tolist(), right.tolist())),
                                            np.int32, len(new)))
            out = self.pairs.find(keys)
        return out == 1

    def encode(self, pretokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all pre-tokens one after the other, end of each)."""
        n = len(pretokens)
        lens = np.fromiter(map(len, pretokens), np.int64, n)
        flat = np.frombuffer(b"".join(pretokens), np.uint8)
        order = np.argsort(-lens, kind="stable")  # those still running come first
        size, start = lens[order], (np.cumsum(lens) - lens)[order]
        longest = int(size[0])
        prefix = Prefix(flat)
        last = np.full((n, longest + 1), -1, np.int32)
        for i in range(1, longest + 1):
            todo = np.arange(np.searchsorted(-size, -i, "right"))
            for j in range(i - 1, -1, -1):
                token = self.ids.find(prefix.of(start[todo] + j, start[todo] + i))
                hit = np.flatnonzero(token >= 0)
                if j:
                    hit = hit[self.stay(last[todo[hit], j], token[hit])]
                last[todo[hit], i] = token[hit]
                todo = np.delete(todo, hit)
                if not len(todo):
                    break
            if len(todo):
                raise ValueError("a byte is not in the vocabulary")
        # Back along the borders, all pre-tokens together; then each one's tokens in reading order.
        at, row, rows, tokens = size.copy(), np.arange(n), [], []
        while len(row):
            token = last[row, at]
            rows.append(row)
            tokens.append(token)
            at = at - self.length[token]
            row, at = row[at > 0], at[at > 0]
        row, token = np.concatenate(rows), np.concatenate(tokens)
        back = np.argsort(order[row[::-1]], kind="stable")
        return token[::-1][back].astype(np.uint32), np.cumsum(np.bincount(order[row], minlength=n))


class Transducer:
    """Bytes of one pre-token in, tokens out as soon as they are final."""

    def __init__(self, merges: Merges):
        self.m, self.tail, self.last, self.before = merges, b"", [], -1

    def feed(self, data: bytes) -> list[int]:
        """Take the next bytes; the tokens that no later byte can change."""
        m, out, step = self.m, [], 4 * self.m.lookahead
        for k in range(0, len(data), step):
            self._scan(data[k:k + step])
            if len(self.last) >= step:
                out += self._emit()
        return out

    def _scan(self, data: bytes) -> None:
        m, last, get, stays = self.m, self.last, self.m.ids.get, self.m.stays
        b = self.tail = self.tail + data
        for i in range(len(last) + 1, len(b) + 1):
            for j in range(max(0, i - m.lookahead), i):
                t = get(b[j:i])
                if t is not None:
                    p = last[j - 1] if j else self.before
                    if p < 0 or stays(p, t):
                        last.append(t)
                        break
            else:
                raise ValueError("a byte is not in the vocabulary")

    def _emit(self) -> list[int]:
        """Tokens up to the last border on the path of every position that a later token can start at."""
        m, last = self.m, self.last
        n = len(last)
        live = set(range(max(0, n - m.lookahead), n + 1))
        while len(live) > 1:
            i = max(live)
            live.discard(i)
            live.add(i - len(m.bytes[last[i - 1]]))
        border = live.pop()
        out = self._path(border)
        if out:
            self.before = out[-1]
            self.tail, self.last = self.tail[border:], last[border:]
        return out

    def _path(self, i: int) -> list[int]:
        out = []
        while i:
            out.append(self.last[i - 1])
            i -= len(self.m.bytes[out[-1]])
        return out[::-1]

    def finish(self) -> list[int]:
        """The remaining tokens; ready for the next pre-token."""
        out = self._path(len(self.last))
        self.tail, self.last, self.before = b"", [], -1
        return out


class Decoder:
    """Ids to text; characters whose bytes are not complete wait for the next ids."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.machine.decode(b"".join(self.m.bytes[i] for i in ids))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


class TextEncoder:
    """Whole texts through the transducer; pieces between blanks are remembered up to a bound."""

    MOST = 120_000
    LONG = 1000  # letters of a piece

    def __init__(self, path: str):
        import regex

        self.m = Merges(path)
        self.split = regex.compile(PRETOKEN).findall
        self.special = re.compile("|".join(map(re.escape, sorted(self.m.special, key=len, reverse=True))) or r"(?!)")
        # Blanks and line ends with nothing blank beside them: only there the text may be cut without the pattern.
        self.odd = re.compile(r"[ \n]\s|[^\S \n]|\x00").search
        self.flow, self.many = Transducer(self.m), Lockstep(self.m)
        lens = np.fromiter(map(len, self.m.bytes), np.int64, len(self.m.bytes))
        self.byte_flat, self.byte_len = np.frombuffer(b"".join(self.m.bytes), np.uint8), lens
        self.byte_start = np.cumsum(lens) - lens
        self._fresh()

    def _fresh(self) -> None:
        self.memo, self.rows = Memo(), Rows()         # pieces
        self.tokens, self.token_rows = Memo(), Rows()  # pre-tokens

    def _learn(self) -> None:
        """Tokens of the new pieces, by their pre-tokens."""
        pre, count = [], []
        for piece in self.memo.new:
            p = [piece] if piece in self.m.special else self.split(piece)
            pre += p
            count.append(len(p))
        self.memo.new.clear()
        numbers = np.fromiter(map(self.tokens.__getitem__, pre), np.int64, len(pre))
        if self.tokens.new:
            new, self.tokens.new = [p.encode() for p in self.tokens.new], []
            special = {k.encode(): v for k, v in self.m.special.items()}
            short = np.fromiter((len(p) <= Lockstep.MOST and p not in special for p in new), bool, len(new))
            found, place = Rows(), np.empty(len(new), np.int64)
            if short.any():
                found.append(*self.many.encode([p for p, s in zip(new, short.tolist()) if s]))
            found.add([[special[p]] if p in special else self.flow.feed(p) + self.flow.finish()
                       for p, s in zip(new, short.tolist()) if not s])
            place[short] = np.arange(int(short.sum()))
            place[~short] = int(short.sum()) + np.arange(int((~short).sum()))
            ids, lens = found.take(place)
            self.token_rows.append(ids, np.cumsum(lens))
        ids, lens = self.token_rows.take(numbers)
        self.rows.append(ids, np.concatenate([[0], np.cumsum(lens)])[np.cumsum(count)])

    def _pieces(self, text: str) -> list[str]:
        """Pieces whose tokens do not depend on each other; the joined pieces are the text."""
        if self.odd(text):
            return self.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number per text)."""
        if len(self.memo) + len(self.tokens) > self.MOST or self.rows.used > 8 * self.MOST:
            self._fresh()
        pieces: list[str] = []
        count = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            at = len(pieces)
            if self.special.search(t):
                k = 0
                for s in self.special.finditer(t):
                    pieces += self._pieces(t[k:s.start()])
                    pieces.append(s.group())
                    k = s.end()
                pieces += self._pieces(t[k:])
            else:
                pieces += self._pieces(t)
            count[i] = len(pieces) - at
        numbers = np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))
        if self.memo.new:
            long = max(map(len, self.memo.new)) > self.LONG
            self._learn()
            if long:  # whole lines or files without a blank are not worth keeping
                ids, lens = self.rows.take(numbers)
                self._fresh()
                return ids, _per_text(lens, count)
        ids, lens = self.rows.take(numbers)
        return ids, _per_text(lens, count)

    def bytes_of(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the ids, end of every text in them)."""
        lens = self.byte_len[ids]
        total = np.concatenate([[0], np.cumsum(lens)])
        return self.byte_flat[ragged(self.byte_start[ids], lens)], total[ends]


def _per_text(lens: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(lens)])[np.cumsum(count)], prepend=0)


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def decode_text(raw: memoryview, piece: int = 1 << 16) -> Iterator[str]:
    """Text of token bytes, a bounded piece at a time."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for k in range(0, len(raw), piece):
        yield machine.decode(raw[k:k + piece])
    yield machine.decode(b"", True)


def encode_decode(docs: DataFrame, tokenizer: str, outputs: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``outputs`` also ids (binary) and decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = text_encoder(tokenizer)
        for batch in batches:
            texts = text_column(batch)
            for i, j, _, _ in steps(batch, most=SMALL_STEP):
                ids, lens = enc.encode(texts.slice(i, j - i).to_pylist())
                ends = np.cumsum(lens)
                raw, byte_ends = enc.bytes_of(ids.astype(np.int64), ends)
                id_bytes = memoryview(ids.astype("<u4").tobytes())
                raw = memoryview(raw.tobytes())
                own = [id_bytes[4 * a:4 * b] for a, b in zip((ends - lens).tolist(), ends.tolist())]
                shas, decoded = [], []
                for a, b in zip([0, *byte_ends[:-1].tolist()], byte_ends.tolist()):
                    sha, kept = hashlib.sha256(), []
                    for s in decode_text(raw[a:b]):
                        sha.update(s.encode())
                        if outputs:
                            kept.append(s)
                    shas.append(sha.hexdigest())
                    decoded.append("".join(kept))
                cols = [batch.column("doc_id").slice(i, j - i), pa.array(lens),
                        pa.array([hashlib.sha256(x).hexdigest() for x in own], pa.string()), pa.array(shas, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if outputs:
                    cols += [pa.array([bytes(x) for x in own], pa.binary()), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids binary, decoded string" if outputs else ""))
