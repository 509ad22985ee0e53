"""Byte-pair merging of single pieces with a heap and a linked list, and the text splitting around it.

Runs inside tasks; the vocabulary file is a parameter and is read once per worker process.
"""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import regex

# Fixed value: the published splitting pattern of byte-level BPE.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries a worker's memo may hold; a full memo is emptied, so memory stays bounded.
MEMO_ENTRIES = 1_200_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + k)
    return [table[b] for b in range(256)]


class PairMerger:
    """Counts the tokens of a piece: initial byte symbols minus the merges made."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.byte_ids = [vocab[c] for c in byte_alphabet()]
        self.left, self.right, self.merged, self.rank = [], [], [], {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.left.append(vocab[a])
            self.right.append(vocab[b])
            self.merged.append(vocab[a + b])
            self.rank.setdefault(vocab[a] << 20 | vocab[b], rank)

    def count(self, piece: bytes) -> int:
        n = len(piece)
        if n < 2:
            return n
        rank = self.rank.get
        byte_ids = self.byte_ids
        symbols = [byte_ids[b] for b in piece]
        heap = [r << 32 | i for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank(a << 20 | b)) is not None]
        if not heap:
            return n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(heap)
        left, right, merged = self.left, self.right, self.merged
        merges = 0
        while heap:
            key = heappop(heap)
            r, i = key >> 32, key & 0xFFFFFFFF
            j = after[i]
            if j >= n or symbols[i] != left[r] or symbols[j] != right[r]:
                continue  # one of the two was merged away since
            symbols[i] = new = merged[r]
            symbols[j] = -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (s := rank(new << 20 | symbols[k])) is not None:
                    heappush(heap, s << 32 | i)
            h = before[i]
            if h >= 0 and (s := rank(symbols[h] << 20 | new)) is not None:
                heappush(heap, s << 32 | h)
        return n - merges


class Memo(dict):
    """A bounded memo in two generations: a full one becomes the old one, whose entries come back when used."""

    def __init__(self, make, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.make, self.most, self.old = make, entries // 2, {}

    def put(self, key: str, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key: str):
        value = self.old.get(key, self)
        if value is self:
            value = self.make(key)
        self.put(key, value)
        return value


def irregular(chunk: str) -> bool:
    """Whether a chunk between single spaces can't be split alone.

    A space before a non-space always begins a piece, so other chunks can, with their space in front.
    """
    return not chunk or chunk[0].isspace() or chunk[-1].isspace()


class TokenCounter:
    def __init__(self, path: str):
        self.merger = PairMerger(path)
        self.find = regex.compile(SPLIT_PATTERN).findall
        self.pieces = Memo(lambda piece: self.merger.count(piece.encode("utf-8")))
        self.memo = Memo(self.chunk)

    def chunk(self, chunk: str) -> int | None:
        if irregular(chunk):
            return None
        if chunk.isalpha():  # one piece
            return self.pieces[" " + chunk] if len(chunk) < 64 else self.whole(" " + chunk)
        if chunk[-1] in ".," and chunk[:-1].isalpha() and len(chunk) < 64:
            return self.pieces[" " + chunk[:-1]] + 1
        return self.whole(" " + chunk)

    def whole(self, text: str) -> int:
        pieces, count = self.pieces, self.merger.count
        return sum(pieces[p] if len(p) < 64 else count(p.encode("utf-8")) for p in self.find(text))

    def plain(self, text: str) -> int:
        first, *rest = text.split(" ")
        if not rest:
            return self.whole(text)
        if not first or first[-1].isspace():
            return self.whole(text)
        try:
            return self.whole(first) + sum(map(self.memo.__getitem__, rest))
        except TypeError:  # a chunk with white space at an end
            return self.whole(text)

    def count(self, text: str) -> int:
        """Tokens of ``text``; the strings of added tokens count as one each, as the library's default has it."""
        for special in self.merger.specials:
            if special in text:
                parts = text.split(special)
                return len(parts) - 1 + sum(self.count(p) for p in parts)
        return self.plain(text)


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)
