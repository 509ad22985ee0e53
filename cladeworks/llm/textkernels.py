"""NumPy kernels over whole batches of texts: words, XXH64 of substrings, SimHash bits."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
# The primes of the published XXH64 definition.
P1, P2, P3, P4, P5 = (U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


class Words:
    """The words of several texts over one buffer, in which one space stands before each word.

    ``start`` and ``end`` are byte positions in ``data``; words ``first[d]`` to ``first[d + 1]`` are
    those of text d. ``data`` ends with 8 bytes that belong to no word.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        space = is_space(raw)
        keep = ~space
        begins = np.flatnonzero(space[:-1] & keep[1:]) + 1
        keep[begins - 1] = True
        place = np.cumsum(keep, dtype=np.int64) - 1
        data = np.where(space, np.uint8(0x20), raw)[keep]
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        self.start = place[begins]
        self.end = place[np.flatnonzero(~space[:-1] & space[1:])] + 1
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        text_at = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1
        self.first = np.searchsorted(begins, text_at)


def turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U(bits)) | (x >> U(64 - bits))


def rounded(acc, lane):
    return turned(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of the substrings data[start:end]; data must go on for 8 bytes after the last."""
    n, s = len(data) - 8, U(seed)
    eight = np.ndarray((n + 1,), "<u8", data, strides=(1,))
    four = np.ndarray((n + 1,), "<u4", data, strides=(1,))
    with np.errstate(over="ignore"):
        size = end - start
        acc, at = s + P5 + size.astype(U), start.copy()
        if (long := np.flatnonzero(size >= 32)).size:
            p, lanes = start[long], [np.full(len(long), x) for x in (s + P1 + P2, s + P2, s, s - P1)]
            stripes = size[long] // 32
            live = np.arange(len(long))
            for k in range(int(stripes.max())):
                live = live[stripes[live] > k]
                for i in range(4):
                    lanes[i][live] = rounded(lanes[i][live], eight[p[live] + 32 * k + 8 * i])
            h = turned(lanes[0], 1) + turned(lanes[1], 7) + turned(lanes[2], 12) + turned(lanes[3], 18)
            for lane in lanes:
                h = (h ^ rounded(U(0), lane)) * P1 + P4
            acc[long] = h + size[long].astype(U)
            at[long] += 32 * stripes
        live = np.flatnonzero(end - at >= 8)
        while live.size:
            p = at[live]
            acc[live] = turned(acc[live] ^ rounded(U(0), eight[p]), 27) * P1 + P4
            at[live] = p + 8
            live = live[end[live] - p >= 16]
        live = np.flatnonzero(end - at >= 4)
        acc[live] = turned(acc[live] ^ (four[at[live]].astype(U) * P1), 23) * P2 + P3
        at[live] += 4
        live = np.flatnonzero(end > at)
        while live.size:
            p = at[live]
            acc[live] = turned(acc[live] ^ (data[p].astype(U) * P5), 11) * P1
            at[live] = p + 1
            live = live[end[live] > p + 1]
        acc ^= acc >> U(33)
        acc *= P2
        acc ^= acc >> U(29)
        acc *= P3
        acc ^= acc >> U(32)
    return acc


@lru_cache(maxsize=1)
def spread() -> tuple[np.ndarray, np.ndarray]:
    """For each byte, its low and its high four bits as 16-bit lanes of a word."""
    byte = np.arange(256, dtype=U)
    low = sum(((byte >> U(k)) & U(1)) << U(16 * k) for k in range(4))
    high = sum(((byte >> U(k + 4)) & U(1)) << U(16 * k) for k in range(4))
    return low, high


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each group first[g]:first[g + 1] of hashes, the bits set in over half of them (none: zero)."""
    counts = np.diff(first)
    out = np.zeros(len(counts), U)
    filled = np.flatnonzero(counts)
    if not filled.size:
        return out
    most = 60_000  # below what a 16-bit lane holds
    pieces = (counts[filled] + most - 1) // most
    group = np.repeat(np.arange(len(filled)), pieces)
    within = np.arange(len(group)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begins = first[filled][group] + within * most
    half, low_high = counts[filled].astype(np.int64), spread()
    for byte in range(8):
        value = ((hashes >> U(8 * byte)) & U(255)).astype(np.intp)
        for part, table in enumerate(low_high):
            sums = np.add.reduceat(table[value], begins)
            for lane in range(4):
                ones = np.bincount(group, ((sums >> U(16 * lane)) & U(0xFFFF)).astype(np.float64), len(filled)).astype(np.int64)
                out[filled] |= (2 * ones > half).astype(U) << U(8 * byte + 4 * part + lane)
    return out


def shingle_hashes(texts: list[bytes], width: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): word shingles of each text, A-Z lower-cased; fewer words: the whole sequence. Those of text d are first[d]:first[d + 1]."""
    words = Words(texts, lower=True)
    counts = np.diff(words.first)
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(shingles)])
    text_of = np.repeat(np.arange(len(counts)), shingles)
    head = words.first[:-1][text_of] + np.arange(len(text_of)) - first[:-1][text_of]
    tail = head + np.minimum(counts[text_of], width) - 1
    return xxh64(words.data, words.start[head], words.end[tail], seed), first


def fingerprints(texts: list[bytes], width: int = 3, seed: int = 42) -> np.ndarray:
    """SimHash of each text over its word shingles."""
    return majority_bits(*shingle_hashes(texts, width, seed))


def shingle_sets(texts: list[bytes], width: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, tokens, first): each text's distinct shingle hashes in order, and their sum, which stands for the set."""
    hashes, first = shingle_hashes(texts, width, seed)
    text_of = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((hashes, text_of))
    hashes, text_of = hashes[order], text_of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])
    tokens = hashes[new]
    first = np.concatenate([[0], np.cumsum(np.bincount(text_of[new], minlength=len(texts)))]).astype(np.int64)
    total = np.concatenate([np.zeros(1, U), np.cumsum(tokens, dtype=U)])
    return total[first[1:]] - total[first[:-1]], tokens, first
