"""NumPy kernels of substring deduplication: windows of words and the blocks that a minimizer cuts them into."""

from __future__ import annotations

import numpy as np

from cladeworks.llm.textkernels import U, Words, turned, xxh64

#: Words of the n-grams whose least hash in a window names the window's block.
GRAM = 5
MULTIPLIER = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(29))


def grown(hashes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hashes of ``width`` neighbours at every place where they fit, by doubling."""
    out, have, step = None, 0, hashes
    size = 1
    while width >> (size.bit_length() - 1):
        if width & size:
            if out is None:
                out, have = step, size
            else:  # what is there comes first, then ``size`` more
                n = min(len(out), len(step) - have)
                out = out[:n] * U(pow(MULTIPLIER, size, 1 << 64)) + step[have : have + n]
                have += size
        if size * 2 <= width:
            n = len(step) - size
            step = step[: max(n, 0)] * U(pow(MULTIPLIER, size, 1 << 64)) + step[size:] if n > 0 else step[:0]
        size *= 2
    return out


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """The leftmost place of the least value among ``width`` from every place where they fit."""
    place, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)  # the last step overlaps what is there
        if len(place) <= step:
            return place[:0]
        a, b = place[:-step], place[step:]
        place = np.where(values[a] <= values[b], a, b)
        size += step
    return place


class Windows:
    """All windows of ``width`` words of several texts: their hashes, and places by text."""

    def __init__(self, texts: list[bytes], width: int):
        if width < 1:
            raise ValueError("a window has one word at least")
        self.words, self.gram = Words(texts), min(GRAM, width)
        with np.errstate(over="ignore"):
            hashes = xxh64(self.words.data, self.words.start, self.words.end)
            self.hashes = mixed(grown(hashes, width)) if len(hashes) >= width else hashes[:0]
            self.grams = mixed(grown(hashes, self.gram)) if len(hashes) >= width else hashes[:0]
        self.first = self.words.first
        counts = np.maximum(np.diff(self.first) - width + 1, 0)
        self.text_of = np.repeat(np.arange(len(counts)), counts)
        begins = np.cumsum(counts) - counts
        self.places = self.first[:-1][self.text_of] + np.arange(len(self.text_of)) - begins[self.text_of]


def blocks(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor, content) of each maximal run of windows with one least n-gram.

    Equal windows have it at equal places, so they lie in blocks of one anchor, and blocks of one
    content hold equal windows.
    """
    w = Windows(texts, width)
    if not len(w.places):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    span = width - w.gram + 1
    least = least_places(w.grams, span)[w.places]
    new = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (w.text_of[1:] != w.text_of[:-1])]))
    last = np.concatenate([new[1:], [len(least)]]) - 1
    text, n = w.text_of[new], last - new + 1
    with np.errstate(over="ignore"):
        content = mixed(w.hashes[w.places[new]] * U(MULTIPLIER) + turned(w.hashes[w.places[last]], 17) + n.astype(U))
    return text, w.places[new] - w.first[text], n, w.grams[least[new]].view(np.int64), content.view(np.int64)


def phrases(spans: list[tuple[int, int, tuple, int]]) -> list[tuple[int, int, tuple, int]]:
    """Greedy parse: (start, end, reference, place there) of the fewest phrases that make up the spans (start, end, reference, place there).

    Spans of one reference that go on where another ends, there as here, are one stretch. From the first
    word that is covered, the stretch that reaches furthest is copied (ties: the reference met first), and so on from its end.
    """
    stretches, last = [], {}
    for start, end, ref, at in sorted(spans):
        k = last.get((ref, at - start))
        if k is not None and start <= stretches[k][1]:
            stretches[k][1] = max(stretches[k][1], end)
        else:
            last[ref, at - start] = len(stretches)
            stretches.append([start, end, ref, at])
    out, here, k, best = [], -1, 0, None
    while k < len(stretches) or best:
        while k < len(stretches) and (stretches[k][0] <= here or best is None):
            if best is None:
                here = max(here, stretches[k][0])
            if stretches[k][1] > here and (best is None or stretches[k][1] > best[1]):
                best = stretches[k]
            k += 1
        if best:
            out.append((here, best[1], best[2], best[3] + here - best[0]))
            here, best = best[1], None
    return out


def covered(n_words: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which words lie in one of the [start, end) spans."""
    edges = np.zeros(n_words + 1, np.int64)
    for start, end in spans:
        if start < n_words:
            edges[start] += 1
            edges[min(end, n_words)] -= 1
    return np.cumsum(edges[:-1]) > 0
