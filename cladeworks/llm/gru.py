"""A bidirectional gated recurrent network over bytes, trained by backpropagation through time, in NumPy."""

from __future__ import annotations

import numpy as np

#: Sequences are words behind one space; longer ones are cut into windows of so many bytes.
WINDOW = 24


def sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.tanh(x * np.float32(0.5))
    out += 1
    out *= np.float32(0.5)
    return out


def windows(word: bytes, before: bytes = b" ") -> list[bytes]:
    word = before + word
    return [word[i : i + WINDOW] for i in range(0, len(word), WINDOW)]


def padded(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(length x n bytes, n lengths)."""
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    out = np.zeros((len(pieces), int(size.max())), np.uint8)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
    return out.T, size


def reverse(steps: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Turn each column's first ``size`` steps round."""
    t = np.arange(len(steps))[:, None]
    at = np.where(t < size, size - 1 - t, t)
    return np.take_along_axis(steps, at if steps.ndim == 2 else at[:, :, None], 0)


class Direction:
    """One reading direction: input rows by byte (update, reset, candidate), recurrent weights."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.wx = (rng.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
        self.u = (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)

    def forward(self, data: np.ndarray, keep: bool = False):
        hidden = len(self.u)
        h = np.zeros((data.shape[1], hidden), np.float32)
        out, tape = [], []
        for row in data:
            x, g = self.wx[row], h @ self.u
            zr = sigmoid(x[:, : 2 * hidden] + g[:, : 2 * hidden])
            z, r, gn = zr[:, :hidden], zr[:, hidden:], g[:, 2 * hidden :]
            n = np.tanh(x[:, 2 * hidden :] + r * gn)
            new = n + z * (h - n)
            if keep:
                tape.append((h, z, r, gn, n))
            h = new
            out.append(h)
        return np.stack(out), tape

    def backward(self, data: np.ndarray, tape: list, dout: np.ndarray) -> list[np.ndarray]:
        hidden = len(self.u)
        dwx, du, dh = np.zeros_like(self.wx), np.zeros_like(self.u), np.zeros_like(dout[0])
        grads = np.empty((len(data), data.shape[1], 3 * hidden), np.float32)
        for t in range(len(data) - 1, -1, -1):
            h, z, r, gn, n = tape[t]
            dh = dh + dout[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            grads[t] = np.concatenate([dz, dr, dn], 1)
            dg = np.concatenate([dz, dr, dn * r], 1)
            du += h.T @ dg
            dh = dh * z + dg @ self.u.T
        flat, rows = data.ravel(), grads.reshape(-1, 3 * hidden)
        order = np.argsort(flat, kind="stable")
        seen, begin = np.unique(flat[order], return_index=True)
        dwx[seen] = np.add.reduceat(rows[order], begin)
        return [dwx, du]


class ByteTagger:
    """Labels every byte position with class log-probabilities from both directions' states."""

    def __init__(self, classes: list[str], hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.ahead, self.back = Direction(hidden, rng), Direction(hidden, rng)
        self.v = (rng.standard_normal((2 * hidden, len(classes))) * 0.1).astype(np.float32)
        self.bias = np.zeros(len(classes), np.float32)

    def positions(self, pieces: list[bytes], keep: bool = False):
        """(length x n x classes log-probabilities, lengths, tape)."""
        data, size = padded(pieces)
        turned = reverse(data, size)
        a, tape_a = self.ahead.forward(data, keep)
        b, tape_b = self.back.forward(turned, keep)
        states = np.concatenate([a, reverse(b, size)], 2)
        logits = states @ self.v + self.bias
        logits -= logits.max(2, keepdims=True)
        logits -= np.log(np.exp(logits).sum(2, keepdims=True))
        return logits, size, (data, turned, tape_a, tape_b, states)

    def train(self, words: list[bytes], labels: list[int], epochs: int, batch: int, rate: float, seed: int = 7) -> None:
        """Adam on the mean cross-entropy of all positions."""
        pieces, target = [], []
        for word, label in zip(words, labels, strict=True):
            for piece in windows(word):
                pieces.append(piece)
                target.append(label)
        target = np.array(target)
        by_size = np.argsort([len(p) for p in pieces], kind="stable")
        parameters = [self.ahead.wx, self.ahead.u, self.back.wx, self.back.u, self.v, self.bias]
        first, second, step = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
        rng = np.random.default_rng(seed)
        groups = [by_size[i : i + 8 * batch] for i in range(0, len(by_size), 8 * batch)]
        total = epochs * sum(-(-len(g) // batch) for g in groups)
        for _ in range(epochs):
            parts = [part for g in groups for x in [rng.permutation(g)] for part in (x[i : i + batch] for i in range(0, len(x), batch))]
            for k in rng.permutation(len(parts)):
                rows = parts[k]
                logp, size, (data, turned, tape_a, tape_b, states) = self.positions([pieces[i] for i in rows], keep=True)
                mask = np.arange(len(data))[:, None] < size
                grad = np.exp(logp)
                grad[:, np.arange(len(rows)), target[rows]] -= 1
                grad *= (mask / mask.sum())[:, :, None].astype(np.float32)
                dstates = grad @ self.v.T
                hidden = dstates.shape[2] // 2
                flat = grad.reshape(-1, grad.shape[2])
                grads = [
                    *self.ahead.backward(data, tape_a, dstates[:, :, :hidden]),
                    *self.back.backward(turned, tape_b, reverse(dstates[:, :, hidden:], size)),
                    states.reshape(-1, states.shape[2]).T @ flat,
                    flat.sum(0),
                ]
                step += 1
                now = rate * (1 - 0.9 * step / total)
                for p, g, m, v in zip(parameters, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= (now / (1 - 0.9**step) * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def scores(self, pieces: list[bytes], together: int = 1024) -> np.ndarray:
        """For each piece, per class: the summed log-probabilities of its positions, their summed probabilities, and the positions labelled so; and the positions."""
        n = len(self.classes)
        out = np.zeros((len(pieces), 3 * n + 1), np.float32)
        order = np.argsort([len(p) for p in pieces], kind="stable")
        for i in range(0, len(order), together):
            rows = order[i : i + together]
            logp, size, _ = self.positions([pieces[k] for k in rows])
            mask = (np.arange(len(logp))[:, None] < size)[:, :, None]
            labelled = (logp.argmax(2)[:, :, None] == np.arange(n)) & mask
            out[rows] = np.concatenate([(logp * mask).sum(0), (np.exp(logp) * mask).sum(0), labelled.sum(0), size[:, None]], 1)
        return out

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """For each word as ``scores``, but with the mean log-probabilities of its positions."""
        cut = [windows(word) for word in words]
        found = self.scores([piece for pieces in cut for piece in pieces])
        sums, n = np.add.reduceat(found, np.cumsum([0, *map(len, cut[:-1])]), axis=0), len(self.classes)
        sums[:, :n] /= np.maximum(sums[:, -1:], 1)
        return sums
