"""Counting estimates of dN and dS that allow for transition bias and codon frequencies (published in 2000), over a matrix of codon pairs."""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np

from cladeworks.functions.codons import BASES, CODONS, code_of

#: Bounds of the ratio of rates, and of its transition counterpart.
OMEGA, MOST_KAPPA = (1e-5, 99.0), 999.0


def is_transition(a: str, b: str) -> bool:
    return {a, b} in ({"T", "C"}, {"A", "G"})


@lru_cache(maxsize=4)
def tables(code: str) -> dict:
    """What depends on the genetic code alone: sense codons, single changes between them, and the paths between any two."""
    aa = code_of(code)
    sense = [c for c in CODONS if aa[c] != "*"]
    at = {c: k for k, c in enumerate(sense)}
    bases = np.array([[BASES.index(b) for b in c] for c in sense])
    single = [(at[a], at[b], k, is_transition(a[k], b[k]), aa[a] == aa[b]) for a in sense for k in range(3) for x in BASES if x != a[k] for b in [a[:k] + x + a[k + 1 :]] if b in at]
    same = lambda c, k: sum(aa[c[:k] + x + c[k + 1 :]] == aa[c] for x in BASES if x != c[k])
    free = np.array([[same(c, k) for k in range(3)] for c in sense])
    n = len(sense)
    # (pair, path, step) from, to and kind (0, 1: synonymous transition, transversion; 2, 3: the same, nonsynonymous; 4: no step)
    steps, kinds, open_paths = np.zeros((n * n, 6, 3, 2), np.int64), np.full((n * n, 6, 3), 4), np.zeros((n * n, 6), bool)
    for x, a in enumerate(sense):
        for y, b in enumerate(sense):
            differ = [k for k in range(3) if a[k] != b[k]]
            for p, order in enumerate(permutations(differ)):
                here, found = a, []
                for k in order:
                    there = here[:k] + b[k] + here[k + 1 :]
                    if there not in at:
                        break
                    found.append((at[here], at[there], 2 * (aa[here] != aa[there]) + (not is_transition(a[k], b[k]))))
                    here = there
                if len(found) == len(differ):
                    open_paths[x * n + y, p] = True
                    for s, (u, v, kind) in enumerate(found):
                        steps[x * n + y, p, s], kinds[x * n + y, p, s] = (u, v), kind
    return {"sense": sense, "at": at, "bases": bases, "single": np.array(single), "free": free, "aa": np.array([aa[c] for c in sense]), "steps": steps, "kinds": kinds, "open": open_paths, "differ": np.array([[sum(p != q for p, q in zip(a, b, strict=True)) for b in sense] for a in sense]).ravel()}


def f84(n: float, p: float, q: float, freqs: np.ndarray) -> tuple[float, float]:
    """(kappa, distance) from the shares of transitions and transversions; simpler models stand in where one fails (kappa -1 if none gives it)."""
    y, r = freqs[0] + freqs[1], freqs[2] + freqs[3]
    tc, ag = freqs[0] * freqs[1], freqs[2] * freqs[3]
    if p + q > 1:
        return 1.0, 99.0
    if q >= min(1e-10, 0.1 / n):
        if y > 0 and r > 0 and tc + ag > 0:
            v = 1 - q / (2 * y * r)
            u = (2 * (tc + ag) + 2 * (tc * r / y + ag * y / r) * v - p) / (2 * (tc / y + ag / r))
            if u > 0 and 0 < v < 1:
                a, b = -0.5 * np.log(u), -0.5 * np.log(v)
                k = a / b - 1
                return min(1 + (tc / y + ag / r) / (tc + ag) * k, MOST_KAPPA), 4 * b * (tc * (1 + k / y) + ag * (1 + k / r) + y * r)
        if 1 - 2 * p - q > 0 and 1 - 2 * q > 0:
            a, b = -np.log(1 - 2 * p - q), -np.log(1 - 2 * q)
            return min((0.5 * a - 0.25 * b) / (0.25 * b), MOST_KAPPA), 0.5 * a + 0.25 * b
    share = p + q if p + q < 0.75 else 0.75 * (n - 1) / n
    return -1.0, min(-0.75 * np.log(1 - share * 4 / 3), 99.0)


def pair_kappa(counts: np.ndarray, code: str, default: float = 2.0) -> float:
    """Kappa of one pair (counts of codon x against y): from sites free in neither codon and from fourfold sites, weighted by their numbers."""
    t = tables(code)
    both = (counts + counts.T) / 2
    classes = [np.zeros((4, 4)), np.zeros((4, 4))]
    x, y = np.nonzero(both)
    for k in range(3):
        bound = (t["free"][x, k] == 0) & (t["free"][y, k] == 0)
        np.add.at(classes[0], (t["bases"][x[bound], k], t["bases"][y[bound], k]), both[x[bound], y[bound]])
    open_ = (t["free"][x, 2] == 3) & (t["free"][y, 2] == 3) & (t["aa"][x] == t["aa"][y])
    np.add.at(classes[1], (t["bases"][x[open_], 2], t["bases"][y[open_], 2]), both[x[open_], y[open_]])
    found = []
    for table in classes:
        n = table.sum()
        if n > 0:
            share = table / n
            p = 2 * (share[0, 1] + share[2, 3])
            kappa, _ = f84(n, p, max(1 - np.trace(share) - p, 0.0), share.sum(1))
            if kappa > 0:
                found.append((kappa, n))
    return sum(k * n for k, n in found) / sum(n for _, n in found) if found else default


def f3x4_of(counts: np.ndarray, code: str) -> np.ndarray:
    """Codon frequencies from the base frequencies of both sequences at each position."""
    t, own = tables(code), counts.sum(0) + counts.sum(1)
    at = np.stack([np.bincount(t["bases"][:, k], own, 4) for k in range(3)])
    at /= at.sum(1, keepdims=True)
    product = at[0][t["bases"][:, 0]] * at[1][t["bases"][:, 1]] * at[2][t["bases"][:, 2]]
    return product / product.sum()


def estimate(counts: np.ndarray, kappa: float, code: str, weighted: bool, rounds: int = 10, accuracy: float = 5e-4) -> dict[str, float]:
    """S, N, dS, dN, omega and t of one pair; ``weighted`` gives paths between codons their probabilities, in rounds."""
    t, freqs = tables(code), f3x4_of(counts, code)
    n_codons, size = counts.sum(), len(freqs)
    x, y, k, transition, synonymous = t["single"].T
    rate = freqs[y] * np.where(transition, kappa, 1.0)
    sites, sums = np.zeros(2), np.zeros((2, 4))
    for own in (counts.sum(1), counts.sum(0)):
        for kind, chosen in enumerate((synonymous == 1, synonymous == 0)):
            by_base = np.bincount(t["bases"][x[chosen], k[chosen]], (own[x] * rate)[chosen], 4)
            sums[kind] += by_base / max(by_base.sum(), 1e-300) / 2
        total = np.array([(own[x] * rate)[synonymous == 1].sum(), (own[x] * rate)[synonymous == 0].sum()])
        sites += total * 3 * n_codons / total.sum() / 2

    pairs = np.flatnonzero((counts.ravel() > 0) & (t["differ"] > 0))
    weight = counts.ravel()[pairs]
    omega, time, before = 1.0, 0.5, np.zeros(3)
    for _ in range(rounds if weighted else 1):
        if weighted:
            q = np.zeros((size, size))
            q[x, y] = rate * np.where(synonymous == 1, 1.0, omega)
            q[np.arange(size), np.arange(size)] = -q.sum(1)
            q /= -(freqs * np.diag(q)).sum()
            root = np.sqrt(np.maximum(freqs, 1e-300))
            values, u = np.linalg.eigh((q * root[:, None] / root + (q * root[:, None] / root).T) / 2)
            p = np.abs((u * np.exp(values * time)) @ u.T * root / root[:, None])
        else:
            p = np.ones((size, size))
        each = np.where(t["kinds"][pairs] == 4, 1.0, p[t["steps"][pairs][..., 0], t["steps"][pairs][..., 1]]).prod(2) * t["open"][pairs]
        each /= np.maximum(each.sum(1, keepdims=True), 1e-300)
        differences = np.array([((t["kinds"][pairs] == kind).sum(2) * each).sum(1) @ weight for kind in range(4)])
        for far, closed in ((2, np.array([0, 0, 0.5, 1.5])), (3, np.array([0, 0, 0.5, 2.5]))):  # every path passes a stop
            differences += closed * weight[(t["differ"][pairs] == far) & ~t["open"][pairs].any(1)].sum()
        _, ds = f84(sites[0], differences[0] / sites[0], differences[1] / sites[0], sums[0])
        _, dn = f84(sites[1], differences[2] / sites[1], differences[3] / sites[1], sums[1])
        omega = OMEGA[1] if ds < 1e-9 else max(OMEGA[0], dn / ds)
        time = (ds * sites[0] + dn * sites[1]) * 3 / sites.sum()
        now = np.array([ds, dn, omega])
        if (np.abs(now - before) < accuracy).all():
            break
        before = now
    return {"s": sites[0], "n": sites[1], "ds": ds, "dn": dn, "omega": omega, "t": time}
