"""Substitution probabilities and partial likelihoods of blocks of patterns, in NumPy."""

from __future__ import annotations

from math import exp, lgamma, log

import numpy as np

from cladeworks.sources.newick import Node

BASES = "TCAG"
AMBIGUOUS = {**{b: b for b in BASES}, "-": BASES, "?": BASES, "N": BASES, "Y": "TC", "R": "AG", "M": "CA", "K": "TG", "W": "TA", "S": "CG"}
TIPS = {c: np.array([float(b in s) for b in BASES]) for c, s in AMBIGUOUS.items()}


def rate_matrix(kappa: float, freqs: np.ndarray) -> np.ndarray:
    """Transitions kappa times as fast; scaled to one change a unit of time."""
    q = np.tile(freqs, (4, 1)).astype(float)
    for i, j in ((0, 1), (1, 0), (2, 3), (3, 2)):
        q[i, j] *= kappa
    np.fill_diagonal(q, 0)
    np.fill_diagonal(q, -q.sum(1))
    return q / -(freqs @ np.diag(q))


#: Free parameters of each model of exchange between bases, and whether base frequencies are those of the data.
MODELS = {"JC69": (0, False), "K80": (1, False), "F81": (0, True), "HKY85": (1, True), "TN93": (2, True), "REV": (5, True)}
PAIRS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))


def exchange_matrix(name: str, parameters: np.ndarray, freqs: np.ndarray) -> np.ndarray:
    """Rates between bases, scaled to one change a unit of time: transitions T-C and A-G have parameters, or (REV) all pairs but A-G."""
    rates = np.ones(6)
    if name == "REV":
        rates[:5] = parameters
    elif len(parameters):
        rates[0], rates[5] = parameters[0], parameters[-1]
    q = np.zeros((4, 4))
    for (i, j), r in zip(PAIRS, rates, strict=True):
        q[i, j], q[j, i] = r * freqs[j], r * freqs[i]
    np.fill_diagonal(q, -q.sum(1))
    return q / -(freqs @ np.diag(q))


class Model:
    """Transition probabilities of a reversible process: kappa alone, or a rate matrix."""

    def __init__(self, kappa: float, freqs: np.ndarray, rates: np.ndarray | None = None):
        self.freqs = freqs
        root = np.sqrt(freqs)
        q = rate_matrix(kappa, freqs) if rates is None else rates
        self.values, u = np.linalg.eigh(q * root[:, None] / root)
        self.left, self.right = u / root[:, None], (u * root[:, None]).T

    def p(self, t: float) -> np.ndarray:
        return np.eye(len(self.freqs)) + (self.left * np.expm1(self.values * t)) @ self.right


def gamma_cdf(x: float, a: float) -> float:
    """The incomplete gamma ratio, by series or continued fraction."""
    if x <= 0:
        return 0.0
    front = exp(a * log(x) - x - lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > total * 1e-15:
            k += 1
            term *= x / k
            total += term
        return front * total
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return 1 - front * h


def discrete_gamma(alpha: float, classes: int) -> np.ndarray:
    """Mean rates of equally likely classes of a gamma distribution with mean 1."""
    cuts = []
    for k in range(1, classes):
        low, high = 0.0, 1.0
        while gamma_cdf(high * alpha, alpha) < k / classes:
            high *= 2
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if gamma_cdf(mid * alpha, alpha) < k / classes else (low, mid)
        cuts.append((low + high) / 2)
    share = np.array([0.0, *[gamma_cdf(c * alpha, alpha + 1) for c in cuts], 1.0])
    return np.diff(share) * classes


def tip_partials(patterns: list[str], taxon: int) -> np.ndarray:
    return np.stack([TIPS.get(p[taxon], TIPS["?"]) for p in patterns])


def pruned(nodes: list[Node], tips: dict[int, np.ndarray], model: Model, lengths: np.ndarray) -> dict[int, np.ndarray]:
    """Partial likelihoods (patterns x 4) of every node, sons before fathers."""
    out = dict(tips)
    for n in reversed(nodes):
        if n.sons:
            out[n.node_id] = np.prod([out[s] @ model.p(lengths[s]).T for s in n.sons], axis=0)
    return out


def tips_of(nodes: list[Node], patterns: list[str]) -> dict[int, np.ndarray]:
    return {n.node_id: tip_partials(patterns, int(n.name) - 1) for n in nodes if not n.sons}


def pattern_lnl(nodes: list[Node], tips: dict[int, np.ndarray], model: Model, lengths: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """ln of each pattern's probability, over equally likely rate classes."""
    parts = [pruned(nodes, tips, model, lengths * r)[0] @ model.freqs for r in rates]
    return np.log(np.maximum(np.mean(parts, axis=0), 1e-300))
