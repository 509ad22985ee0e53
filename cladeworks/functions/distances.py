"""Closed-form distances as Columns over the sixteen proportions of a pair of sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INAPPLICABLE = 9.0
MOST_KAPPA = 999.0


class PairTerms:
    """Columns n_XY (pairs of states X in the first and Y in the second sequence) as the formulas' terms."""

    def __init__(self, alpha: float | None = None):
        count = lambda x, y: F.col(f"n_{x}{y}")
        self.n = sum((count(x, y) for x in "TCAG" for y in "TCAG"), F.lit(0))
        part = lambda x, y: count(x, y) / self.n
        self.p = {x: sum((part(x, y) + part(y, x) for y in "TCAG"), F.lit(0.0)) / 2 for x in "TCAG"}
        self.differ = F.lit(1.0) - sum((part(x, x) for x in "TCAG"), F.lit(0.0))
        self.p1, self.p2 = part("T", "C") + part("C", "T"), part("A", "G") + part("G", "A")
        self.q = self.differ - self.p1 - self.p2
        self.alpha = alpha

    def log(self, u: Column) -> Column:
        """-ln u, or its mean over gamma rates; null where u is not positive."""
        grown = -F.log(u) if self.alpha is None else -F.lit(self.alpha) * (1 - F.pow(u, F.lit(-1 / self.alpha)))
        return F.when(u > 0, grown)

    def finish(self, d: Column, legacy: bool) -> Column:
        out = F.when(self.n == 0, F.lit(None).cast("double")).when(self.differ < 1e-10, 0.0).otherwise(d)
        return F.coalesce(out, F.lit(INAPPLICABLE)) if legacy else out


def p_distance(t: PairTerms) -> Column:
    return t.differ


def jc69(t: PairTerms) -> Column:
    return 0.75 * t.log(1 - t.differ / 0.75)


def f81(t: PairTerms) -> Column:
    b = sum((p * (1 - p) for p in t.p.values()), F.lit(0.0))
    return b * t.log(1 - t.differ / b)


def k80(t: PairTerms) -> Column:
    a, v = t.log(1 - 2 * (t.p1 + t.p2) - t.q), t.log(1 - 2 * t.q)
    return a / 2 - v / 4 + v / 2


def groups(t: PairTerms) -> tuple[Column, Column, Column, Column]:
    y, r = t.p["T"] + t.p["C"], t.p["A"] + t.p["G"]
    return y, r, t.p["T"] * t.p["C"], t.p["A"] * t.p["G"]


def f84(t: PairTerms) -> Column:
    y, r, tc, ag = groups(t)
    changed = 1 - t.q / (2 * y * r)
    within = tc * r / y + ag * y / r
    a = t.log((2 * (tc + ag) + 2 * within * changed - t.p1 - t.p2) / (2 * tc / y + 2 * ag / r)) / 2
    v = t.log(changed) / 2
    kappa = F.when(v > 0, F.greatest(a / v - 1, F.lit(-0.5))).otherwise(MOST_KAPPA)
    return 4 * v * (tc * (1 + kappa / y) + ag * (1 + kappa / r) + y * r)


def transition_logs(t: PairTerms) -> tuple[Column, Column, Column]:
    y, r, tc, ag = groups(t)
    return t.log(1 - y * t.p1 / (2 * tc) - t.q / (2 * y)), t.log(1 - r * t.p2 / (2 * ag) - t.q / (2 * r)), t.log(1 - t.q / (2 * y * r))


def hky85(t: PairTerms) -> Column:
    y, r, tc, ag = groups(t)
    a1, a2, v = transition_logs(t)
    return (tc + ag) * ((a1 - r * v) / y + (a2 - y * v) / r) + 2 * y * r * v


def t92(t: PairTerms) -> Column:
    gc = t.p["G"] + t.p["C"]
    h = 2 * gc * (1 - gc)
    return h * t.log(1 - t.q - (t.p1 + t.p2) / h) + (1 - h) * t.log(1 - 2 * t.q) / 2


def tn93(t: PairTerms) -> Column:
    y, r, tc, ag = groups(t)
    a1, a2, v = transition_logs(t)
    return 2 * tc * (a1 - r * v) / y + 2 * ag * (a2 - y * v) / r + 2 * y * r * v


FORMULAS = {"p": p_distance, "jc69": jc69, "f81": f81, "k80": k80, "f84": f84, "hky85": hky85, "t92": t92, "tn93": tn93}


def distance(model: str, alpha: float | None = None, legacy: bool = False) -> Column:
    """The distance, null where it is inapplicable (``legacy``: 9)."""
    t = PairTerms(alpha)
    return t.finish(FORMULAS[model](t), legacy)
