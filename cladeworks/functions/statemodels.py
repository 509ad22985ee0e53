"""Substitution models of amino acids and of codons with classes of sites, in NumPy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from cladeworks.functions.codons import CODONS, code_of
from cladeworks.functions.substitution import Model

# Fixed value: the one-letter amino acids, by their names in alphabetical order.
AMINO_ACIDS = "ARNDCQEGHILKMFPSTWYV"
#: Bounds of the free parameters of each model of site classes, kappa first. Shares are of what earlier shares leave.
SITE_MODELS = {
    "M0": [(0.01, 100.0), (1e-4, 50.0)],
    "M1a": [(0.01, 100.0), (1e-3, 0.999), (1e-4, 0.9999)],
    "M2a": [(0.01, 100.0), (1e-3, 0.999), (1e-3, 0.999), (1e-4, 0.9999), (1.0, 50.0)],
    "M3": [(0.01, 100.0), (1e-3, 0.999), (1e-3, 0.999), (1e-4, 50.0), (1e-4, 50.0), (1e-4, 50.0)],
}


def site_classes(model: str, x: np.ndarray) -> list[tuple[float, float]]:
    """(share of sites, ratio of nonsynonymous to synonymous rates) of each class; ``x`` begins with kappa."""
    if model == "M0":
        return [(1.0, x[1])]
    if model == "M1a":
        return [(x[1], x[2]), (1 - x[1], 1.0)]
    second = (1 - x[1]) * x[2]
    return [(x[1], x[3]), (second, 1.0 if model == "M2a" else x[4]), (1 - x[1] - second, x[4] if model == "M2a" else x[5])]


@lru_cache(maxsize=4)
def codon_steps(code: str) -> tuple[list[str], np.ndarray]:
    """(sense codons, rows of from, to, transition, synonymous for single changes)."""
    aa = code_of(code)
    sense = [c for c in CODONS if aa[c] != "*"]
    rows = []
    for i, a in enumerate(sense):
        for j, b in enumerate(sense):
            differ = [k for k in range(3) if a[k] != b[k]]
            if len(differ) == 1:
                rows.append((i, j, {a[differ[0]], b[differ[0]]} in ({"T", "C"}, {"A", "G"}), aa[a] == aa[b]))
    return sense, np.array(rows, int)


def codon_models(model: str, x: np.ndarray, freqs: np.ndarray, code: str) -> list[tuple[float, Model]]:
    """(share, process) of each class of sites. All have one time scale: a change a codon on the mean over classes."""
    _, (i, j, transition, synonymous) = codon_steps(code)[0], codon_steps(code)[1].T
    classes, matrices = site_classes(model, x), []
    for _, omega in classes:
        q = np.zeros((len(freqs), len(freqs)))
        q[i, j] = freqs[j] * np.where(transition == 1, x[0], 1.0) * np.where(synonymous == 1, 1.0, omega)
        np.fill_diagonal(q, -q.sum(1))
        matrices.append(q)
    scale = -sum(share * (freqs @ np.diag(q)) for (share, _), q in zip(classes, matrices, strict=True))
    return [(share, Model(0, freqs, q / scale)) for (share, _), q in zip(classes, matrices, strict=True)]


def protein_model(exchange: np.ndarray | None, freqs: np.ndarray) -> Model:
    """Exchange rates (symmetric, None: all alike) times the frequencies of what comes."""
    q = (np.ones((20, 20)) if exchange is None else np.asarray(exchange, float)) * freqs
    np.fill_diagonal(q, 0)
    np.fill_diagonal(q, -q.sum(1))
    return Model(0, freqs, q / -(freqs @ np.diag(q)))


def partials(states: list[list[str]], alphabet: list[str]) -> list[np.ndarray]:
    """For each taxon, patterns x states: 1 for the state, or for all of them if it is unknown."""
    at = {s: k for k, s in enumerate(alphabet)}
    out = []
    for taxon in zip(*states, strict=True):
        rows = np.ones((len(taxon), len(alphabet)))
        for r, s in enumerate(taxon):
            if s in at:
                rows[r] = 0
                rows[r, at[s]] = 1
        out.append(rows)
    return out
