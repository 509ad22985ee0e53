"""Bayes empirical Bayes: posteriors of site classes averaged over a grid of model parameters, by blocks of sites."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeworks.functions.scores import SiteClass, alphabet_of, beta_quantiles, codon_rates, mixture, omega_classes, read_tree, tip_vectors
from cladeworks.functions.substitution import Model

#: Points of a grid in each dimension, and how far above 1 the largest omega goes.
POINTS, OVER_ONE = 10, 10.0
#: Sites that meet the whole grid at once.
TOGETHER = 1024


def middles(low: float, high: float, points: int = POINTS) -> np.ndarray:
    return low + (high - low) * (np.arange(points) + 0.5) / points


def share_grid(points: int = POINTS) -> np.ndarray:
    """The centres of the points^2 triangles that a triangle of three shares is cut into: those that point up, then those that point down."""
    out = []
    for size, offset in ((points - 1, 1 / 3), (points - 2, 2 / 3)):
        out += [(a + offset, b + offset, size - a - b + offset) for a in range(size + 1) for b in range(size + 1 - a)]
    return np.array(out) / points


def grid_m2a(points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """(omegas, shares of them at each grid point): omega below one and above one, one itself, and the shares of the three."""
    low, high = middles(0, 1, points), middles(1, 1 + OVER_ONE, points)
    rows = []
    for p in share_grid(points):
        for i in range(points):
            for j in range(points):
                row = np.zeros(2 * points + 1)
                row[i], row[points], row[points + 1 + j] = p
                rows.append(row)
    return np.concatenate([low, [1.0], high]), np.array(rows)


def grid_m8(points: int = POINTS, classes: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """(omegas, shares): beta distributions of omega with p and q up to two, spread over the nearest of evenly laid omegas, their share, and an omega above one."""
    low, high = middles(0, 1, 2 * points), middles(1, 1 + OVER_ONE, points)
    rows = []
    for p in middles(0, 2, points):
        for q in middles(0, 2, points):
            spread = np.bincount(np.minimum((beta_quantiles(p, q, classes) * 2 * points).astype(int), 2 * points - 1), minlength=2 * points) / classes
            for share in middles(0, 1, points):
                for j in range(points):
                    rows.append(np.concatenate([spread * share, (1 - share) * (np.arange(points) == j)]))
    return np.concatenate([low, high]), np.array(rows)


def omega_lnf(patterns: DataFrame, tree: str, kappa: float, freqs: list[float], lengths: list[float], omegas: list[float], fitted: tuple[str, list[float]], code: str = "universal") -> DataFrame:
    """(pattern, fpatt, lnf): ln of each pattern's probability at each omega; time is scaled as the ``fitted`` model (name, parameters) scales it."""

    def run(frames):
        nodes, labels = read_tree(tree)
        f = np.array(freqs)
        rate = lambda w: codon_rates(kappa, w, f, code)
        scale = sum(share * -(f @ np.diag(rate(w[0]))) for share, w in omega_classes(fitted[0], np.array(fitted[1]), 1))
        classes = [SiteClass(1.0, 1.0, (Model(0, f, rate(w) / scale),) * (max(labels) + 1)) for w in omegas]
        alphabet = alphabet_of("codons", code)
        for pdf in frames:
            for a in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[a : a + TOGETHER]
                tips = tip_vectors(list(part["pattern"]), sum(not n.sons for n in nodes), alphabet)
                yield part.assign(lnf=list(mixture(nodes, tips, labels, np.concatenate([[0.0], lengths]), classes, derive=False)[3]))

    return patterns.select("pattern", "fpatt").mapInPandas(run, "pattern string, fpatt long, lnf array<double>")


def site_terms(lnf: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(likelihoods scaled by site, their mixtures at each grid point, logarithms of the scales)."""
    top = lnf.max(1)
    f = np.exp(lnf - top[:, None])
    return f, np.maximum(f @ shares.T, 1e-300), top


def grid_lnl(rows: DataFrame, shares: np.ndarray) -> DataFrame:
    """(point, lnl): the log-likelihood of all sites (fpatt, lnf) at each point of the grid. A task's sites leave it as one sum a point."""

    def run(frames):
        total = np.zeros(len(shares))
        for pdf in frames:
            for a in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[a : a + TOGETHER]
                _, mixed, top = site_terms(np.stack(part["lnf"].to_numpy()), shares)
                weight = part["fpatt"].to_numpy(float)
                total += weight @ np.log(mixed) + weight @ top
        yield pd.DataFrame({"point": np.arange(len(total)), "lnl": total})

    return rows.select("fpatt", "lnf").mapInPandas(run, "point int, lnl double").groupBy("point").agg(F.sum("lnl").alias("lnl"))


def grid_posteriors(rows: DataFrame, shares: np.ndarray) -> np.ndarray:
    """The posterior of each grid point under a flat prior; as many numbers as the grid has, whatever the data."""
    lnl = np.zeros(len(shares))
    for r in grid_lnl(rows, shares).collect():
        lnl[r.point] = r.lnl
    weights = np.exp(lnl - lnl.max())
    return weights / weights.sum()


def empirical_bayes(rows: DataFrame, keys: list[str], omegas: np.ndarray, shares: np.ndarray) -> DataFrame:
    """(*keys, p_positive, mean, sd) of sites (*keys, fpatt, lnf): the posterior that omega is over one, and omega's mean and deviation.

    ``lnf`` holds ln f at each of ``omegas``, ``shares`` is a row of their shares for each grid point. Two passes over
    blocks of sites: the first sums up each point's log-likelihood over all sites, the second averages each site's posterior over the points. Both
    tables that tasks get have the grid's size. A table without sites gives an empty one.
    """
    weights = grid_posteriors(rows, shares)
    over = np.asarray(omegas) > 1

    def run(frames):
        for pdf in frames:
            for a in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[a : a + TOGETHER]
                f, mixed, _ = site_terms(np.stack(part["lnf"].to_numpy()), shares)
                posterior = f * ((weights / mixed) @ shares)
                mean, square = posterior @ omegas, posterior @ omegas**2
                yield part[keys].assign(p_positive=posterior[:, over].sum(1), mean=mean, sd=np.sqrt(np.maximum(square - mean**2, 0)))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select(*keys, "lnf").mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", p_positive double, mean double, sd double")
