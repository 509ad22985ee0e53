"""Joint ancestral states, and rates that are correlated along sites."""

from __future__ import annotations

from math import erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeworks.functions.frames import written
from cladeworks.functions.scores import Spec, alphabet_of, read_tree, tip_vectors

#: Patterns that are traced together.
TOGETHER = 2048


def joint_states(patterns: DataFrame, tree: str, spec: Spec, parameters: list[float], freqs: list[float], lengths: list[float]) -> DataFrame:
    """(pattern, node_ids, states, ln_joint, posterior): the most probable states of all inner nodes together, for each pattern.

    A block of patterns goes up the tree once, with the best state of each node for each state of its father, and down
    once along these pointers. Of equally probable states the first of the alphabet is told. ``posterior`` is the joint probability over that of the
    pattern. ``spec`` has one class of sites.
    """

    def run(frames):
        nodes, labels = read_tree(tree)
        (c,) = spec.classes(np.array(parameters), np.array(freqs), max(labels) + 1)
        alphabet = alphabet_of(spec.kind, spec.code)
        names = np.array(alphabet)
        with np.errstate(divide="ignore"):
            moves = [None] + [np.log(np.maximum(c.processes[labels[k]].p(t * c.rate), 1e-300)) for k, t in enumerate(lengths, 1)]
            start = np.log(np.array(freqs))
        inner = [n.node_id for n in nodes if n.sons]
        for pdf in frames:
            for a in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[a : a + TOGETHER]
                tips = tip_vectors(list(part["pattern"]), sum(not n.sons for n in nodes), alphabet)
                best, pointer, total = [None] * len(nodes), [None] * len(nodes), [None] * len(nodes)
                for n in reversed(nodes):
                    k = n.node_id
                    if n.sons:
                        own, mass = sum(best[s] for s in n.sons), sum(total[s] for s in n.sons)
                    else:
                        with np.errstate(divide="ignore"):
                            own = mass = np.log(tips[int(n.name) - 1])
                    if k:
                        both = moves[k][None, :, :] + own[:, None, :]
                        pointer[k], best[k] = both.argmax(2), both.max(2)
                        joined = moves[k][None, :, :] + mass[:, None, :]
                        top = joined.max(2)
                        total[k] = top + np.log(np.exp(joined - top[:, :, None]).sum(2))
                    else:
                        at = {0: (own + start).argmax(1)}
                        ln_joint = (own + start).max(1)
                        top = (mass + start).max(1)
                        lnf = top + np.log(np.exp(mass + start - top[:, None]).sum(1))
                rows = np.arange(len(part))
                for n in nodes[1:]:
                    at[n.node_id] = pointer[n.node_id][rows, at[n.father]]
                states = names[np.stack([at[k] for k in inner], 1)]
                yield pd.DataFrame({"pattern": part["pattern"].to_numpy(), "node_ids": [inner] * len(part), "states": states.tolist(), "ln_joint": ln_joint, "posterior": np.exp(ln_joint - lnf)})

    return patterns.select("pattern").mapInPandas(run, "pattern string, node_ids array<int>, states array<string>, ln_joint double, posterior double")


def normal_cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.array([erf(v / sqrt(2)) for v in np.ravel(x)]).reshape(np.shape(x)))


def class_moves(correlation: float, classes: int) -> np.ndarray:
    """How probably a site's rate class follows its neighbour's: equally likely cuts of two normal variables of that correlation."""
    grid = np.linspace(-8, 8, 16_001)
    cuts = np.concatenate([[-8.0], np.interp(np.arange(1, classes) / classes, normal_cdf(grid), grid), [8.0]])
    out = np.empty((classes, classes))
    x, w = np.polynomial.legendre.leggauss(64)
    for i in range(classes):
        low, high = max(cuts[i], -8), min(cuts[i + 1], 8)
        at = low + (high - low) * (x + 1) / 2
        weight = w * (high - low) / 2 * np.exp(-at * at / 2) / sqrt(2 * np.pi)
        bounds = (cuts[None, :] - correlation * at[:, None]) / sqrt(1 - correlation**2)
        bounds[:, 0], bounds[:, -1] = -40, 40
        out[i] = weight @ np.diff(normal_cdf(bounds), axis=1)
    return out / out.sum(1, keepdims=True)


def chained(f: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, float]:
    """(product of moves @ diag(f) over sites in order, logarithm of its scale). By halves, so that it is matrix products of growing stretches."""
    stretch = moves[None, :, :] * f[:, None, :]
    scale = np.zeros(len(stretch))
    while len(stretch) > 1:
        even = len(stretch) // 2 * 2
        made = stretch[0:even:2] @ stretch[1:even:2]
        top = made.max((1, 2))
        sums = scale[0:even:2] + scale[1:even:2] + np.log(top)
        stretch, scale = np.concatenate([made / top[:, None, None], stretch[even:]]), np.concatenate([sums, scale[even:]])
    return stretch[0], float(scale[0])


def correlated_rates(rows: DataFrame, moves: np.ndarray, rates: list[float]) -> tuple[float, DataFrame]:
    """(log-likelihood, (site, mean_rate, best)) of sites whose rate classes follow one another along a chain.

    Rows (site, lnf): ln f of each site in each rate class; classes are equally likely at first. Sites are sorted in range partitions. Each
    partition's product of transitions is one small matrix, so that a row a partition joins them: what comes before and behind
    each partition is then known, and a second pass gives each site's posterior. The result doesn't depend on the partitions. No
    rows: 0 and an empty table.
    """
    classes = len(rates)
    ordered = written(rows.select("site", "lnf").repartitionByRange("site").sortWithinPartitions("site").withColumn("part", F.spark_partition_id()), "sites")

    def stretches(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("site")
        lnf = np.stack(pdf["lnf"].to_numpy())
        top = lnf.max(1)
        matrix, scale = chained(np.exp(lnf - top[:, None]), moves)
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "matrix": [matrix.ravel().tolist()], "scale": [scale + top.sum()]})

    found = ordered.groupBy("part").applyInPandas(stretches, "part int, matrix array<double>, scale double").orderBy("part").collect()
    before, behind, lnl = {}, {}, 0.0
    vector = np.full(classes, 1 / classes)
    for r in found:
        before[r.part] = vector
        vector = vector @ np.array(r.matrix).reshape(classes, classes)
        lnl += r.scale + np.log(vector.sum())
        vector = vector / vector.sum()
    vector = np.ones(classes)
    for r in reversed(found):
        behind[r.part] = vector
        vector = np.array(r.matrix).reshape(classes, classes) @ vector
        vector = vector / vector.max()

    def posteriors(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("site")
        part = pdf["part"].iloc[0]
        lnf = np.stack(pdf["lnf"].to_numpy())
        f = np.exp(lnf - lnf.max(1)[:, None])
        ahead, back = np.empty_like(f), np.empty_like(f)
        now = before[part]
        for k in range(len(f)):
            now = (now @ moves) * f[k]
            now /= now.sum()
            ahead[k] = now
        now = behind[part]
        for k in range(len(f) - 1, -1, -1):
            back[k] = now
            now = moves @ (f[k] * now)
            now /= now.max()
        joint = ahead * back
        joint /= joint.sum(1, keepdims=True)
        return pd.DataFrame({"site": pdf["site"], "mean_rate": joint @ np.array(rates), "best": joint.argmax(1).astype(np.int32)})

    kind = rows.schema["site"].dataType.simpleString()
    return float(lnl), ordered.groupBy("part").applyInPandas(posteriors, f"site {kind}, mean_rate double, best int")
