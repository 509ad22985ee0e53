"""Rates along a tree that change little from father to son."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def smoothed_rates(branches: DataFrame, weight: float) -> DataFrame:
    """(tree_id, node_id, rate): the rates of branches (tree_id, node_id, father_id, length, span, variance) under a penalty.

    They minimise the sum of (length - rate * span)^2 / variance over branches, plus ``weight`` times that of the squared differences
    between a branch's rate and that of the branch above it, and among the branches at the root. Each tree is solved in one task, by one
    pass up and one down (sums of parabolas), so that its cost grows with its size alone; trees run side by side. A branch
    without a length, or of no variance or span, takes its rate from its neighbours; a tree without any known branch has null rates.
    """

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        node, father = pdf["node_id"].tolist(), pdf["father_id"].tolist()
        at = {k: i for i, k in enumerate(node)}
        sons: dict = {}
        for i, f in enumerate(father):
            sons.setdefault(f, []).append(i)
        roots = [f for f in sons if f not in at]
        length, span, variance = (pdf[c].to_numpy(float) for c in ("length", "span", "variance"))
        known = np.isfinite(length) & np.isfinite(variance) & (variance > 0) & (span > 0)
        if not known.any():
            return pdf[["tree_id", "node_id"]].assign(rate=None)
        # each branch's parabola is a r^2 - 2 c r; the root's is of a rate that all branches at it share in
        safe = np.where(known, variance, 1.0)
        a = np.where(known, np.nan_to_num(span) ** 2 / safe, 0.0)
        c = np.where(known, np.nan_to_num(span * length) / safe, 0.0)
        order, stack = [], [i for r in roots for i in sons[r]]
        while stack:
            i = stack.pop()
            order.append(i)
            stack += sons.get(node[i], [])
        top = [0.0, 0.0]
        for i in reversed(order):
            # minimised over this rate, what is left depends on the one above
            up = (weight - weight**2 / (a[i] + weight), weight * c[i] / (a[i] + weight))
            if (f := father[i]) in at:
                a[at[f]] += up[0]
                c[at[f]] += up[1]
            else:
                top[0] += up[0]
                top[1] += up[1]
        rate = np.zeros(len(node))
        base = top[1] / max(top[0], 1e-300)
        for i in order:
            above = rate[at[father[i]]] if father[i] in at else base
            rate[i] = (c[i] + weight * above) / (a[i] + weight)
        return pdf[["tree_id", "node_id"]].assign(rate=rate)

    kinds = {f.name: f.dataType.simpleString() for f in branches.schema}
    slim = branches.select("tree_id", "node_id", "father_id", "length", "span", "variance")
    return slim.groupBy("tree_id").applyInPandas(solve, f"tree_id {kinds['tree_id']}, node_id {kinds['node_id']}, rate double")
