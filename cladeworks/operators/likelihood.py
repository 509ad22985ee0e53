"""Likelihood jobs split over blocks of patterns: scores summed in Spark, fits that keep only parameters on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeworks.functions.frames import written
from cladeworks.functions.scores import Spec, alphabet_of, mixture, read_tree, shared_lnf, shared_parts, shared_slopes, tip_vectors

#: Patterns whose own scores are made together.
TOGETHER = 2048
#: Cells (patterns x states x nodes) of a block whose scores are only added up, and the most patterns of it.
BLOCK_CELLS, MOST_PATTERNS = 1 << 23, 1 << 16
#: Branch lengths that are fitted lie between these.
SHORTEST, LONGEST = 1e-6, 50.0


@dataclass
class Point:
    """Where a locus' likelihood is evaluated: its tree, frequencies of states, model parameters, and the lengths of the branches above nodes 1, 2, ..."""

    tree: str
    freqs: np.ndarray
    parameters: np.ndarray
    lengths: np.ndarray


@dataclass
class Climb:
    """The state of one locus' ascent: y are parameters and lengths on a logistic scale between their bounds."""

    point: Point
    low: np.ndarray
    high: np.ndarray
    y: np.ndarray
    value: float = -np.inf
    slope: np.ndarray | None = None
    inverse: np.ndarray | None = None
    move: np.ndarray | None = None
    step: float = 0.0
    rounds: int = 0
    tried: int = 0
    done: bool = False
    trace: list[float] = field(default_factory=list)

    def at(self, y: np.ndarray) -> np.ndarray:
        return self.low + (self.high - self.low) / (1 + np.exp(-y))

    def pace(self, y: np.ndarray) -> np.ndarray:
        x = self.at(y)
        return (x - self.low) * (self.high - x) / (self.high - self.low)


def frequencies(patterns: DataFrame, spec: Spec) -> dict[int, np.ndarray]:
    """Frequencies of states in each locus: bases and amino acids as they occur, codons as products of bases at the three positions; none is left at zero."""
    alphabet = alphabet_of(spec.kind, spec.code)
    if spec.equal_frequencies():
        return {r.locus: np.full(4, 0.25) for r in patterns.select("locus").distinct().collect()}
    letters = "TCAG" if spec.kind == "codons" else "".join(alphabet)
    texts = [F.regexp_replace("pattern", "(.)(.)(.)", f"${k}") for k in (1, 2, 3)] if spec.kind == "codons" else [F.col("pattern")]
    sums = [F.sum(F.col("fpatt") * (F.length(t) - F.length(F.replace(t, F.lit(x), F.lit(""))))).alias(f"n{k}_{x}") for k, t in enumerate(texts) for x in letters]
    out = {}
    for r in patterns.groupBy("locus").agg(*sums).collect():
        counts = np.array([[r[f"n{k}_{x}"] for x in letters] for k in range(len(texts))], float) + 1e-6
        shares = counts / counts.sum(1, keepdims=True)
        found = np.array([np.prod([shares[k, "TCAG".index(c[k])] for k in range(3)]) for c in alphabet]) if spec.kind == "codons" else shares[0]
        out[r.locus] = found / found.sum()
    return out


def block_scores(spec: Spec, points: dict[int, Point], outer: bool, shared: bool = False):
    """A function for mapInPandas: (locus, at, value) with the sums of a task's patterns. ``shared``: every point is evaluated on all rows.

    at -1: the log-likelihood; 0 to m - 1: its gradient by parameters and branch lengths; from m on, if asked for, the m x m sums of
    products of scores. Only sums leave a task. Products need each pattern's scores; without them blocks are large, and what patterns
    have in common is worked out once.
    """

    def sums_of(locus, part: pd.DataFrame) -> np.ndarray:
        if not outer:
            return slopes_of(spec, points[locus], part)
        lnf, scores, weight = scores_of(spec, points[locus], part)
        return np.concatenate([[weight @ lnf], weight @ scores, ((scores * weight[:, None]).T @ scores).ravel()])

    def run(frames):
        sums: dict[int, np.ndarray] = {}
        size = {k: TOGETHER if outer else block_size(spec, p) for k, p in points.items()}
        for pdf in gathered(frames, max(size.values(), default=1)):
            for locus, part in ((k, pdf) for k in points) if shared else pdf.groupby("locus"):
                for a in range(0, len(part), size[locus]):
                    sums[locus] = sums.get(locus, 0) + sums_of(locus, part.iloc[a : a + size[locus]])
        for locus, values in sums.items():
            yield pd.DataFrame({"locus": locus, "at": np.arange(-1, len(values) - 1), "value": values})

    return run


def block_size(spec: Spec, p: Point) -> int:
    cells = len(alphabet_of(spec.kind, spec.code)) * (len(p.lengths) + 1)
    return int(np.clip(BLOCK_CELLS // cells, 256, MOST_PATTERNS))


def gathered(frames, rows: int):
    """Frames of at least so many rows, but for the last."""
    some, n = [], 0
    for pdf in frames:
        some.append(pdf)
        n += len(pdf)
        if n >= rows:
            yield pd.concat(some)
            some, n = [], 0
    if n:
        yield pd.concat(some)


def slopes_of(spec: Spec, p: Point, part: pd.DataFrame) -> np.ndarray:
    """The log-likelihood of some patterns and its gradient, as ``scores_of`` would sum up."""
    nodes, labels = read_tree(p.tree)
    count, lengths = max(labels) + 1, np.concatenate([[0.0], p.lengths])
    block = shared_parts(nodes, list(part["pattern"]), alphabet_of(spec.kind, spec.code))
    weight = np.bincount(block.place, part["fpatt"].to_numpy(float))
    lnf, by_length = shared_slopes(block, labels, lengths, spec.classes(p.parameters, p.freqs, count), weight)
    by_parameter = [weight @ d for d in differences(spec, p, count, lambda classes: shared_lnf(block, labels, lengths, classes))]
    return np.concatenate([[weight @ lnf], by_parameter, by_length])


def differences(spec: Spec, p: Point, labels: int, lnf):
    """Central differences by each parameter of what ``lnf`` makes of classes."""
    for k, x in enumerate(p.parameters):
        h = 1e-5 * max(abs(x), 1e-2)
        high, low = (lnf(spec.classes(np.where(np.arange(len(p.parameters)) == k, x + s * h, p.parameters), p.freqs, labels)) for s in (1, -1))
        yield (high - low) / (2 * h)


def scores_of(spec: Spec, p: Point, part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ln f, its derivatives by parameters and branch lengths, counts) of some patterns; by parameters as central differences."""
    nodes, labels = read_tree(p.tree)
    taxa, count = sum(not n.sons for n in nodes), max(labels) + 1
    tips = tip_vectors(list(part["pattern"]), taxa, alphabet_of(spec.kind, spec.code))
    lengths = np.concatenate([[0.0], p.lengths])
    lnf, by_length, _, _ = mixture(nodes, tips, labels, lengths, spec.classes(p.parameters, p.freqs, count))
    block = shared_parts(nodes, list(part["pattern"]), alphabet_of(spec.kind, spec.code))
    columns = [d[block.place] for d in differences(spec, p, count, lambda classes: shared_lnf(block, labels, lengths, classes))]
    scores = np.column_stack([*columns, by_length]) if columns else by_length
    return lnf, scores, part["fpatt"].to_numpy(float)


def summed_scores(patterns: DataFrame, spec: Spec, points: dict[int, Point], outer: bool = False, shared: bool = False) -> DataFrame:
    """(locus, at, value) as ``block_scores`` has them, over all patterns."""
    some = patterns.select("locus", "pattern", "fpatt")
    some = some if shared else some.where(F.col("locus").isin(list(points)))
    return some.mapInPandas(block_scores(spec, points, outer, shared), "locus int, at int, value double").groupBy("locus", "at").agg(F.sum("value").alias("value"))


def evaluated(patterns: DataFrame, spec: Spec, points: dict[int, Point], outer: bool = False, shared: bool = False) -> dict[int, tuple]:
    """locus -> (lnl, gradient, products or None), from one job over all blocks of all loci in ``points``."""
    rows = summed_scores(patterns, spec, points, outer, shared).collect()
    flat: dict[int, dict[int, float]] = {}
    for r in rows:
        flat.setdefault(r.locus, {})[r["at"]] = r.value
    out = {}
    for locus, found in flat.items():
        m = len(points[locus].parameters) + len(points[locus].lengths)
        values = np.array([found[k] for k in range(-1, len(found) - 1)])
        out[locus] = (values[0], values[1 : m + 1], values[m + 1 :].reshape(m, m) if outer else None)
    return out


def spread(patterns: DataFrame, tasks: int | None = None) -> DataFrame:
    """Patterns (locus, pattern, fpatt), collapsed and dealt out evenly over tasks, as a written table that each evaluation reads.

    So many tasks as the cluster runs at once, if not given: patterns are few bytes but much work, and adaptive execution would put them in one.
    """
    tasks = tasks or patterns.sparkSession.sparkContext.defaultParallelism
    locus = F.col("locus") if "locus" in patterns.columns else F.lit(0)
    each = patterns.select(locus.cast("int").alias("locus"), "pattern", "fpatt").groupBy("locus", "pattern").agg(F.sum("fpatt").alias("fpatt"))
    return written(each.repartition(tasks, "locus", "pattern"), "blocks")


def climbed(patterns: DataFrame, spec: Spec, starts: dict[int, Point], rounds: int, tolerance: float, shared: bool = False) -> dict[int, Climb]:
    """Each locus' ascent by quasi-Newton steps (BFGS) on sums of scores; all loci that aren't done share one job a round.

    The first curvature is that of the products of scores. A step that doesn't raise the log-likelihood is shortened. An ascent ends
    when a round adds less than ``tolerance`` and the slope promises no more.
    """
    climbs = {}
    for locus, p in starts.items():
        bounds = np.concatenate([spec.parameters(max(read_tree(p.tree)[1]) + 1)[0], np.tile([[SHORTEST, LONGEST]], (len(p.lengths), 1))])
        x = np.clip(np.concatenate([p.parameters, p.lengths]), bounds[:, 0] * (1 + 1e-9) + 1e-12, bounds[:, 1] * (1 - 1e-9))
        climbs[locus] = Climb(p, bounds[:, 0], bounds[:, 1], np.log((x - bounds[:, 0]) / (bounds[:, 1] - x)))

    def point(c: Climb, y: np.ndarray) -> Point:
        x, free = c.at(y), len(c.point.parameters)
        return replace(c.point, parameters=x[:free], lengths=x[free:])

    found = evaluated(patterns, spec, {k: point(c, c.y) for k, c in climbs.items()}, True, shared)
    for locus, c in climbs.items():
        if locus not in found:  # no patterns
            c.value, c.done = 0.0, True
            continue
        value, gradient, products = found[locus]
        pace = c.pace(c.y)
        c.value, c.slope = value, gradient * pace
        curved = products * np.outer(pace, pace)
        c.inverse = np.linalg.inv(curved + np.diag(1e-3 * np.diag(curved) + 1e-3))
        aim(c)
    while active := {k: c for k, c in climbs.items() if not c.done}:
        found = evaluated(patterns, spec, {k: point(c, c.y + c.step * c.move) for k, c in active.items()}, False, shared)
        for locus, c in active.items():
            value, gradient, _ = found[locus]
            judged(c, value, gradient, tolerance, rounds)
    for c in climbs.values():
        c.point = point(c, c.y)
    return climbs


def aim(c: Climb) -> None:
    """Set out along the quasi-Newton direction, no further than by 2 in any coordinate."""
    c.move = c.inverse @ c.slope
    if c.move @ c.slope <= 0:
        c.inverse = np.diag(1 / np.maximum(np.abs(c.slope), 1.0))
        c.move = c.inverse @ c.slope
    c.step, c.tried = min(1.0, 2.0 / max(np.abs(c.move).max(), 1e-12)), 0


def judged(c: Climb, value: float, gradient: np.ndarray, tolerance: float, rounds: int) -> None:
    """Take the step that was tried, or shorten it."""
    c.tried += 1
    if not np.isfinite(value) or value < c.value:
        c.step *= 0.25
        if c.tried >= 6:
            c.done = True
        return
    moved = c.step * c.move
    y = c.y + moved
    slope = gradient * c.pace(y)
    turned = c.slope - slope  # of the negative log-likelihood
    gain, c.y, c.value, c.slope, c.rounds = value - c.value, y, value, slope, c.rounds + 1
    c.trace.append(value)
    if (along := moved @ turned) > 1e-12:
        left = np.eye(len(y)) - np.outer(moved, turned) / along
        c.inverse = left @ c.inverse @ left.T + np.outer(moved, moved) / along
    aim(c)
    c.done = c.rounds >= rounds or gain < tolerance and c.slope @ c.move / 2 < tolerance


def fitted_points(patterns: DataFrame, trees: dict[int, str] | str, spec: Spec, rounds: int = 100, tolerance: float = 1e-4, length: float = 0.1) -> tuple[DataFrame, dict[int, Climb]]:
    """(the patterns as they were spread, locus -> its ascent)."""
    blocks = spread(patterns)
    starts = {}
    for locus, freqs in frequencies(blocks, spec).items():
        tree = trees if isinstance(trees, str) else trees[locus]
        nodes, labels = read_tree(tree)
        lengths = np.array([length if n.length is None else max(n.length, 1e-4) for n in nodes[1:]])
        starts[locus] = Point(tree, freqs, spec.parameters(max(labels) + 1)[1], lengths)
    return blocks, climbed(blocks, spec, starts, rounds, tolerance)


def shared_fits(blocks: DataFrame, trees: list[str], spec: Spec, freqs: np.ndarray, tolerance: float, rounds: int = 100) -> list[float]:
    """The maximum log-likelihood of each candidate tree over the same patterns; all candidates share each job."""
    starts = {}
    for k, tree in enumerate(trees):
        nodes, labels = read_tree(tree)
        starts[k] = Point(tree, freqs, spec.parameters(max(labels) + 1)[1], np.full(len(nodes) - 1, 0.1))
    found = climbed(blocks, spec, starts, rounds, tolerance, shared=True)
    return [float(found[k].value) for k in range(len(trees))]


FIT = "locus int, model string, lnl double, parameters array<double>, branch_lengths array<double>, tree_length double, rounds int, converged boolean"


def fit_blocks(patterns: DataFrame, trees: dict[int, str] | str, spec: Spec, rounds: int = 100, tolerance: float = 1e-4) -> DataFrame:
    """(locus, model, lnl, parameters, branch_lengths, tree_length, rounds, converged): maximum likelihood of rows (locus, pattern, fpatt).

    A tree for all loci, or one for each; its tips are numbered like the patterns' taxa and its branches may have labels. Each round
    is one job over blocks of patterns of all loci, whatever their size; tasks sum up log-likelihoods and scores, and only parameters,
    gradients and a matrix as wide as those stay on the driver. A locus without rows has no row; patterns with unknown characters only add nothing.
    """
    _, climbs = fitted_points(patterns, trees, spec, rounds, tolerance)
    rows = [(int(k), spec.model, float(c.value), c.point.parameters.tolist(), c.point.lengths.tolist(), float(c.point.lengths.sum()), c.rounds, c.rounds < rounds) for k, c in sorted(climbs.items())]
    return patterns.sparkSession.createDataFrame(rows, FIT)


def branch_curvature(patterns: DataFrame, trees: dict[int, str] | str, spec: Spec, rounds: int = 100, tolerance: float = 1e-5) -> DataFrame:
    """(locus, taxa, tree, b, g, h): branch lengths at their maximum, and there the gradient and the Hessian of the log-likelihood by them.

    The Hessian is minus the sum of products of each pattern's scores, which blocks add up in Spark; it never is a whole matrix of patterns by
    branches. Branches are those above nodes 1, 2, ... in order of appearance; ``tree`` is written with the lengths.
    """
    blocks, climbs = fitted_points(patterns, trees, spec, rounds, tolerance)
    points = {k: c.point for k, c in climbs.items()}
    rows = []
    for locus, (_, gradient, products) in sorted(evaluated(blocks, spec, points, outer=True).items()):
        p, skip = points[locus], len(points[locus].parameters)
        nodes, _ = read_tree(p.tree)
        rows.append((int(locus), sum(not n.sons for n in nodes), lengthened(p.tree, p.lengths), p.lengths.tolist(), gradient[skip:].tolist(), (-products[skip:, skip:]).tolist()))
    return patterns.sparkSession.createDataFrame(rows, "locus int, taxa int, tree string, b array<double>, g array<double>, h array<array<double>>")


def lengthened(tree: str, lengths: np.ndarray) -> str:
    """The tree's text with these branch lengths, six digits each."""
    nodes, _ = read_tree(tree)

    def text(k: int) -> str:
        n = nodes[k]
        inner = f"({', '.join(map(text, n.sons))})" if n.sons else ""
        return inner + (n.name or "") + (f": {lengths[k - 1]:.6f}" if k else ";")

    return text(0)


def site_class_lnf(patterns: DataFrame, tree: str, spec: Spec, parameters: list[float], freqs: list[float], lengths: list[float]) -> DataFrame:
    """(pattern, fpatt, shares, lnf): ln of each pattern's probability in each class of sites."""

    def run(frames):
        nodes, labels = read_tree(tree)
        classes = spec.classes(np.array(parameters), np.array(freqs), max(labels) + 1)
        shares = [c.share for c in classes]
        for pdf in frames:
            for a in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[a : a + TOGETHER]
                tips = tip_vectors(list(part["pattern"]), sum(not n.sons for n in nodes), alphabet_of(spec.kind, spec.code))
                found = mixture(nodes, tips, labels, np.concatenate([[0.0], lengths]), classes, derive=False)[3]
                yield part.assign(shares=[shares] * len(part), lnf=list(found))

    return patterns.select("pattern", "fpatt").mapInPandas(run, "pattern string, fpatt long, shares array<double>, lnf array<double>")
