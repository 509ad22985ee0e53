"""Tree search: a frontier of candidates in each round, scored side by side over blocks of patterns."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeworks.functions.scores import Spec, alphabet_of, read_tree, tip_vectors
from cladeworks.operators.likelihood import frequencies, shared_fits, spread
from cladeworks.sources.newick import parse_newick

#: Patterns that are scored together.
TOGETHER = 4096


def nested(text: str):
    """A tree's topology as tuples of tips' numbers."""
    nodes = parse_newick(text)
    made: dict[int, object] = {}
    for n in reversed(nodes):
        made[n.node_id] = tuple(made[s] for s in n.sons) if n.sons else n.name
    return made[0]


def text_of(tree) -> str:
    return tree if isinstance(tree, str) else f"({','.join(map(text_of, tree))})"


def least_tip(tree) -> int:
    return int(tree) if isinstance(tree, str) else min(map(least_tip, tree))


def canonical(tree):
    """One form for each unrooted topology: the first tip hangs at the root, and branches come in order of their smallest tips."""

    def ordered(t):
        return t if isinstance(t, str) else tuple(sorted(map(ordered, t), key=least_tip))

    links: dict[int, list[int]] = {}
    names: dict[int, str] = {}

    def walk(t, father):
        k = len(links)
        links[k] = [] if father is None else [father]
        if father is not None:
            links[father].append(k)
        if isinstance(t, str):
            names[k] = t
        else:
            for part in t:
                walk(part, k)

    walk(tree, None)
    first = min(names, key=lambda k: int(names[k]))

    def hung(k, origin):
        if k in names:
            return names[k]
        parts = tuple(hung(j, k) for j in links[k] if j != origin)
        return parts[0] if len(parts) == 1 else parts

    rest = hung(links[first][0], first)
    return ordered((names[first], *rest)) if not isinstance(rest, str) else (names[first], rest)


def neighbours(tree) -> list:
    """Trees one nearest-neighbour interchange away, each topology once."""
    found = set()

    def changed(t, put):
        """``put`` gives the whole tree with ``t`` replaced."""
        for k, v in enumerate(t):
            if isinstance(v, str):
                continue
            changed(v, lambda new, k=k, t=t, put=put: put((*t[:k], new, *t[k + 1 :])))
            others = [j for j in range(len(t)) if j != k]
            for a in range(len(v)):
                for j in others[: len(others) - (len(t) > 2)] or others:
                    parts = list(t)
                    parts[j], parts[k] = v[a], (*v[:a], t[j], *v[a + 1 :])
                    found.add(canonical(put(tuple(parts))))

    changed(tree, lambda new: new)
    return sorted(found - {canonical(tree)}, key=text_of)


def insertions(tree, tip: str) -> list:
    """Trees with a tip added to each branch."""

    def each(t):
        for k, part in enumerate(t):
            yield (*t[:k], (part, tip), *t[k + 1 :])
            if not isinstance(part, str):
                for new in each(part):
                    yield (*t[:k], new, *t[k + 1 :])

    return sorted({canonical(t) for t in each(tree)}, key=text_of)


def mergers(tree) -> list:
    """Trees with two of the root's branches joined."""
    return [(*(t for k, t in enumerate(tree) if k not in pair), tuple(tree[k] for k in pair)) for pair in combinations(range(len(tree)), 2)]


def changes_of(patterns: DataFrame, trees: list) -> list[int]:
    """The changes that each candidate needs: blocks of patterns score all candidates, and a sum for each leaves a task."""
    texts = [text_of(t) for t in trees]

    def run(frames):
        parsed, sums = [parse_newick(t) for t in texts], np.zeros(len(texts), np.int64)
        for pdf in frames:
            for a in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[a : a + TOGETHER]
                taxa = max((len(p) for p in part["pattern"]), default=0)
                tips = [(t > 0) for t in tip_vectors(list(part["pattern"]), taxa, alphabet_of("bases"))]
                weight = part["fpatt"].to_numpy()
                for t, nodes in enumerate(parsed):
                    sets, cost = {}, np.zeros(len(part), np.int64)
                    for n in reversed(nodes):
                        if not n.sons:
                            sets[n.node_id] = tips[int(n.name) - 1]
                            continue
                        votes = np.sum([sets.pop(s) for s in n.sons], axis=0, dtype=np.int64)
                        most = votes.max(1)
                        sets[n.node_id] = votes == most[:, None]
                        cost += len(n.sons) - most
                    sums[t] += weight @ cost
        yield pd.DataFrame({"place": np.arange(len(sums)), "score": sums})

    rows = patterns.select("pattern", "fpatt").mapInPandas(run, "place int, score long").groupBy("place").agg(F.sum("score").alias("score")).collect()
    out = [0] * len(texts)
    for r in rows:
        out[r.place] = r.score
    return out


class Scorer:
    """Scores of candidate trees, the larger the better: minus the changes they need, or their maximum likelihood under a ``spec``."""

    def __init__(self, patterns: DataFrame, spec: Spec | None, tolerance: float):
        self.blocks, self.spec, self.tolerance = spread(patterns), spec, tolerance
        self.freqs = frequencies(self.blocks, spec).get(0) if spec else None
        self.seen: dict[str, float] = {}

    def __call__(self, trees: list) -> list[float]:
        fresh = [t for t in dict.fromkeys(map(text_of, trees)) if t not in self.seen]
        if fresh and self.spec:
            self.seen |= zip(fresh, shared_fits(self.blocks, [f"{t};" for t in fresh], self.spec, self.freqs, self.tolerance), strict=True)
        elif fresh:
            self.seen |= zip(fresh, (-float(x) for x in changes_of(self.blocks, [nested(t) for t in fresh])), strict=True)
        return [self.seen[t] for t in map(text_of, trees)]

    def best(self, trees: list):
        """The best candidate, the first of equals."""
        scores = self(trees)
        k = max(range(len(trees)), key=lambda k: (round(scores[k], 6), -k))
        return trees[k], scores[k]


def search_trees(patterns: DataFrame, taxa: int, spec: Spec | None = None, start: str = "stepwise", tolerance: float = 1e-2, most_rounds: int = 1000) -> DataFrame:
    """(round, step, candidates, tree, score): the best tree of each round, of patterns (pattern, fpatt) of so many taxa.

    ``start``: stepwise, which adds one tip after the other where it costs least; star, which joins the two branches of a star whose
    union is best until none is left to join; or a tree's text. From there, nearest-neighbour interchanges go on while they are better. Without
    ``spec`` trees are scored by parsimony, otherwise by the likelihood of a fit of each. A round has as many candidates as a tree
    has branches (a star: pairs of them), never all topologies; all are scored in one job (a fit: one job for each of its rounds) over
    blocks of patterns, and only scores come to the driver. The last row is the result.
    """
    if taxa < 3:
        raise ValueError("a search needs three taxa")
    scorer, rows = Scorer(patterns, spec, tolerance), []

    def told(step: str, candidates: list):
        tree, score = scorer.best(candidates)
        rows.append((len(rows), step, len(candidates), f"{text_of(tree)};", float(score)))
        return tree, score

    names = [str(k + 1) for k in range(taxa)]
    if start == "stepwise":
        tree = tuple(names[:3])
        for tip in names[3:]:
            tree, score = told("add", insertions(tree, tip))
        tree, score = told("start", [canonical(tree)])
    elif start == "star":
        tree = tuple(names)
        while len(tree) > 3:
            tree, score = told("join", mergers(tree))
        tree, score = told("start", [canonical(tree)])
    else:
        tree, score = told("start", [canonical(nested(start))])
    for _ in range(most_rounds):
        near = neighbours(tree)
        if not near:
            break
        better, value = scorer.best(near)
        if value <= score + (tolerance if spec else 0):
            break
        tree, score = told("interchange", near)
    return patterns.sparkSession.createDataFrame(rows, "round int, step string, candidates int, tree string, score double")
