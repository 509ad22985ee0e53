"""Model quantities as Columns, and fits as grouped jobs over collapsed patterns."""

from __future__ import annotations

from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladeworks.functions.codons import code_of
from cladeworks.functions.statemodels import AMINO_ACIDS, SITE_MODELS, codon_models, codon_steps, partials, protein_model, site_classes
from cladeworks.functions.substitution import MODELS, Model, discrete_gamma, exchange_matrix, pattern_lnl, pruned, tips_of
from cladeworks.sources.newick import parse_newick

EQUAL = np.full(4, 0.25)
BASES = "TCAG"


def pt_jc69(t: Column, states: int) -> tuple[Column, Column]:
    """Probabilities of the same and of one other state after time t, all states alike."""
    power = F.exp(-states / (states - 1) * t)
    return 1 / states + (states - 1) / states * power, 1 / states - power / states


def pt_k80(t: Column, kappa: float) -> tuple[Column, Column, Column]:
    """Probabilities of the same base, its transition, and one of its transversions."""
    slow, fast = F.exp(-4 * t / (kappa + 2)), F.exp(-2 * t * (kappa + 1) / (kappa + 2))
    return 0.25 + slow / 4 + fast / 2, 0.25 + slow / 4 - fast / 2, 0.25 - slow / 4


def ln_gamma_density(t: Column, a: float, b: float) -> Column:
    return F.lit(a * np.log(b) - lgamma(a)) + (a - 1) * F.log(t) - b * t


def ln_bound_density(t: Column, low: float, high: float, below: float, above: float) -> Column:
    """Flat between the bounds, a power tail of mass ``below`` under them and an exponential one of mass ``above``."""
    h = (1 - below - above) / (high - low)
    left, right = h * low / below, h / above
    under = F.lit(np.log(below * left / low)) + (left - 1) * F.log(t / low)
    over = F.lit(np.log(above * right)) - right * (t - high)
    return F.when(t < low, under).when(t > high, over).otherwise(F.lit(np.log(h)))


def count_trees(ns: Column, rooted: bool) -> Column:
    """Labelled topologies of so many tips, as a double: whole numbers outgrow 64 bits from 20 tips on."""
    last = ns.cast("int") + int(rooted)
    product = F.aggregate(F.sequence(F.lit(4), last), F.lit(1.0), lambda acc, i: acc * (2 * i - 5))
    return F.when(last >= 4, product).otherwise(F.lit(1.0))


def variable_share_grid(patterns: DataFrame, points: int) -> DataFrame:
    """(p, lnl): for each point of a grid of p, the log-likelihood of which columns vary."""
    grid = F.explode(F.array(*[F.lit((k + 0.5) / points) for k in range(points)])).alias("p")
    vary = F.size(F.array_distinct(F.split("pattern", ""))) > 1
    both = patterns.select("fpatt", vary.alias("vary"), grid)
    return both.groupBy("p").agg(F.sum(F.col("fpatt") * F.log(F.when(F.col("vary"), F.col("p")).otherwise(1 - F.col("p")))).alias("lnl"))


def all_patterns(spark: SparkSession, patterns: DataFrame, taxa: int) -> DataFrame:
    """(pattern, n): every possible column of the first ``taxa`` taxa, with the times it occurs."""
    digit = lambda k: F.substring(F.lit(BASES), F.expr(f"cast(id div {4**k} % 4 + 1 as int)"), F.lit(1))
    every = spark.range(4**taxa).select(F.concat(*[digit(k) for k in reversed(range(taxa))]).alias("pattern"))
    seen = patterns.groupBy(F.substring("pattern", 1, taxa).alias("pattern")).agg(F.sum("fpatt").alias("n"))
    return every.join(seen, "pattern", "left").select("pattern", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def parsimony_changes(patterns: DataFrame, tree: str) -> DataFrame:
    """(pattern, fpatt, changes): the fewest changes on a tree whose tips are numbered like the patterns' characters.

    One column for each node, tips first: the states that most sons allow stay, and the sons without
    them cost a change each. All of it stays in the JVM, whatever the tree's shape.
    """
    nodes = parse_newick(tree)
    bits = F.create_map(*[F.lit(x) for k, b in enumerate(BASES) for x in (b, 1 << k)])
    out = patterns
    for n in reversed(nodes):
        if not n.sons:
            out = out.withColumn(f"_set{n.node_id}", F.coalesce(bits[F.substring("pattern", int(n.name), 1)], F.lit(15)))
            continue
        votes = F.array(*[sum((F.shiftright(f"_set{s}", k).bitwiseAND(F.lit(1)) for s in n.sons), F.lit(0)) for k in range(4)])
        out = out.withColumn(f"_votes{n.node_id}", votes).withColumn(f"_most{n.node_id}", F.array_max(f"_votes{n.node_id}"))
        kept = [F.when(F.get(f"_votes{n.node_id}", F.lit(k)) == F.col(f"_most{n.node_id}"), 1 << k).otherwise(0) for k in range(4)]
        out = out.withColumn(f"_set{n.node_id}", sum(kept, F.lit(0))).withColumn(f"_cost{n.node_id}", F.lit(len(n.sons)) - F.col(f"_most{n.node_id}"))
    cost = sum((F.col(f"_cost{n.node_id}") for n in nodes if n.sons), F.lit(0))
    return out.select("pattern", "fpatt", cost.cast("int").alias("changes"))


def change_histogram(changes: DataFrame) -> DataFrame:
    """(changes, n_sites)."""
    return changes.groupBy("changes").agg(F.sum("fpatt").alias("n_sites"))


def alpha_by_moments(changes: DataFrame) -> DataFrame:
    """(mean, variance, alpha) of the changes per site: mean^2 / (variance - mean)."""
    n, s, ss = F.sum("fpatt"), F.sum(F.col("fpatt") * F.col("changes")), F.sum(F.col("fpatt") * F.col("changes") ** 2)
    m = changes.agg(n.alias("n"), (s / n).alias("mean"), ((ss - s * s / n) / (n - 1)).alias("variance"))
    return m.select("mean", "variance", F.when(F.col("variance") > F.col("mean"), F.col("mean") ** 2 / (F.col("variance") - F.col("mean"))).alias("alpha"))


def _lengths(nodes, default: float) -> np.ndarray:
    return np.array([default if n.length is None else n.length for n in nodes])


def pattern_likelihoods(patterns: DataFrame, tree: str, length: float, kappa: float, alpha: float, classes: int) -> DataFrame:
    """(pattern, fpatt, lnf) on a tree; ``length`` is that of branches without one. Blocks of patterns are pruned together."""

    def run(frames):
        nodes, model, rates = parse_newick(tree), Model(kappa, EQUAL), discrete_gamma(alpha, classes)
        for pdf in frames:
            lnf = pattern_lnl(nodes, tips_of(nodes, list(pdf["pattern"])), model, _lengths(nodes, length), rates) if len(pdf) else []
            yield pdf.assign(lnf=lnf)

    return patterns.select("pattern", "fpatt").mapInPandas(run, "pattern string, fpatt long, lnf double")


def ancestral_states(patterns: DataFrame, tree: str, length: float, kappa: float) -> DataFrame:
    """(pattern, node_id, state, posterior): the most probable state of each inner node of each pattern."""

    def run(frames):
        nodes, model = parse_newick(tree), Model(kappa, EQUAL)
        lengths = _lengths(nodes, length)
        for pdf in frames:
            if not len(pdf):
                continue
            below = pruned(nodes, tips_of(nodes, list(pdf["pattern"])), model, lengths)
            above = {0: np.tile(model.freqs, (len(pdf), 1))}
            for n in nodes:
                for s in n.sons:
                    others = np.prod([np.ones((len(pdf), 4)), *(below[o] @ model.p(lengths[o]).T for o in n.sons if o != s)], axis=0)
                    above[s] = (above[n.node_id] * others) @ model.p(lengths[s])
                if n.sons:
                    joint = above[n.node_id] * below[n.node_id]
                    best = joint.argmax(1)
                    share = joint[np.arange(len(pdf)), best] / joint.sum(1)
                    yield pd.DataFrame({"pattern": pdf["pattern"], "node_id": n.node_id, "state": [BASES[k] for k in best], "posterior": share})

    return patterns.select("pattern").mapInPandas(run, "pattern string, node_id int, state string, posterior double")


def golden(f, low: float, high: float, steps: int = 40) -> float:
    """Where f is largest between two bounds, on a logarithmic scale."""
    a, b, g = np.log(low), np.log(high), (5**0.5 - 1) / 2
    c, d = b - g * (b - a), a + g * (b - a)
    fc, fd = f(np.exp(c)), f(np.exp(d))
    for _ in range(steps):
        if fc > fd:
            b, d, fd = d, c, fc
            c = b - g * (b - a)
            fc = f(np.exp(c))
        else:
            a, c, fc = c, d, fd
            d = a + g * (b - a)
            fd = f(np.exp(d))
    return float(np.exp((a + b) / 2))


def base_frequencies(patterns: list[str], weight: np.ndarray) -> np.ndarray:
    """Shares of known bases; none is left at zero."""
    counts = np.array([sum(w * p.count(b) for p, w in zip(patterns, weight, strict=True)) for b in BASES], float)
    return (counts + 1e-6) / (counts + 1e-6).sum()


def ascended(f, x: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, float, int]:
    """(place, value, rounds) of a maximum: one coordinate after the other, in intervals that narrow, until a round adds less than ``tolerance``."""
    best, width, done = f(x), 100.0, 0
    for done in range(1, rounds + 1):
        before = best
        for k in range(len(x)):
            found = x.copy()
            found[k] = golden(lambda v, k=k, x=x: f(np.where(np.arange(len(x)) == k, v, x)), max(low[k], x[k] / width), min(high[k], x[k] * width), 18)
            if (new := f(found)) > best:
                x, best = found, new
        if best - before < tolerance and width < 1.5:
            break
        width = max(1.2, width**0.5)
    return x, best, done


def fit_trees(patterns: DataFrame, trees: list[str], model: str = "K80", classes: int = 1, rounds: int = 60, tolerance: float = 1e-4) -> DataFrame:
    """(partition_id, tree_id, lnl, parameters, alpha, tree_length, rounds, converged): a fit for each partition and tree, side by side.

    Rows (partition_id, pattern, fpatt). A group is one fit's collapsed patterns. ``model`` is one of MODELS;
    with several ``classes`` rates over sites follow a discrete gamma distribution, whose alpha is fitted
    too. Parameters and branch lengths are found one after the other, in narrowing intervals, until a round
    adds less than ``tolerance`` to the log-likelihood.
    """
    free, empirical = MODELS[model]

    def fit(key, pdf):
        partition, tree_id = key
        nodes = parse_newick(trees[tree_id])
        rows, weight = list(pdf["pattern"]), pdf["fpatt"].to_numpy()
        tips, freqs = tips_of(nodes, rows), base_frequencies(rows, weight) if empirical else EQUAL
        x = np.concatenate([np.full(free, 2.0 if model != "REV" else 1.0), [0.5] * (classes > 1), np.full(len(nodes) - 1, 0.1)])
        low = np.concatenate([np.full(free, 0.01), [0.02] * (classes > 1), np.full(len(nodes) - 1, 1e-6)])
        high = np.concatenate([np.full(free, 100.0), [50.0] * (classes > 1), np.full(len(nodes) - 1, 20.0)])

        def lnl(x: np.ndarray) -> float:
            rates = discrete_gamma(x[free], classes) if classes > 1 else np.ones(1)
            made = Model(0, freqs, exchange_matrix(model, x[:free], freqs))
            return float(weight @ pattern_lnl(nodes, tips, made, np.concatenate([[0.0], x[free + (classes > 1) :]]), rates))

        x, best, done = ascended(lnl, x, low, high, rounds, tolerance)
        return pd.DataFrame({"partition_id": [partition], "tree_id": [tree_id], "lnl": [best], "parameters": [x[:free].tolist()], "alpha": [x[free] if classes > 1 else None], "tree_length": [x[free + (classes > 1) :].sum()], "rounds": [done], "converged": [done < rounds]})

    each = patterns.withColumn("tree_id", F.explode(F.array(*[F.lit(k) for k in range(len(trees))])))
    return each.groupBy("partition_id", "tree_id").applyInPandas(fit, "partition_id int, tree_id int, lnl double, parameters array<double>, alpha double, tree_length double, rounds int, converged boolean")


def class_lnl(nodes, tips: dict[int, np.ndarray], models: list, lengths: np.ndarray) -> np.ndarray:
    """ln of each pattern's probability in each class (patterns x classes)."""
    one = np.ones(1)
    return np.stack([pattern_lnl(nodes, tips, m, lengths, one) for _, m in models], 1)


def mixed(lnf: np.ndarray, models: list) -> np.ndarray:
    top = lnf.max(1)
    return top + np.log(np.exp(lnf - top[:, None]) @ np.array([share for share, _ in models]))


def fit_codons(patterns: DataFrame, tree: str, models: list[str], code: str = "universal", rounds: int = 40, tolerance: float = 0.01) -> DataFrame:
    """(model, lnl, kappa, shares, omegas, tree_length, rounds, converged, branch_lengths): models of site classes over codon patterns, one fit a group.

    Rows (pattern, fpatt): three characters a taxon. Codon frequencies are those of bases at the three positions.
    Branch lengths are in changes a codon.
    """

    def fit(key, pdf):
        name, nodes = key[0], parse_newick(tree)
        alphabet, _ = codon_steps(code)
        states = [[p[k : k + 3] for k in range(0, len(p), 3)] for p in pdf["pattern"]]
        parts, weight = partials(states, alphabet), pdf["fpatt"].to_numpy()
        tips = {n.node_id: parts[int(n.name) - 1] for n in nodes if not n.sons}
        place = np.full((3, 4), 1e-6)
        for row, w in zip(states, weight, strict=True):
            for codon in row:
                if codon in alphabet:
                    for k in range(3):
                        place[k, BASES.index(codon[k])] += w
        place /= place.sum(1, keepdims=True)
        freqs = np.array([np.prod([place[k, BASES.index(c[k])] for k in range(3)]) for c in alphabet])
        freqs /= freqs.sum()
        bounds = np.array([*SITE_MODELS[name], *[(1e-6, 50.0)] * (len(nodes) - 1)])
        free = len(SITE_MODELS[name])
        start = {"M0": [2, 0.4], "M1a": [2, 0.7, 0.1], "M2a": [2, 0.7, 0.7, 0.1, 2.5], "M3": [2, 0.5, 0.6, 0.1, 0.6, 2.0]}[name]
        lengths = lambda x: np.concatenate([[0.0], x[free:]])

        def lnl(x):
            made = codon_models(name, x, freqs, code)
            return float(weight @ mixed(class_lnl(nodes, tips, made, lengths(x)), made))

        x, best, done = ascended(lnl, np.array([*start, *[0.2] * (len(nodes) - 1)]), bounds[:, 0], bounds[:, 1], rounds, tolerance)
        shares, omegas = zip(*site_classes(name, x), strict=True)
        return pd.DataFrame({"model": [name], "lnl": [best], "kappa": [x[0]], "shares": [list(shares)], "omegas": [list(omegas)], "tree_length": [x[free:].sum()], "rounds": [done], "converged": [done < rounds], "branch_lengths": [lengths(x).tolist()]})

    each = patterns.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    return each.groupBy("model").applyInPandas(fit, "model string, lnl double, kappa double, shares array<double>, omegas array<double>, tree_length double, rounds int, converged boolean, branch_lengths array<double>")


def protein_patterns(codon_patterns: DataFrame, code: str = "universal") -> DataFrame:
    """(pattern, fpatt): codon patterns translated, an X for what is no sense codon, and collapsed again."""
    aa = F.create_map(*[F.lit(x) for c, a in code_of(code).items() if a != "*" for x in (c, a)])
    places = F.sequence(F.lit(1), F.length("pattern") - 2, F.lit(3))
    text = F.array_join(F.transform(places, lambda k: F.coalesce(aa[F.substring("pattern", k, F.lit(3))], F.lit("X"))), "")
    return codon_patterns.select(text.alias("pattern"), "fpatt").groupBy("pattern").agg(F.sum("fpatt").alias("fpatt"))


def fit_proteins(patterns: DataFrame, trees: list[str], exchange: list[list[float]] | None = None, classes: int = 1, rounds: int = 40, tolerance: float = 0.001) -> DataFrame:
    """(tree_id, lnl, alpha, tree_length, rounds, converged) of amino-acid patterns (pattern, fpatt), frequencies as in the data.

    ``exchange`` is a symmetric matrix of rates in the order of AMINO_ACIDS, as ``sources.textfiles.triangle_file`` reads it; without it all are alike.
    """

    def fit(key, pdf):
        nodes, weight = parse_newick(trees[key[0]]), pdf["fpatt"].to_numpy()
        parts = partials([list(p) for p in pdf["pattern"]], list(AMINO_ACIDS))
        tips = {n.node_id: parts[int(n.name) - 1] for n in nodes if not n.sons}
        counts = np.array([sum(w * p.count(a) for p, w in zip(pdf["pattern"], weight, strict=True)) for a in AMINO_ACIDS]) + 1e-6
        made, gamma = protein_model(None if exchange is None else np.array(exchange), counts / counts.sum()), int(classes > 1)

        def lnl(x):
            rates = discrete_gamma(x[0], classes) if gamma else np.ones(1)
            return float(weight @ pattern_lnl(nodes, tips, made, np.concatenate([[0.0], x[gamma:]]), rates))

        size = gamma + len(nodes) - 1
        x, best, done = ascended(lnl, np.array([0.5] * gamma + [0.2] * (size - gamma)), np.array([0.02] * gamma + [1e-6] * (size - gamma)), np.array([50.0] * gamma + [20.0] * (size - gamma)), rounds, tolerance)
        return pd.DataFrame({"tree_id": [key[0]], "lnl": [best], "alpha": [x[0] if gamma else None], "tree_length": [x[gamma:].sum()], "rounds": [done], "converged": [done < rounds]})

    each = patterns.withColumn("tree_id", F.explode(F.array(*[F.lit(k) for k in range(len(trees))])))
    return each.groupBy("tree_id").applyInPandas(fit, "tree_id int, lnl double, alpha double, tree_length double, rounds int, converged boolean")


def all_topologies(taxa: int) -> list[str]:
    """Newick strings of all unrooted topologies, by adding one tip after the other to every branch."""
    trees = [("1", "2", "3")]

    def added(tree, tip):
        if isinstance(tree, tuple):
            for k, part in enumerate(tree):
                for new in added(part, tip):
                    yield (*tree[:k], new, *tree[k + 1 :])
                yield (*tree[:k], (part, tip), *tree[k + 1 :])

    for tip in range(4, taxa + 1):
        trees = [new for tree in trees for new in added(tree, str(tip))]
    text = lambda t: t if isinstance(t, str) else f"({','.join(map(text, t))})"
    return [text(t) for t in trees]


def parsimony_search(patterns: DataFrame, topologies: list[str]) -> DataFrame:
    """(tree, score, best): the changes that each candidate needs over all patterns.

    All candidates are scored in one pass: an array of as many sums as there are trees is built up for a
    block of patterns, and only blocks' sums are added up across tasks. A set of states is four bits, and an array runs over a block's patterns.
    """

    def run(frames):
        parsed = [parse_newick(t) for t in topologies]
        sums = np.zeros(len(parsed), np.int64)
        for pdf in frames:
            if not len(pdf):
                continue
            weight = pdf["fpatt"].to_numpy()
            rows = np.array([list(p) for p in pdf["pattern"]])
            tips = np.full(rows.shape, 15, np.uint8)
            for k, b in enumerate(BASES):
                tips[rows == b] = 1 << k
            for t, nodes in enumerate(parsed):
                sets, costs = {}, np.zeros(len(pdf), np.int64)
                for n in reversed(nodes):
                    if not n.sons:
                        sets[n.node_id] = tips[:, int(n.name) - 1]
                        continue
                    votes = np.stack([sum((sets[s] >> k & 1).astype(np.int64) for s in n.sons) for k in range(4)])
                    most = votes.max(0)
                    sets[n.node_id] = sum(((votes[k] == most).astype(np.uint8) << k for k in range(4)), np.zeros(len(pdf), np.uint8))
                    costs += len(n.sons) - most
                sums[t] += weight @ costs
        yield pd.DataFrame({"place": np.arange(len(parsed)), "score": sums})

    scores = patterns.select("pattern", "fpatt").mapInPandas(run, "place long, score long").groupBy("place").agg(F.sum("score").alias("score"))
    names = patterns.sparkSession.createDataFrame(list(enumerate(topologies)), "place long, tree string")
    found = names.join(scores, "place", "left").select("tree", F.coalesce("score", F.lit(0)).cast("long").alias("score"))
    return found.select("tree", "score", (F.col("score") == F.min("score").over(W.partitionBy(F.lit(1)))).alias("best"))


def dating_chains(pairs: DataFrame, steps: int = 2000, burn_in: int = 500, shape: float = 2.0, rate: float = 10.0, seed: int = 1) -> DataFrame:
    """(i, j, mean, sd, accepted): a Metropolis chain for the distance of each pair (i, j, n, differ), one group each.

    The likelihood is that of JC69 for ``differ`` of ``n`` sites, the prior gamma. Chains are seeded by
    their pair, so that a lost task gives the same again.
    """

    def chain(key, pdf):
        i, j = key
        n, differ = float(pdf["n"].sum()), float(pdf["differ"].sum())
        rng = np.random.default_rng([seed, int(i), int(j)])

        def ln_posterior(t: float) -> float:
            p = 0.75 * -np.expm1(-4 * t / 3)
            return differ * np.log(p) + (n - differ) * np.log1p(-p) + (shape - 1) * np.log(t) - rate * t

        t, kept, accepted = 0.1, [], 0
        now, width = ln_posterior(t), 0.2
        for step in range(burn_in + steps):
            factor = np.exp(width * (rng.random() - 0.5))
            new = ln_posterior(t * factor)
            if np.log(rng.random()) < new - now + np.log(factor):
                t, now, accepted = t * factor, new, accepted + (step >= burn_in)
            if step < burn_in and step % 50 == 49:
                width *= 1.2 if accepted else 1.05
            if step >= burn_in:
                kept.append(t)
        return pd.DataFrame({"i": [i], "j": [j], "mean": [np.mean(kept)], "sd": [np.std(kept)], "accepted": [accepted / steps]})

    return pairs.groupBy("i", "j").applyInPandas(chain, "i int, j int, mean double, sd double, accepted double")


def codon_pair_fits(pairs: DataFrame, code: str = "universal", rounds: int = 3) -> DataFrame:
    """(i, j, lnl, t, kappa, omega): codon distances by likelihood of each pair (i, j, codon_a, codon_b, n), codons equally frequent."""
    from cladeworks.functions.codons import CODONS

    aa = code_of(code)
    sense = [c for c in CODONS if aa[c] != "*"]
    at = {c: k for k, c in enumerate(sense)}
    steps = [(at[a], at[b], {a[k], b[k]} in ({"T", "C"}, {"A", "G"}), aa[a] == aa[b]) for a in sense for b in sense for k in [next((k for k in range(3) if a[k] != b[k]), 0)] if sum(x != y for x, y in zip(a, b, strict=True)) == 1]

    def fit(key, pdf):
        counts = np.zeros((len(sense), len(sense)))
        for a, b, n in zip(pdf["codon_a"], pdf["codon_b"], pdf["n"], strict=True):
            if a in at and b in at:
                counts[at[a], at[b]] += n

        def eigen(kappa, omega):
            q = np.zeros_like(counts)
            for x, y, transition, same in steps:
                q[x, y] = (kappa if transition else 1) * (1 if same else omega)
            np.fill_diagonal(q, -q.sum(1))
            return np.linalg.eigh(q / -np.trace(q) * len(q))

        def lnl(t, parts):
            values, u = parts
            p = (u * np.exp(values * t)) @ u.T / len(sense)
            return float((counts * np.log(np.maximum(p, 1e-300))).sum())

        t, kappa, omega = 0.5, 2.0, 0.5
        for _ in range(rounds):
            parts = eigen(kappa, omega)
            t = golden(lambda x, parts=parts: lnl(x, parts), 1e-4, 20, 12)
            kappa = golden(lambda x, t=t, omega=omega: lnl(t, eigen(x, omega)), 0.1, 50, 12)
            omega = golden(lambda x, t=t, kappa=kappa: lnl(t, eigen(kappa, x)), 1e-3, 20, 12)
        return pd.DataFrame({"i": [key[0]], "j": [key[1]], "lnl": [lnl(t, eigen(kappa, omega))], "t": [t], "kappa": [kappa], "omega": [omega]})

    return pairs.groupBy("i", "j").applyInPandas(fit, "i int, j int, lnl double, t double, kappa double, omega double")
