"""Scores by branch, fits over blocks of patterns, curvature files, and Bayes empirical Bayes."""

from __future__ import annotations

from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cladeworks.functions import scores as sc
from cladeworks.operators import empirical_bayes as eb
from cladeworks.operators import fitting
from cladeworks.operators import likelihood as lk
from cladeworks.sources import branchfiles as bf

TREE = "((1:0.1,2:0.2)$1:0.05,3#2:0.3,(4:0.1,5:0.4):0.2);"
FREQS = np.array([0.1, 0.2, 0.3, 0.4])


def drawn(spec, tree, x, freqs, sites, seed=1):
    """Counted patterns of sites that are drawn under a model."""
    rng = np.random.default_rng(seed)
    nodes, labels = sc.read_tree(tree)
    classes = spec.classes(np.array(x, float), freqs, max(labels) + 1)
    alphabet = sc.alphabet_of(spec.kind, spec.code)
    kinds = rng.choice(len(classes), sites, p=np.array([c.share for c in classes]) / sum(c.share for c in classes))
    states = {0: rng.choice(len(freqs), sites, p=freqs)}
    for n in nodes[1:]:
        states[n.node_id] = np.empty(sites, int)
        for k, c in enumerate(classes):
            p = np.maximum(c.processes[labels[n.node_id]].p(n.length * c.rate), 0).cumsum(1)
            at = np.flatnonzero(kinds == k)
            states[n.node_id][at] = (rng.random(len(at))[:, None] > p[states[n.father][at]] / p[states[n.father][at]][:, -1:]).sum(1)
    tips = sorted((int(n.name), n.node_id) for n in nodes if not n.sons)
    counts = Counter("".join(alphabet[states[k][i]] for _, k in tips) for i in range(sites))
    return list(counts.items())


def test_labels():
    assert sc.read_tree(TREE)[1] == [0, 1, 1, 1, 2, 0, 0, 0]
    assert sc.read_tree("((1,2 #3)$1,(3,4)$2#1,5);")[1] == [0, 1, 1, 3, 1, 2, 2, 0]


@pytest.mark.parametrize(("spec", "labelled"), [(sc.Spec("bases", "HKY85", 4), False), (sc.Spec("codons", "A"), True), (sc.Spec("codons", "M8"), False), (sc.Spec("codons", "D"), True), (sc.Spec("proteins", "equal"), False)])
def test_derivatives_against_differences(spec, labelled):
    rng = np.random.default_rng(1)
    nodes, labels = sc.read_tree(TREE)
    labels = labels if labelled else [0] * len(nodes)
    alphabet = sc.alphabet_of(spec.kind)
    freqs = FREQS if spec.kind == "bases" else rng.dirichlet(np.ones(len(alphabet)) * 5)
    patterns = ["".join(rng.choice(alphabet) for _ in range(5)) for _ in range(6)] + [len(alphabet[0]) * 5 * "-"]
    tips, x = sc.tip_vectors(patterns, 5, alphabet), spec.parameters(max(labels) + 1)[1]
    classes = spec.classes(x, freqs, max(labels) + 1)
    t = np.array([0.0] + [n.length for n in nodes[1:]])
    f = lambda t, derive=False: sc.mixture(nodes, tips, labels, t, classes, derive)
    lnf, d, dd, _ = f(t, True)
    assert abs(lnf[-1]) < 1e-9
    for k in range(1, len(nodes)):
        step = np.eye(len(nodes))[k] * 1e-4
        high, low = f(t + step)[0], f(t - step)[0]
        assert np.allclose(d[:, k - 1], (high - low) / 2e-4, rtol=1e-4, atol=1e-5)
        assert np.allclose(dd[:, k - 1], (high + low - 2 * lnf) / 1e-8, rtol=1e-3, atol=1e-3)


def test_many_taxa_do_not_underflow():
    """A caterpillar of 800 taxa, whose probabilities are far below the smallest double."""
    text = "1:0.5"
    for k in range(2, 800):
        text = f"({text},{k}:0.5):0.5"
    nodes, labels = sc.read_tree(f"({text},800:0.5);")
    tips = sc.tip_vectors(["TCAG" * 200], 800, list("TCAG"))
    lnf, d, _, _ = sc.mixture(nodes, tips, labels, np.array([0.0] + [0.5] * (len(nodes) - 1)), sc.Spec().classes(np.zeros(0), np.full(4, 0.25), 1))
    assert -2000 < lnf[0] < -800 and np.isfinite(d).all()


def test_blocks_give_the_grouped_optimum(spark):
    """Eight blocks of two loci's patterns reach what one group a locus reaches."""
    spec = sc.Spec("bases", "HKY85", 4)
    rows = [(locus, p, n) for locus in (0, 1) for p, n in drawn(spec, TREE, [3.0, 0.6], FREQS, 3000, locus)]
    df = spark.createDataFrame(rows, "locus int, pattern string, fpatt long").repartition(8)
    found = {r.locus: r for r in lk.fit_blocks(df, TREE.replace("$1", "").replace("#2", ""), spec).collect()}
    plain = fitting.fit_trees(df.withColumnRenamed("locus", "partition_id"), ["((1,2),3,(4,5));"], "HKY85", 4, tolerance=1e-3).collect()
    assert set(found) == {0, 1} and all(r.converged for r in found.values())
    for r in plain:
        assert found[r.partition_id].lnl > r.lnl - 0.02 and abs(found[r.partition_id].lnl - r.lnl) < 0.3
        assert abs(found[r.partition_id].parameters[0] - r.parameters[0]) < 0.1
    assert abs(found[0].parameters[0] - 3) < 0.6 and np.allclose(found[0].branch_lengths, [0.05, 0.1, 0.2, 0.3, 0.2, 0.1, 0.4], atol=0.06)


LABELLED = "((1:0.3,2:0.4):0.2,3#1:1.2,(4:0.3,5:0.5):0.3);"


def test_branch_and_site_omegas_come_back(spark):
    """The two-ratio model and branch-site model A, drawn and fitted; each is better than the model within it."""
    freqs = np.random.default_rng(3).dirichlet(np.ones(61) * 8)
    two = spark.createDataFrame(drawn(sc.Spec("codons", "branch"), LABELLED, [2.0, 0.15, 2.0], freqs, 1500), "pattern string, fpatt long")
    wide = lk.fit_blocks(two, LABELLED, sc.Spec("codons", "branch"), tolerance=1e-3).first()
    one = lk.fit_blocks(two, LABELLED.replace("#1", ""), sc.Spec("codons", "M0"), tolerance=1e-3).first()
    kappa, background, foreground = wide.parameters
    assert abs(kappa - 2) < 0.4 and abs(background - 0.15) < 0.04 and 1.3 < foreground < 3.2 and wide.lnl > one.lnl + 10
    truth = [2.0, 0.6, 0.7, 0.1, 8.0]
    sites = spark.createDataFrame(drawn(sc.Spec("codons", "A"), LABELLED, truth, freqs, 1500, 2), "pattern string, fpatt long")
    wide = lk.fit_blocks(sites, LABELLED, sc.Spec("codons", "A"), tolerance=1e-2).first()
    null = lk.fit_blocks(sites, LABELLED, sc.Spec("codons", "A_null"), tolerance=1e-2).first()
    assert wide.lnl > null.lnl + 5 and abs(wide.parameters[3] - 0.1) < 0.05 and 4 < wide.parameters[4] < 16 and abs(wide.parameters[1] - 0.6) < 0.15


def test_clade_and_beta_models():
    """Shares add up, and time has one scale on each kind of branch."""
    freqs = np.random.default_rng(4).dirichlet(np.ones(61) * 8)
    for model in sc.CODON_MODELS:
        x = sc.codon_parameters(model, 3)[1]
        classes = sc.codon_classes(model, x, freqs, 3)
        assert abs(sum(c.share for c in classes) - 1) < 1e-9
        for k in range(3):
            pace = 0.0
            for c in classes:
                m = c.processes[k]
                pace -= c.share * freqs @ np.diag((m.left * m.values) @ m.right)
            assert abs(pace - 1) < 1e-9
    assert np.allclose(sc.beta_quantiles(1, 1, 10), (np.arange(10) + 0.5) / 10, atol=1e-3)
    assert np.allclose(sc.beta_quantiles(2, 1, 4), np.sqrt((np.arange(4) + 0.5) / 4), atol=1e-3)
    assert np.allclose(sc.beta_quantiles(0.5, 0.5, 4), np.sin(np.pi / 2 * (np.arange(4) + 0.5) / 4) ** 2, atol=2e-3)


@pytest.fixture(scope="module")
def curved(spark):
    spec = sc.Spec("bases", "K80")
    rows = [(locus, p, n) for locus in (0, 1) for p, n in drawn(spec, TREE, [3.0], np.full(4, 0.25), 20_000, locus)]
    df = spark.createDataFrame(rows, "locus int, pattern string, fpatt long")
    found = lk.branch_curvature(df, TREE.replace("$1", "").replace("#2", ""), spec)
    return rows, spark.createDataFrame(found.collect(), found.schema)


def test_curvature(curved):
    """At the maximum the slope is flat and the products of scores are near the second differences."""
    rows, found = curved
    for r in found.collect():
        nodes, labels = sc.read_tree(r.tree)
        mine = [(p, n) for locus, p, n in rows if locus == r.locus]
        tips, w = sc.tip_vectors([p for p, _ in mine], 5, list("TCAG")), np.array([n for _, n in mine])
        classes = sc.Spec("bases", "K80").classes(np.array([3.0]), np.full(4, 0.25), 1)
        _, _, dd, _ = sc.mixture(nodes, tips, labels, np.array([0.0, *r.b]), classes)
        assert r.taxa == 5 and np.abs(r.g).max() < 5 and np.allclose(np.diag(r.h), w @ dd, rtol=0.1)
        assert np.allclose(r.h, np.array(r.h).T) and np.allclose(r.b, [0.05, 0.1, 0.2, 0.3, 0.2, 0.1, 0.4], atol=0.02)


@pytest.mark.parametrize("parts", [1, 5])
def test_curvature_file(spark, curved, parts):
    """Written, split into lines anywhere, and read back; blocks that are cut short or miscounted are told."""
    texts = bf.branch_file_text(curved[1])
    whole = "\n".join(r.text for r in texts.orderBy("locus").collect())
    wrapped = whole.replace("  ", "\n", 3)
    rows = [(k, i, line) for k, text in enumerate([whole, wrapped, whole.replace(" 5\n", " 6\n", 1), whole[: len(whole) - 40], ""]) for i, line in enumerate(text.split("\n"))]
    found = bf.branch_file(spark.createDataFrame(rows, "file_id int, line_no int, line string").repartition(parts)).collect()
    assert sorted((r.file_id, r.locus, r.complete) for r in found) == [(0, 1, True), (0, 2, True), (1, 1, True), (1, 2, True), (2, 1, False), (2, 2, True), (3, 1, True), (3, 2, False)]
    want = {r.locus + 1: r for r in curved[1].collect()}
    for r in found:
        if r.complete:
            w = want[r.locus]
            assert r.taxa == 5 and r.tree == w.tree and np.allclose(r.b, w.b, rtol=1e-9) and np.allclose(r.g, w.g, rtol=1e-9) and np.allclose(r.h, w.h, rtol=1e-9)


@pytest.mark.parametrize("kind", ["sqrt", "log", "arcsin"])
def test_transforms(spark, kind):
    """The quadratic in u agrees with the one in b up to the third order."""
    b, g, h = [0.1, 0.4], [30.0, -20.0], [[-500.0, 100.0], [100.0, -300.0]]
    df = spark.createDataFrame([(1, b, g, h)], "locus int, b array<double>, g array<double>, h array<array<double>>")
    back = {"sqrt": lambda u: u**2, "log": np.exp, "arcsin": lambda u: -0.75 * np.log(1 - np.sin(u / 2) ** 2 / 0.75)}[kind]
    made = bf.transformed(df, kind)
    u = np.array(made.first().b)
    assert np.allclose(back(u), b)
    moves = [np.array(z) * s for s in (1e-3, 5e-4) for z in ((1, 0), (0, 1), (1, -1))]
    rows = spark.createDataFrame([(1, k, (u + z).tolist()) for k, z in enumerate(moves)], "locus int, sample int, x array<double>")
    got = {r.sample: r.lnl for r in bf.approximate_lnl(made, rows).collect()}
    for k, z in enumerate(moves):
        d = back(u + z) - b
        assert abs(got[k] - (d @ g + d @ np.array(h) @ d / 2)) < 2e4 * np.abs(z).max() ** 3


def test_empirical_bayes(spark):
    """Against loops over sites, grid points and classes."""
    rng = np.random.default_rng(5)
    omegas = np.array([0.1, 0.6, 1.0, 2.0, 6.0])
    shares = rng.dirichlet(np.ones(5), 12)
    shares[:, 1] = 0
    shares /= shares.sum(1, keepdims=True)
    lnf = rng.normal(-700, 3, (40, 5))
    fpatt = rng.integers(1, 5, 40)
    df = spark.createDataFrame([(k, int(n), row.tolist()) for k, (n, row) in enumerate(zip(fpatt, lnf, strict=True))], "site int, fpatt long, lnf array<double>").repartition(3)
    f = np.exp(lnf + 700)
    whole = np.array([sum(n * np.log(s @ row) for n, row in zip(fpatt, f, strict=True)) for s in shares])
    weight = np.exp(whole - whole.max()) / np.exp(whole - whole.max()).sum()
    got = {r.site: r for r in eb.empirical_bayes(df, ["site"], omegas, shares).collect()}
    for k, row in enumerate(f):
        p = sum(w * s * row / (s @ row) for w, s in zip(weight, shares, strict=True))
        mean = p @ omegas
        assert np.allclose((got[k].p_positive, got[k]["mean"], got[k].sd), (p[3:].sum(), mean, np.sqrt(p @ omegas**2 - mean**2)))
    assert eb.empirical_bayes(df.limit(0), ["site"], omegas, shares).count() == 0


def test_grids():
    corners = eb.share_grid(10)
    assert corners.shape == (100, 3) and np.allclose(corners.sum(1), 1) and corners.min() > 0 and np.allclose(corners.mean(0), 1 / 3)
    for omegas, shares in (eb.grid_m2a(), eb.grid_m8()):
        assert len(shares) == 10_000 and shares.shape[1] == len(omegas) and np.allclose(shares.sum(1), 1)


def test_selected_sites_are_found(spark):
    """Sites drawn with omega 6 stand out from those with omega 0.1 or 1."""
    tree = "((1:0.6,2:0.6):0.3,(3:0.6,4:0.6):0.3,(5:0.6,6:0.6):0.3);"
    freqs = np.full(61, 1 / 61)
    truth = {w: drawn(sc.Spec("codons", "M0"), tree, [2.0, w], freqs, n, int(w * 10)) for w, n in ((0.1, 300), (1.0, 60), (6.0, 150))}
    counts = Counter()
    for rows in truth.values():
        counts.update(dict(rows))
    df = spark.createDataFrame(list(counts.items()), "pattern string, fpatt long")
    nodes, _ = sc.read_tree(tree)
    omegas, shares = eb.grid_m2a(5)
    lnf = eb.omega_lnf(df, tree, 2.0, freqs.tolist(), [n.length for n in nodes[1:]], omegas.tolist(), ("M2a", [2.0, 0.6, 0.3, 0.1, 6.0]))
    p = {r.pattern: r.p_positive for r in eb.empirical_bayes(lnf, ["pattern"], omegas, shares).collect()}
    mean = {w: np.average([p[x] for x, _ in rows], weights=[n for _, n in rows]) for w, rows in truth.items()}
    assert mean[6.0] > 0.55 and mean[0.1] < 0.25 and mean[6.0] > mean[1.0] + 0.1 > mean[0.1] + 0.1


def test_site_classes_of_a_fit(spark):
    patterns = spark.createDataFrame([("".join(x), 1) for x in product("TC", repeat=3)], "pattern string, fpatt long")
    rows = lk.site_class_lnf(patterns, "(1:0.1,2:0.2,3:0.3);", sc.Spec("bases", "JC69", 4), [0.5], [0.25] * 4, [0.1, 0.2, 0.3]).collect()
    assert len(rows) == 8 and all(len(r.lnf) == 4 and np.allclose(r.shares, 0.25) for r in rows)


@pytest.mark.parametrize(("spec", "tree"), [(sc.Spec("codons", "A"), "((1,2)#1,(3,4),5);"), (sc.Spec("bases", "HKY85", 4), "((1,2)#1,((3,4),5));"), (sc.Spec("bases", "NH"), "(((1,2)$1,(3,4)),5);")])
def test_sums_over_parts_are_those_over_patterns(spec, tree):
    """Parts that patterns share are moved once; log-likelihood and gradient are those of whole patterns, unknown characters too."""
    rng = np.random.default_rng(3)
    nodes, labels = sc.read_tree(tree)
    alphabet = sc.alphabet_of(spec.kind)
    some = [*alphabet[:6], len(alphabet[0]) * "-"] if spec.kind == "codons" else [*alphabet, "-", "Y"]
    part = pd.DataFrame({"pattern": ["".join(rng.choice(some, 5)) for _ in range(300)], "fpatt": rng.integers(1, 5, 300)})
    point = lk.Point(tree, rng.dirichlet(np.ones(len(alphabet)) * 5), spec.parameters(max(labels) + 1)[1], rng.random(len(nodes) - 1) + 0.05)
    lnf, scores, weight = lk.scores_of(spec, point, part)
    tips = sc.tip_vectors(list(part["pattern"]), 5, alphabet)
    whole = sc.mixture(nodes, tips, labels, np.concatenate([[0.0], point.lengths]), spec.classes(point.parameters, point.freqs, max(labels) + 1))
    assert np.allclose(lnf, whole[0])
    assert np.allclose(lk.slopes_of(spec, point, part), np.concatenate([[weight @ lnf], weight @ scores]), rtol=1e-6, atol=1e-5)
    assert np.allclose(weight @ whole[1], (weight @ scores)[len(point.parameters) :])
    assert max(len(r) for r in sc.shared_parts(nodes, list(part["pattern"]), alphabet).rows[1:] if r is not None) < 300


def test_patterns_are_dealt_over_all_cores(spark):
    """Few bytes but much work: adaptive execution doesn't put them in one task."""
    patterns = spark.range(400).select(F.concat(F.lit("TTTCCC"), F.lpad(F.conv(F.col("id").cast("string"), 10, 4), 6, "0")).alias("pattern"), F.lit(1).cast("long").alias("fpatt"))
    sizes = [r["count"] for r in lk.spread(patterns).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 200
