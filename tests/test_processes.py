"""Processes that aren't reversible or not the same everywhere, and smoothed rates."""

from __future__ import annotations

import numpy as np
import pytest
from test_likelihood import drawn

from cladeworks.functions import scores as sc
from cladeworks.operators import likelihood as lk
from cladeworks.operators.smoothing import smoothed_rates

def test_lifted_ancestors(spark):
    """A ladder of 300 nodes, two random trees, and a node that is its own ancestor."""
    from cladeworks.operators.trees import Lifted

    rng = np.random.default_rng(4)
    father = {0: None, 1000: None} | {k: k - 1 for k in range(1, 300)} | {1000 + k: 1000 + int(rng.integers(0, k)) for k in range(1, 200)}
    length = {k: float(rng.uniform(0, 1)) for k in father}
    nodes = spark.createDataFrame([(k, f, length[k]) for k, f in father.items()], "node_id long, father_id long, branch_length double")

    def path(k):
        out = [k]
        while father[out[-1]] is not None:
            out.append(father[out[-1]])
        return out

    pairs = [(int(a), int(b)) for a, b in rng.choice(sorted(father), (150, 2))] + [(5, 5), (0, 299), (1000, 1000)]
    got = {(r.a, r.b): r for r in Lifted(nodes).mrca(spark.createDataFrame(pairs, "a long, b long")).collect()}
    for a, b in pairs:
        x, y = path(a), path(b)
        common = next((k for k in x if k in set(y)), None)
        assert ((a, b) in got) == (common is not None)
        if common is not None:
            assert got[a, b].mrca == common and abs(got[a, b].distance - sum(length[k] for k in set(x) ^ set(y))) < 1e-9
    with pytest.raises(ValueError):
        Lifted(spark.createDataFrame([(1, 2, 0.1), (2, 3, 0.1), (3, 1, 0.1)], "node_id long, father_id long, branch_length double"))


UNREST = [1.0, 0.4, 2.0, 0.5, 0.8, 0.2, 3.0, 0.6, 1.5, 0.3, 2.5]


def lnl_at(spec, x, freqs, left):
    """Two tips at the ends of a path of length 0.8, the root so far from the first."""
    nodes, labels = sc.read_tree("(1,2);")
    tips = sc.tip_vectors(["TC", "AG", "TT", "CA"], 2, list("TCAG"))
    return sc.mixture(nodes, tips, labels, np.array([0.0, left, 0.8 - left]), spec.classes(np.array(x), freqs, 1), derive=False)[0].sum()


def test_pulley():
    """A reversible process doesn't tell where the root is; these do."""
    freqs = np.array([0.1, 0.2, 0.3, 0.4])
    assert lnl_at(sc.Spec("bases", "HKY85"), [2.0], freqs, 0.1) == pytest.approx(lnl_at(sc.Spec("bases", "HKY85"), [2.0], freqs, 0.6))
    assert abs(lnl_at(sc.Spec("bases", "UNREST"), UNREST, freqs, 0.1) - lnl_at(sc.Spec("bases", "UNREST"), UNREST, freqs, 0.6)) > 1e-3
    skewed = [2.0, 3.0, 1.0, 1.0, 0.3, 2.0, 1.0]
    assert abs(lnl_at(sc.Spec("bases", "NH"), skewed, freqs, 0.1) - lnl_at(sc.Spec("bases", "NH"), skewed, freqs, 0.6)) > 1e-3
    # with reversible rates the general process is the special one
    same = sc.General(np.array([[-3, 1, 1, 1], [1, -3, 1, 1], [1, 1, -3, 1], [1, 1, 1, -3.0]]))
    assert np.allclose(same.p(0.3)[0], [0.25 + 0.75 * np.exp(-0.4)] + [0.25 - 0.25 * np.exp(-0.4)] * 3) and np.allclose(same.freqs, 0.25)


@pytest.mark.parametrize("model", ["UNREST", "NH"])
def test_derivatives(model):
    nodes, labels = sc.read_tree("((1:0.1,2:0.3)#1:0.2,3:0.4);")
    spec = sc.Spec("bases", model)
    x = spec.parameters(2)[1] * np.linspace(0.5, 1.5, len(spec.parameters(2)[1]))
    tips = sc.tip_vectors(["TCA", "GGA", "TTT", "CAC"], 3, list("TCAG"))
    f = lambda t, d=False: sc.mixture(nodes, tips, labels, t, spec.classes(x, np.full(4, 0.25), 2), d)
    t = np.array([0.0] + [n.length for n in nodes[1:]])
    _, d, dd, _ = f(t, True)
    for k in range(1, len(nodes)):
        step = np.eye(len(nodes))[k] * 1e-4
        assert np.allclose(d[:, k - 1], (f(t + step)[0] - f(t - step)[0]) / 2e-4, atol=1e-5)
        assert np.allclose(dd[:, k - 1], (f(t + step)[0] + f(t - step)[0] - 2 * f(t)[0]) / 1e-8, atol=1e-3)


ROOTED = "((1:0.3,2:0.3)$1:0.3,(3:0.3,4:0.3):0.3);"


def test_frequencies_that_drift_apart_come_back(spark):
    """Two clades with their own frequencies, drawn and fitted; a homogeneous model is far worse."""
    truth = [2.0, 1.0, 1.0, 1.0, 4.0, 6.0, 6.0, 1.0, 1.0, 1.0, 1.0]
    rows = drawn(sc.Spec("bases", "NH"), ROOTED, truth, np.full(4, 0.25), 20_000)
    df = spark.createDataFrame(rows, "pattern string, fpatt long")
    found = lk.fit_blocks(df, ROOTED, sc.Spec("bases", "NH"), tolerance=1e-2).first()
    plain = lk.fit_blocks(df, ROOTED.replace("$1", ""), sc.Spec("bases", "HKY85"), tolerance=1e-2).first()
    assert found.lnl > plain.lnl + 100
    assert np.allclose(sc.shares_of(np.array(found.parameters[1:4])), 0.25, atol=0.05)
    assert np.allclose(sc.shares_of(np.array(found.parameters[5:8])), np.array([6, 6, 1, 1]) / 14, atol=0.06)
    assert np.allclose(sc.shares_of(np.array(found.parameters[8:11])), 0.25, atol=0.08)


def test_unrestricted_rates_come_back(spark):
    still = sc.general_class("UNREST", np.array(UNREST), 1).processes[0].freqs
    rows = drawn(sc.Spec("bases", "UNREST"), ROOTED.replace("$1", ""), UNREST, still, 20_000)
    df = spark.createDataFrame(rows, "pattern string, fpatt long")
    found = lk.fit_blocks(df, ROOTED.replace("$1", ""), sc.Spec("bases", "UNREST"), tolerance=1e-4).first()
    rev = lk.fit_blocks(df, ROOTED.replace("$1", ""), sc.Spec("bases", "REV"), tolerance=1e-2).first()
    nodes, _ = sc.read_tree(ROOTED.replace("$1", ""))
    truth = lk.Point(ROOTED.replace("$1", ""), np.full(4, 0.25), np.array(UNREST), np.array([n.length for n in nodes[1:]]))
    at_truth = lk.evaluated(lk.spread(df), sc.Spec("bases", "UNREST"), {0: truth})[0][0]
    assert found.lnl > rev.lnl + 20 and at_truth - 0.1 < found.lnl < at_truth + 20
    want = sc.general_class("UNREST", np.array(UNREST), 1).processes[0]
    got = sc.general_class("UNREST", np.array(found.parameters), 1).processes[0]
    assert np.allclose(got.p(0.5), want.p(0.5), atol=0.04) and np.allclose(got.freqs, want.freqs, atol=0.03)


def test_smoothed_rates(spark):
    """Against the dense equations; a clock gives one rate; a heavy penalty the weighted mean."""
    rng = np.random.default_rng(3)
    rows, n = [], 40
    for tree in (0, 1):
        for k in range(1, n):
            span = float(rng.uniform(0.1, 1))
            rate = 0.3 if tree else float(rng.uniform(0.1, 0.9))
            rows.append((tree, k, int(rng.integers(0, k)), rate * span, span, float(rng.uniform(0.01, 0.1))))
    rows.append((2, 1, 0, None, 0.5, 0.1))
    df = spark.createDataFrame(rows, "tree_id int, node_id int, father_id int, length double, span double, variance double")
    got = {(r.tree_id, r.node_id): r.rate for r in smoothed_rates(df, 5.0).collect()}
    assert all(abs(got[1, k] - 0.3) < 1e-9 for k in range(1, n)) and got[2, 1] is None
    m, v = np.zeros((n, n)), np.zeros(n)
    for tree, k, f, b, t, var in rows:
        if tree == 0:
            m[k, k] += t * t / var + 5
            v[k] += t * b / var
            m[f, f] += 5
            m[f, k] -= 5
            m[k, f] -= 5
    want = np.linalg.solve(m, v)
    assert all(abs(got[0, k] - want[k]) < 1e-9 for k in range(1, n))
    heavy = {r.node_id: r.rate for r in smoothed_rates(df.where("tree_id = 0"), 1e9).collect()}
    mean = sum(t * b / var for tree, _, _, b, t, var in rows if tree == 0) / sum(t * t / var for tree, _, _, _, t, var in rows if tree == 0)
    assert all(abs(r - mean) < 1e-3 for r in heavy.values())
