"""Tree search, joint ancestral states, correlated rates and resampling tests against plain versions."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from test_likelihood import drawn

from cladeworks.functions import scores as sc
from cladeworks.operators import ancestors, fitting, search, treetests

TREE7 = "((1:0.2,2:0.2):0.15,((3:0.2,4:0.2):0.15,5:0.2):0.15,(6:0.2,7:0.2):0.15);"
TRUE7 = search.text_of(search.canonical(search.nested(TREE7))) + ";"


def test_topologies():
    """Every unrooted topology has one form; interchanges are 2 (n - 3), insertions one a branch."""
    forms = {search.text_of(search.canonical(search.nested(t))) for t in fitting.all_topologies(6)}
    assert len(forms) == 105
    assert {search.text_of(search.canonical(search.nested(t))) for t in ("(1,2,(3,4))", "((1,2),3,4)", "(4,(2,1),3)", "((1,2),(3,4))")} == {"(1,2,(3,4))"}
    tree = search.canonical(search.nested(TREE7))
    near = search.neighbours(tree)
    assert len(near) == 2 * (7 - 3) and all(tree in search.neighbours(t) for t in near)
    assert len(search.insertions(tree, "8")) == 2 * 7 - 3 and len(search.mergers(tuple("12345"))) == 10


@pytest.fixture(scope="module")
def seven(spark):
    rows = drawn(sc.Spec("bases", "JC69"), TREE7, [], np.full(4, 0.25), 400)
    return spark.createDataFrame(rows, "pattern string, fpatt long").repartition(4).cache()


@pytest.mark.parametrize("start", ["stepwise", "star", "(((1,6),3),((2,5),4),7);"])
def test_parsimony_search(spark, seven, start):
    """Finds what a look at all 945 topologies finds."""
    every = [search.nested(t) for t in fitting.all_topologies(7)]
    least = min(search.changes_of(seven, every))
    rounds = search.search_trees(seven, 7, start=start).orderBy("round").collect()
    assert -rounds[-1].score == least and sum(r.candidates for r in rounds) < 120
    assert all(b.score >= a.score for a, b in zip(rounds, rounds[1:], strict=False) if b.step == "interchange")
    plain = {search.text_of(search.canonical(search.nested(r.tree))): r.score for r in fitting.parsimony_search(seven, [search.text_of(t) for t in every[:40]]).collect()}
    assert search.changes_of(seven, every[:40]) == [plain[search.text_of(search.canonical(t))] for t in every[:40]]


def test_likelihood_search(spark, seven):
    found = search.search_trees(seven, 7, sc.Spec("bases", "JC69"), start="((1,3),((2,4),5),(6,7));", tolerance=0.05).orderBy("round").collect()
    assert found[-1].tree == TRUE7 and found[-1].score > found[0].score + 10


def test_joint_states(spark):
    """Against all states of the inner nodes of trees with five taxa."""
    tree, spec, freqs = "((1:0.3,2:0.5):0.2,3:0.4,(4:0.3,5:0.6):0.3);", sc.Spec("bases", "HKY85"), [0.1, 0.2, 0.3, 0.4]
    nodes, _ = sc.read_tree(tree)
    lengths = [n.length for n in nodes[1:]]
    rng = np.random.default_rng(1)
    patterns = ["".join(rng.choice(list("TCAG-R"), 5)) for _ in range(40)]
    df = spark.createDataFrame([(p,) for p in dict.fromkeys(patterns)], "pattern string").repartition(3)
    model = spec.classes(np.array([3.0]), np.array(freqs), 1)[0].processes[0]
    inner = [n.node_id for n in nodes if n.sons]
    moves = [None] + [model.p(t) for t in lengths]
    for r in ancestors.joint_states(df, tree, spec, [3.0], freqs, lengths).collect():
        tips = sc.tip_vectors([r.pattern], 5, list("TCAG"))
        found = {}
        for states in product(range(4), repeat=len(inner)):
            at = dict(zip(inner, states, strict=True))
            p = freqs[at[0]]
            for n in nodes[1:]:
                row = moves[n.node_id][at[n.father]]
                p *= row[at[n.node_id]] if n.sons else row @ tips[int(n.name) - 1][0]
            found[states] = p
        # a tip that allows several states is itself set to its best one
        if not set(r.pattern) & set("-R"):
            best = max(found, key=found.get)
            assert r.node_ids == inner and r.states == ["TCAG"[k] for k in best]
            assert np.isclose(r.ln_joint, np.log(found[best])) and np.isclose(r.posterior, found[best] / sum(found.values()))
        assert 0 < r.posterior <= 1 + 1e-9


@pytest.mark.parametrize("tasks", ["1", "8"])
def test_correlated_rates(spark, tasks):
    """Against a loop over sites from end to end, whatever the partitions."""
    rng = np.random.default_rng(2)
    moves, rates = ancestors.class_moves(0.6, 4), [0.1, 0.5, 1.0, 2.4]
    lnf = rng.normal(-50, 2, (500, 4))
    f = np.exp(lnf + 50)
    ahead, now, total = [], np.full(4, 0.25), -50.0 * 500
    for row in f:
        now = (now @ moves) * row
        total += np.log(now.sum())
        now = now / now.sum()
        ahead.append(now)
    back, now = [], np.ones(4)
    for row in f[::-1]:
        back.append(now)
        now = moves @ (row * now)
        now = now / now.sum()
    joint = np.array(ahead) * np.array(back[::-1])
    joint /= joint.sum(1, keepdims=True)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lnl, rows = ancestors.correlated_rates(spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(lnf)], "site int, lnf array<double>"), moves, rates)
        got = {r.site: r for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert abs(lnl - total) < 1e-8 and all(abs(got[k].mean_rate - joint[k] @ rates) < 1e-9 and got[k].best == joint[k].argmax() for k in range(500))


def test_class_moves():
    m = ancestors.class_moves(0.5, 5)
    assert np.allclose(m.sum(0), 1, atol=1e-4) and np.allclose(m, m.T, atol=1e-5) and (np.diag(m) > 0.2).all()
    assert np.allclose(ancestors.class_moves(0.0, 4), 0.25, atol=1e-6)
    rng = np.random.default_rng(1)
    x = rng.normal(size=400_000)
    y = 0.5 * x + np.sqrt(0.75) * rng.normal(size=len(x))
    cuts = np.quantile(x, [0.2, 0.4, 0.6, 0.8])
    seen = np.histogram2d(np.digitize(x, cuts), np.digitize(y, cuts), bins=5)[0]
    assert np.allclose(seen / seen.sum(1, keepdims=True), m, atol=0.01)


@pytest.fixture(scope="module")
def three_trees(spark):
    rng = np.random.default_rng(6)
    lnf = rng.normal(-5, 1, (300, 1)) + rng.normal(0, 0.3, (300, 3)) + np.array([0.0, -0.008, -0.08])
    fpatt = rng.integers(0, 6, 300)
    rows = [(f"p{k}", int(n), row.tolist()) for k, (n, row) in enumerate(zip(fpatt, lnf, strict=True))]
    return lnf, fpatt, spark.createDataFrame(rows, "pattern string, fpatt long, lnf array<double>").repartition(5)


def test_resampling_is_multinomial(spark, three_trees):
    """Totals are exact in each replicate, and means and covariances are those of multinomial counts."""
    lnf, fpatt, df = three_trees
    rows = treetests.resampled_lnl(df, 1500, blocks=16).collect()
    assert {r.sites for r in rows} == {fpatt.sum()} and len(rows) == 4500
    made = np.zeros((1500, 3))
    for r in rows:
        made[r.replicate, r.tree] = r.lnl
    n, p = fpatt.sum(), fpatt / fpatt.sum()
    mean = n * p @ lnf
    cover = n * ((lnf * p[:, None]).T @ lnf - np.outer(p @ lnf, p @ lnf))
    assert np.abs((made.mean(0) - mean) / np.sqrt(np.diag(cover) / 1500)).max() < 4
    assert np.allclose(np.cov(made.T), cover, rtol=0.15)
    assert sorted(map(repr, rows)) == sorted(map(repr, treetests.resampled_lnl(df.repartition(2), 1500, blocks=16).collect()))


def test_tree_test(spark, three_trees):
    lnf, fpatt, df = three_trees
    got = {r.tree: r for r in treetests.tree_test(df, 1500, blocks=16).collect()}
    whole = fpatt @ lnf
    rng = np.random.default_rng(1)
    made = rng.multinomial(fpatt.sum(), fpatt / fpatt.sum(), 4000) @ lnf
    centred, first = made - made.mean(0), whole.argmax()
    for k in range(3):
        behind = whole.max() - whole[k]
        assert np.isclose(got[k].lnl, whole[k]) and np.isclose(got[k].behind, behind)
        assert abs(got[k].p_sh - (centred.max(1) - centred[:, k] >= behind).mean()) < 0.05
        assert abs(got[k].p_kh - (centred[:, first] - centred[:, k] >= behind).mean()) < 0.05
        assert abs(got[k].best_share - (made.argmax(1) == k).mean()) < 0.05
    assert got[first].p_sh == 1 and abs(sum(r.best_share for r in got.values()) - 1) < 1e-9
