"""Calibrations, priors of ages, chains, and runs that are stopped and resumed."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeworks.functions import dating as fd
from cladeworks.operators import dating
from cladeworks.sources.newick import parse_newick

ROOTED = "((((A,B),C)'B(0.4, 0.6)',D),E)'B(0.95, 1.05)';"
CALIBRATIONS = [
    ("L", [0.5]), ("L", [0.5, 0.2, 0.5, 0.05]), ("U", [2.0]), ("U", [2.0, 0.1]), ("B", [0.5, 1.5]), ("B", [0.5, 1.5, 0.1, 0.01]), ("G", [20.0, 10.0]),
    ("SN", [1.0, 0.2, 3.0]), ("ST", [1.0, 0.2, -2.0, 5.0]), ("S2N", [0.3, 1.0, 0.2, 3.0, 2.0, 0.1, 0.0]),
]


@pytest.mark.parametrize(("kind", "numbers"), CALIBRATIONS)
def test_calibrations_are_densities(kind, numbers):
    """They add up to one, with a heavy tail for the Cauchy curve, and bounds have the masses asked for outside."""
    u = (np.arange(40_000) + 0.5) / 40_000
    t = u / (1 - u)
    y = np.array([np.exp(fd.ln_calibration(x, kind, numbers)) for x in t]) / (1 - u) ** 2 / len(u)
    assert abs(y.sum() - 1) < 0.01
    if kind == "B":
        below, above = [*numbers, 0.025, 0.025][2:4] if len(numbers) == 4 else (0.025, 0.025)
        assert abs(y[t < numbers[0]].sum() - below) < 0.003 and abs(y[t > numbers[1]].sum() - above) < 0.003


@pytest.mark.parametrize(("birth", "death", "sampling"), [(1.0, 1.0, 0.1), (2.0, 0.5, 0.4), (1.0, 2.0, 1.0)])
def test_kernel(birth, death, sampling):
    k = fd.BirthDeath(1.5, birth, death, sampling)
    t = (np.arange(20_000) + 0.5) / 20_000 * 1.5
    density = np.exp([k.ln_density(x) for x in t]) * 1.5 / 20_000
    assert abs(density.sum() - 1) < 1e-6 and abs(density[: 8000].sum() - k.cdf(0.6)) < 1e-4 and abs(k.cdf(1.5) - 1) < 1e-12


def test_default_numbers_and_texts(spark):
    assert dating.calibrated_nodes(spark, ROOTED) == {0: ("B", [0.95, 1.05]), 2: ("B", [0.4, 0.6])} or set(dating.calibrated_nodes(spark, ROOTED)) == {0, 2}
    found = dating.calibrated_nodes(spark, "((A,B)'>0.06<0.08',(C,D)'@0.5')'L(0.1)';")
    assert sorted(found.values()) == [("B", [0.06, 0.08]), ("L", [0.1]), ("fixed", [0.5])]


def chain(tree, prior, loci=(), use_data=False, **calibrated):
    rows = {int(k[1:]): v for k, v in calibrated.items()}
    c = fd.Chain(tree, rows, list(loci), prior, use_data)
    return c, c.start([3])


def test_prior_alone_follows_the_bounds():
    """Both nodes have bounds that don't touch: their ages are flat between them, with tails of five per cent."""
    c, state = chain("((A,B),C);", fd.Prior(), n0=("B", [2.0, 3.0]), n1=("B", [0.5, 1.0]))
    c.run(state, 2000, 0, True)
    ages = np.array([s["ages"] for s in c.run(state, 60_000, 10, False)])
    for k, (low, high) in enumerate([(2.0, 3.0), (0.5, 1.0)]):
        inside = (ages[:, k] > low) & (ages[:, k] < high)
        assert abs(inside.mean() - 0.95) < 0.02 and abs(ages[inside, k].mean() - (low + high) / 2) < 0.03
        assert abs(np.median(ages[:, k]) - (low + high) / 2) < 0.04


def test_free_ages_follow_the_kernel():
    """Two free ages, one above the other, are order statistics of the kernel."""
    prior = fd.Prior(birth=2.0, death=0.5, sampling=0.4)
    c, state = chain("(((A,B),C),D);", prior, n0=("B", [0.999, 1.001]))
    c.run(state, 2000, 0, True)
    found = c.run(state, 60_000, 10, False)
    kernel = fd.BirthDeath(1.0, 2.0, 0.5, 0.4)
    shares = np.array([[kernel.cdf(min(x, 1.0)) for x in s["ages"][1:]] for s in found])
    assert abs(shares[:, 0].mean() - 2 / 3) < 0.03 and abs(shares[:, 1].mean() - 1 / 3) < 0.03


TRUE_AGES = {0: 1.0, 1: 0.8, 2: 0.5, 3: 0.2}
UNROOTED = "(((A,B),C),D,E);"


def loci_rows(rates, precision=4e6):
    """(dataset, locus, tree, b, g, h): branch lengths that true ages and rates give, known up to a narrow bell."""
    rooted, unrooted = parse_newick(ROOTED), parse_newick(UNROOTED)
    spans = [TRUE_AGES[n.father] - TRUE_AGES.get(n.node_id, 0.0) for n in rooted[1:]]
    out = []
    for k, rate in enumerate(rates):
        at = {s: i for i, s in fd.named_splits(unrooted, "A").items()}
        b = np.zeros(len(unrooted) - 1)
        for n, span in zip(rooted[1:], spans, strict=True):
            b[at[fd.named_splits(rooted, "A")[n.node_id]] - 1] += span * rate
        out.append((0, k, UNROOTED, b.tolist(), [0.0] * len(b), (-precision * np.eye(len(b))).tolist()))
    return out


@pytest.fixture(scope="module")
def blocks(spark):
    return spark.createDataFrame(loci_rows([0.1, 0.3]), "dataset int, locus int, tree string, b array<double>, g array<double>, h array<array<double>>")


@pytest.mark.parametrize("clock", [1, 2, 3])
def test_ages_come_back(spark, blocks, tmp_path, clock):
    prior = fd.Prior(clock=clock, variance=(1.0, 100.0), transform=("arcsin", "sqrt", "none")[clock - 1])
    found = dating.dating_samples(blocks, ROOTED, str(tmp_path), prior, burn_in=600, samples=450, every=2, versions=2)
    rows = {r.node_id: r for r in dating.age_summary(found, ROOTED).collect()}
    assert set(rows) == {0, 1, 2, 3} and all(r.n == 900 for r in rows.values())
    for node, age in TRUE_AGES.items():
        assert abs(rows[node]["mean"] - age) < (0.05 if clock == 1 else 0.12) * max(age, 0.3)
    means = found.groupBy().agg(F.avg(F.get("means", F.lit(0))).alias("a"), F.avg(F.get("means", F.lit(1))).alias("b")).first()
    assert abs(means.a / 0.1 - 1) < 0.25 and abs(means.b / 0.3 - 1) < 0.25
    text = dating.dated_tree(dating.age_summary(found, ROOTED), ROOTED).first().newick
    assert text.endswith(";") and text.count("[&95%HPD=") == 4 and abs(float(text.split("E: ")[1].split(")")[0]) - 1.0) < 0.06


def test_resumed_equals_unbroken(spark, blocks, tmp_path):
    options = {"burn_in": 60, "samples": 40, "every": 3, "versions": 3, "chains": 3}
    whole = dating.dating_samples(blocks, ROOTED, f"{tmp_path}/whole", **options).collect()
    dating.dating_samples(blocks, ROOTED, f"{tmp_path}/parts", **options, stop_after=2)
    (tmp_path / "parts" / "version=00002").mkdir()  # as a run that was killed while it wrote leaves it
    parts = dating.dating_samples(blocks, ROOTED, f"{tmp_path}/parts", **options).collect()
    assert len(whole) == 3 * 40 and sorted(map(repr, whole)) == sorted(map(repr, parts))
    assert len({r.ages[0] for r in whole}) > 60


def test_fixed_age_and_missing_root(spark, blocks, tmp_path):
    tree = "((((A,B),C)'@0.5',D),E)'B(0.9, 1.1)';"
    found = dating.dating_samples(blocks, tree, str(tmp_path), burn_in=50, samples=20, every=2, versions=2)
    assert {r.ages[2] for r in found.collect()} == {0.5}
    with pytest.raises(ValueError, match="root"):
        dating.dating_samples(blocks, UNROOTED, str(tmp_path))
