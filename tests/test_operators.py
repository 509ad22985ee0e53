"""Operators on small hand-made data: invariants, closed forms and published values."""

from __future__ import annotations

from itertools import product
from math import exp, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeworks.functions import codons as cd
from cladeworks.functions.substitution import Model, discrete_gamma, gamma_cdf, pattern_lnl, tips_of
from cladeworks.operators import alignment as al
from cladeworks.operators import fitting, pairwise, placements, resampling, samples, trees
from cladeworks.sources.newick import parse_newick, to_newick, tree_rows
from cladeworks.sources.sequences import parse_alignment, parse_control, phylip_lines, read_alignments


def cells(spark, seqs):
    rows = [(k + 1, i + 1, c) for k, s in enumerate(seqs) for i, c in enumerate(s)]
    return spark.createDataFrame(rows, "taxon_id int, site long, state string")


def test_pattern_counts_sum_to_sites(spark):
    found = al.site_patterns(cells(spark, ["TTCAG-", "TTCAGA", "TTTAGA"])).collect()
    assert sum(r.fpatt for r in found) == 6 and {r.pattern: r.fpatt for r in found}["TTT"] == 2


def test_canonical_pattern(spark):
    rows = spark.createDataFrame([("CCAT",), ("GG-A",), ("TCAG",), ("NTTA",)], "pattern string")
    got = [r[0] for r in rows.select(al.canonical_pattern(F.col("pattern"))).collect()]
    assert got == ["TTCA", "TT-C", "TCAG", "NTTA"]


def test_empty_alignment(spark):
    none = cells(spark, []) if False else spark.createDataFrame([], "taxon_id int, site long, state string")
    assert al.site_patterns(none).count() == 0 and al.clean_sites(none).count() == 0 and pairwise.distances(al.site_patterns(none), "k80").count() == 0


@pytest.mark.parametrize("model", ["jc69", "f81", "k80", "f84", "hky85", "t92", "tn93"])
def test_distance_recovers_time(spark, model):
    """Expected pair counts of a model give back its time, where the model holds."""
    t, kappa = 0.3, 1.0 if model in ("jc69", "f81") else 2.5
    p = Model(kappa, np.full(4, 0.25)).p(t) / 4
    seqs = ["", ""]
    for i, j in product(range(4), repeat=2):
        n = round(p[i, j] * 40_000)
        seqs[0] += "TCAG"[i] * n
        seqs[1] += "TCAG"[j] * n
    patterns = spark.createDataFrame([(a + b, seqs and round(p["TCAG".index(a), "TCAG".index(b)] * 40_000)) for a in "TCAG" for b in "TCAG"], "pattern string, fpatt long")
    assert abs(pairwise.distances(patterns, model).first().distance - t) < 2e-3


def test_inapplicable_distance(spark):
    far = spark.createDataFrame([("TC", 9), ("TT", 1)], "pattern string, fpatt long")
    assert pairwise.distances(far, "jc69").first().distance is None
    assert pairwise.distances(far, "jc69", legacy=True).first().distance == 9.0
    same = spark.createDataFrame([("TT", 5)], "pattern string, fpatt long")
    assert pairwise.distances(same, "tn93").first().distance == 0.0


def test_codon_sites_and_changes():
    aa = cd.code_of()
    assert cd.sites_of("TTT", aa) == pytest.approx((1 / 3, 8 / 3))
    assert cd.changes_of("TTT", "TTC", aa) == (1, 0) and cd.changes_of("TTT", "TTA", aa) == (0, 1)
    s, n = cd.changes_of("TTG", "AGA", aa)
    assert s + n == pytest.approx(3)
    assert cd.degeneracy("GGT", aa) == [0, 0, 4]


def test_ng86_same_sequences(spark):
    seq = "TTTGGTACC" * 5
    out = pairwise.ng86(al.codons(cells(spark, [seq, seq])), cd.pair_table(spark)).first()
    assert out.ds == 0 and out.dn == 0 and out.s + out.n == pytest.approx(45)


def test_pt_closed_forms(spark):
    model = Model(3.0, np.full(4, 0.25))
    p = model.p(0.7)
    assert np.allclose(p.sum(1), 1)
    row = spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(fitting.pt_k80(F.lit(0.7), 3.0))]).first()
    assert (row.c0, row.c1, row.c2) == pytest.approx((p[0, 0], p[0, 1], p[0, 2]))
    same, other = spark.range(1).select(*[c.alias(n) for n, c in zip("ab", fitting.pt_jc69(F.lit(0.7), 4), strict=True)]).first()
    assert same + 3 * other == pytest.approx(1)


def test_gamma():
    assert gamma_cdf(1.0, 1.0) == pytest.approx(1 - exp(-1))
    rates = discrete_gamma(0.5, 4)
    assert rates.mean() == pytest.approx(1) and rates == pytest.approx([0.03338775, 0.25191592, 0.82026848, 2.89442785], abs=1e-6)


def test_likelihood_is_a_distribution():
    nodes = parse_newick("((1:0.1,2:0.2):0.05,3:0.3);")
    patterns = ["".join(p) for p in product("TCAG", repeat=3)]
    lengths = np.array([n.length or 0 for n in nodes])
    lnl = pattern_lnl(nodes, tips_of(nodes, patterns), Model(2.0, np.array([0.1, 0.2, 0.3, 0.4])), lengths, discrete_gamma(0.7, 5))
    assert np.exp(lnl).sum() == pytest.approx(1)


def test_likelihood_does_not_depend_on_the_root():
    patterns, model, one = ["TCAG", "TTAA", "GG-A", "TCCC"], Model(3.0, np.array([0.3, 0.2, 0.3, 0.2])), np.ones(1)
    values = []
    for text in ("((1:0.1,2:0.2):0.15,3:0.3,4:0.4);", "(1:0.1,2:0.2,(3:0.3,4:0.4):0.15);"):
        nodes = parse_newick(text)
        values.append(pattern_lnl(nodes, tips_of(nodes, patterns), model, np.array([n.length or 0 for n in nodes]), one))
    assert values[0] == pytest.approx(values[1])


def test_ancestral_states_sum(spark):
    patterns = spark.createDataFrame([("TTTTT", 3), ("TTCCA", 1)], "pattern string, fpatt long")
    rows = {(r.pattern, r.node_id): r for r in fitting.ancestral_states(patterns, "((1,2),(3,4),5)", 0.05, 2.0).collect()}
    assert rows["TTTTT", 0].state == "T" and rows["TTTTT", 0].posterior > 0.99 and len(rows) == 6


def test_parsimony(spark):
    patterns = spark.createDataFrame([("TTTTT", 3), ("TTCCA", 1), ("TCTCA", 2), ("-TCCC", 1)], "pattern string, fpatt long")
    changes = fitting.parsimony_changes(patterns, "((1,2),(3,4),5)")
    assert {r.pattern: r.changes for r in changes.collect()} == {"TTTTT": 0, "TTCCA": 2, "TCTCA": 3, "-TCCC": 1}
    assert {r.changes: r.n_sites for r in fitting.change_histogram(changes).collect()} == {0: 3, 1: 1, 2: 1, 3: 2}
    assert fitting.alpha_by_moments(changes).first()["mean"] == pytest.approx(9 / 7)


@pytest.mark.parametrize("model, parameters, even", [("K80", [4.0], True), ("HKY85", [3.0], False), ("TN93", [2.0, 5.0], False), ("REV", [3.0, 0.5, 0.8, 0.6, 1.5], False)])
def test_fit(spark, model, parameters, even):
    """Exact expected pattern counts of a tree give its branch lengths and parameters back."""
    from cladeworks.functions.substitution import exchange_matrix

    tree = "((1:0.1,2:0.15):0.1,3:0.3,4:0.2)"
    nodes, every = parse_newick(tree), ["".join(p) for p in product("TCAG", repeat=4)]
    lengths, freqs = np.array([n.length or 0.0 for n in nodes]), np.full(4, 0.25) if even else np.array([0.3, 0.2, 0.4, 0.1])
    made = Model(0, freqs, exchange_matrix(model, np.array(parameters), freqs))
    share = np.exp(pattern_lnl(nodes, tips_of(nodes, every), made, lengths, np.ones(1)))
    counts = [(0, p, int(round(n))) for p, n in zip(every, share * 1e7, strict=True)]
    assert share.sum() == pytest.approx(1)
    fits = {r.tree_id: r for r in fitting.fit_trees(spark.createDataFrame(counts, "partition_id int, pattern string, fpatt long"), [tree, "((1,3),2,4)"][: 2 if even else 1], model=model, tolerance=1e-3).collect()}
    assert fits[0].converged and fits[0].parameters == pytest.approx(parameters, rel=0.02) and fits[0].tree_length == pytest.approx(0.85, rel=0.01)
    assert not even or fits[0].lnl > fits[1].lnl


def test_count_trees(spark):
    row = spark.range(1).select(fitting.count_trees(F.lit(5), False).alias("u"), fitting.count_trees(F.lit(5), True).alias("r"), fitting.count_trees(F.lit(2), True).alias("two")).first()
    assert (row.u, row.r, row.two) == (15, 105, 1)


def test_newick(spark):
    text = "((a:0.1,b:0.2 #1):0.3,'c'@2.5,d{7}:1)'>1<2';"
    nodes = parse_newick("((a:0.1,b:0.2#1):0.3,c@2.5,d{7}:1)'>1<2';")
    assert nodes[0].annotation == ">1<2" and [n.name for n in nodes if not n.sons] == ["a", "b", "c", "d"] and nodes[3].label == 1 and nodes[4].age == 2.5
    assert to_newick(parse_newick("((a:0.1,b:0.2):0.3,c);")) == "((a:0.1,b:0.2):0.3,c);"
    with pytest.raises(ValueError):
        parse_newick("((a,b)")
    rows = tree_rows(spark.createDataFrame([(1, "(a:1,(b:2,c:3):4);"), (2, None)], "tree_id int, newick string"))
    assert rows.count() == 5 and text


def test_tree_tables(spark):
    rows = tree_rows(spark.createDataFrame([(1, "((a:1,b:2):3,(c:4,d:5):6);")], "tree_id int, newick string")).drop("tree_id").withColumn("branch_length", F.coalesce("branch_length", F.lit(0.0)))
    ids = {r.name: r.node_id for r in rows.collect() if r["name"]}
    paths = trees.closure(rows)
    pairs = spark.createDataFrame([(ids["a"], ids["b"]), (ids["a"], ids["d"])], "a int, b int")
    got = {(r.a, r.b): r.distance for r in trees.mrca(pairs, paths).collect()}
    assert got == {(ids["a"], ids["b"]): 3.0, (ids["a"], ids["d"]): 15.0}
    assert {r.n_tips for r in trees.tip_sets(rows, paths).collect()} == {2, 4}


def test_tasks_sort_few_rows(spark, monkeypatch):
    """More rows, more tasks: what one task sorts doesn't grow with the input; equal values are one row."""
    from cladeworks.functions import frames

    monkeypatch.setattr(frames, "ROWS_A_TASK", 50)
    rows = [(f"p{k % 2}", None if k == 7 else float(k * 7 % 20)) for k in range(1000)]
    values, sizes, plain = spark.createDataFrame(rows, "param string, value double"), {}, frames.written
    monkeypatch.setattr(frames, "written", lambda df, name: (sizes.__setitem__(name, (out := plain(df, name)).count()), out)[1])
    for r in samples.summaries(values).collect():
        some = sorted((v for p, v in rows if p == r.param), key=lambda v: (v is not None, v))
        known = [v for v in some if v is not None]
        assert (r.n, r.least, r.most, r.q025, r.q995) == (500, min(known), max(known), some[12], some[497]) and abs(r.mean - sum(known) / len(known)) < 1e-9
        assert r.median == (some[249] + some[250]) / 2
    assert sizes["ranked"] == 21
    chains = spark.createDataFrame([(k % 40, k, float(k * k % 17)) for k in range(1200)], "chain int, iteration int, x double")
    got = samples.centred(chains, "x", 1)
    assert got.rdd.getNumPartitions() == 24 and got.count() == 1200
    chain = [float(k * k % 17) for k in range(1200) if k % 40 == 3]
    d = [x - sum(chain) / len(chain) for x in chain]
    assert abs({r.chain: r.rho for r in samples.lag_one(chains, "x").collect()}[3] - sum(a * b for a, b in zip(d, d[1:])) / sum(a * a for a in d)) < 1e-9


def test_pairs_move_one_row_each(spark, monkeypatch):
    """Deep leaves and inner nodes, a node with itself, its ancestor or its son, repeated pairs: ancestors meet once for each pair of fathers, not for each pair."""
    length = lambda k: float(k % 5 + 1)
    father = {0: None} | {k: (k - 1) // 2 for k in range(1, 31)} | {k: 15 + k % 3 for k in range(31, 91)}
    nodes = spark.createDataFrame([(k, f, length(k)) for k, f in father.items()], "node_id int, father_id int, branch_length double")
    sizes, plain = [], trees.written
    paths = trees.closure(nodes)
    monkeypatch.setattr(trees, "written", lambda df, name: (sizes.append((name, (out := plain(df, name)).count())), out)[1])

    def way(k):
        out, total = {}, 0.0
        while k is not None:
            out[k] = total
            total, k = total + length(k), father[k]
        return out

    asked = [(a, b) for a in range(31, 91) for b in range(31, 91)] + [(3, 3), (0, 0), (0, 90), (1, 15), (15, 1), (7, 90), (90, 15), (5, 12), (5, 12)]
    want = {(a, b): next((m, x + way(b)[m]) for m, x in way(a).items() if m in way(b)) for a, b in asked}
    got = trees.mrca(spark.createDataFrame(asked, "a int, b int"), paths).collect()
    assert len(got) == len(want) and {(r.a, r.b): (r.mrca, r.distance) for r in got} == want
    assert dict(sizes)["anchored"] == len(want) and dict(sizes)["met"] < 20


def test_splits(spark):
    splits = spark.createDataFrame([(1, "0011"), (1, "0110"), (2, "0011"), (3, "0011"), (3, "0110"), (4, "0101")], "tree_id int, split string")
    assert {r.split: r.support for r in trees.clade_support(splits).collect()}["0011"] == 0.75
    assert [r.split for r in trees.consensus(splits).collect()] == ["0011"]
    best = sorted(trees.credible_set(splits).collect(), key=lambda r: r["rank"])
    assert best[0].topology == "0011 0110" and best[0].cumulative == 0.5 and best[-1].cumulative == 1.0


def test_tip_dates(spark):
    names = spark.createDataFrame([("x_2020-03-10",), ("y_2020-03",), ("z",)], "name string")
    assert {r.name: r.age for r in trees.tip_dates(names, 1.0).collect()} == {"x_2020-03-10": 5.0, "y_2020-03": 0.0, "z": None}


def test_summaries(spark):
    values = spark.createDataFrame([("p", float(v)) for v in range(100)] + [("q", 1.0)] * 3, "param string, value double")
    got = {r.param: r for r in samples.summaries(values).collect()}
    assert (got["p"].median, got["p"].q025, got["p"].q975) == (49.5, 2.0, 97.0) and got["q"].median == 1.0
    assert {r.param: r.low for r in samples.hpd(values).collect()}["p"] == 0.0


def test_best_runs_and_confusion(spark):
    runs = spark.createDataFrame([(1, "a", 2.0), (1, "b", 2.0), (2, "a", 1.0)], "index int, run string, lnl double")
    assert {r["index"]: r.run for r in samples.best_runs(runs).collect()} == {1: "a", 2: "a"}
    sites = lambda x: spark.createDataFrame([(k,) for k in x], "site int")
    assert tuple(samples.confusion(sites([1, 2, 3]), sites([2, 3, 4, 5])).first()) == (2, 2, 1)


def test_mixture(spark):
    rows = spark.createDataFrame([(1, 1, 0.5, -1000.0), (1, 2, 0.5, -1001.0)], "site int, class int, weight double, lnf double")
    assert samples.mixture_lnl(rows).first().lnl == pytest.approx(-1000 + log(0.5 * (1 + exp(-1))))
    assert sum(r.posterior for r in samples.class_posteriors(rows).collect()) == pytest.approx(1)


def test_placements(spark):
    text = '{"fields": ["edge_num", "likelihood"], "placements": [{"p": [[3, -10.0], [4, -11.5]], "nm": [["q1", 1], ["q2", 2]]}, {"p": [[5, -2.0]], "n": ["q3"]}]}'
    docs = spark.createDataFrame([(text,)], "value string")
    cells_ = placements.parse_jplace(docs).collect()
    assert len(cells_) == 6 and {(r.placement_id, r.candidate_rank) for r in cells_} == {(1, 1), (1, 2), (2, 1)}
    assert {(r.placement_id, r.name, r.multiplicity) for r in placements.jplace_names(docs).collect()} == {(1, "q1", 1), (1, "q2", 2), (2, "q3", 1)}
    wide = placements.softmax_weights(spark.createDataFrame([(1, -10.0), (1, -11.5), (2, -2.0)], "placement_id int, likelihood double"), "likelihood", "w").collect()
    assert sum(r.w for r in wide if r.placement_id == 1) == pytest.approx(1) and [r.w for r in wide if r.placement_id == 2] == [1.0]


def test_bootstrap(spark):
    patterns = spark.createDataFrame([(0, "TT", 30), (0, "TC", 10), (1, "AA", 5)], "partition_id int, pattern string, fpatt long")
    got = resampling.bootstrap_patterns(patterns, 50).groupBy("replicate", "partition_id").agg(F.sum("fpatt").alias("n")).collect()
    assert {(r.partition_id, r.n) for r in got} == {(0, 40), (1, 5)} and len(got) == 100
    large = spark.createDataFrame([(0, "TT", 3 * 10**9), (0, "TC", 10**9), (0, "CC", 0)], "partition_id int, pattern string, fpatt long")
    rows = resampling.bootstrap_patterns(large, 200).collect()
    counts = [r.fpatt for r in rows if r.pattern == "TC"]
    assert {r.pattern for r in rows} == {"TT", "TC"} and len(rows) == 400 and abs(np.mean(counts) - 1e9) < 1e4 and 0.8 < np.std(counts) / np.sqrt(0.75e9) < 1.2


def test_alignment_files(spark, tmp_path):
    phylip = " 2 8 I\none   TTCA\ntwo   ..UA\n\nGG-A\n...C\n"
    assert parse_alignment(phylip) == [("one", "TTCAGG-A"), ("two", "TTTAGG-C")]
    assert parse_alignment(">a\nAC\nGT\n>b\nacgu\n") == [("a", "ACGT"), ("b", "ACGT")]
    assert parse_alignment("#NEXUS\nbegin data;\nmatrix\na AC\nb GT\n;\nend;") == [("a", "AC"), ("b", "GT")]
    with pytest.raises(ValueError):
        parse_alignment(">a\nACG\n>b\nAC\n")
    (tmp_path / "x.phy").write_text(phylip)
    read = read_alignments(spark, str(tmp_path / "x.phy"))
    assert read.count() == 16
    assert phylip_lines(read.withColumn("dataset_id", F.lit(1))).first().text == "2 8\none  TTCAGG-A\ntwo  TTTAGG-C"
    assert parse_control("seqfile = a.nuc * data\n# none\nmodel = 4\n") == {"seqfile": "a.nuc", "model": "4"}


def test_topologies(spark):
    assert [len(fitting.all_topologies(n)) for n in (3, 4, 5)] == [1, 3, 15]
    patterns = spark.createDataFrame([("TTCCA", 4), ("TTTTT", 9)], "pattern string, fpatt long")
    best = [r.tree for r in fitting.parsimony_search(patterns, fitting.all_topologies(4)).collect() if r.best]
    assert best == ["((1,2),3,4)"] or best == ["(1,2,(3,4))"] or len(best) == 1


def test_induced_subtree(spark):
    rows = tree_rows(spark.createDataFrame([(1, "(((a:1,b:2):3,c:4):5,d:6);")], "tree_id int, newick string")).drop("tree_id").withColumn("branch_length", F.coalesce("branch_length", F.lit(0.0)))
    ids = {r["name"]: r.node_id for r in rows.collect() if r["name"]}
    tips = spark.createDataFrame([(ids[k],) for k in "acd"], "node_id int")
    got = {r.node_id: (r.father_id, r.branch_length) for r in trees.induced_subtree(rows, trees.closure(rows), tips).collect()}
    assert got[ids["a"]][1] == 4.0 and got[ids["c"]][1] == 4.0 and got[ids["d"]] == (0, 6.0) and got[0] == (None, None) and len(got) == 5


def test_em_frequencies(spark):
    rows = cells(spark, ["TTTTCCAG", "YYYYRRRR"])
    freqs = al.frequencies_by_em(rows, rounds=200)
    assert sum(freqs) == pytest.approx(1) and freqs[0] / freqs[1] == pytest.approx(2, abs=1e-5)


def test_dating_chain(spark):
    pairs = spark.createDataFrame([(2, 1, 5000, 400)], "i int, j int, n long, differ long")
    a, b = (fitting.dating_chains(pairs).first() for _ in range(2))
    assert a == b and a["mean"] == pytest.approx(-0.75 * log(1 - 0.08 * 4 / 3), rel=0.03) and 0.05 < a.accepted < 0.95


def test_codon_pair_fit(spark):
    pairs = spark.createDataFrame([(2, 1, c, c, 40) for c in ("TTT", "GGC", "AAA", "CTG")] + [(2, 1, "TTT", "TTC", 6), (2, 1, "GGC", "GGT", 5), (2, 1, "AAA", "AAC", 1)], "i int, j int, codon_a string, codon_b string, n long")
    r = fitting.codon_pair_fits(pairs).first()
    assert r.omega < 0.5 and r.kappa > 2 and 0 < r.t < 1


def test_yn00(spark):
    """With kappa 1 and even frequencies, sites and differences are those of the unweighted count; a bias of transitions is found."""
    from cladeworks.functions import yn00 as yn

    sense = yn.tables("universal")["sense"]
    counts = np.zeros((61, 61))
    x, y, _, transition, same = yn.tables("universal")["single"].T
    for a, b, ts, s in zip(x, y, transition, same, strict=True):
        counts[a, b] += (4 if ts else 1) * (3 if s else 1)
    counts += np.diag(np.full(61, 200))
    assert 2.5 < yn.pair_kappa(counts, "universal") < 6
    even = yn.estimate(np.ones((61, 61)) + 40 * np.eye(61), 1.0, "universal", weighted=False)
    by_hand = [cd.sites_of(c, cd.code_of()) for c in sense]
    share = sum(s for s, _ in by_hand) / sum(s + n for s, n in by_hand)
    assert even["s"] / (even["s"] + even["n"]) == pytest.approx(share, abs=0.01)
    plain, weighed = (yn.estimate(counts, 4.0, "universal", w) for w in (False, True))
    assert 0.1 < weighed["omega"] < 0.8 and plain["dn"] == pytest.approx(weighed["dn"], rel=0.05)
    rows = [(2, 1, sense[a], sense[b], int(counts[a, b])) for a in range(61) for b in range(61) if counts[a, b]]
    got = pairwise.yn00(spark.createDataFrame(rows, "i int, j int, codon_a string, codon_b string, n long"), weighted=True).first()
    assert got.kappa == pytest.approx(yn.pair_kappa(counts, "universal")) and got.s + got.n == pytest.approx(3 * counts.sum())


def test_phylip_options():
    from cladeworks.sources.sequences import phylip_blocks

    text = "2 6 GI\nG 2 4\na  TTC\nb  TTA\n\nAAG\nAAC\n\n2 4 P\na  TCAG\nb  TC AA\n3 1\n2 10\n1 3 C\nlonely\nTCA\n"
    one, two, three = phylip_blocks(text)
    assert (one.names, one.seqs, one.partitions) == (["a", "b"], ["TTCAAG", "TTAAAC"], [0, 0, 0, 0, 1, 1])
    assert (two.seqs, two.counts) == (["TCAG", "TCAA"], [3, 1, 2, 10]) and (three.seqs, three.partitions) == (["TCA"], [0, 1, 2])
    assert phylip_blocks("1 4 G\nG 2\n1212\na  TTTT")[0].partitions == [0, 1, 0, 1]
    with pytest.raises(ValueError):
        phylip_blocks("1 4 G\nG 2 1 1\na  TTTT")
    with pytest.raises(ValueError):
        phylip_blocks("not a file")


def expected_counts(nodes, models, lengths, alphabet, total, drawn=False):
    """Expected (or drawn) counts of all patterns of three taxa under a mixture of processes."""
    from cladeworks.functions.statemodels import partials

    every = [list(p) for p in product(alphabet, repeat=3)]
    tips = {n.node_id: partials(every, list(alphabet))[int(n.name) - 1] for n in nodes if not n.sons}
    share = np.exp(fitting.mixed(fitting.class_lnl(nodes, tips, models, lengths), models))
    assert share.sum() == pytest.approx(1)
    counts = np.random.default_rng(1).multinomial(total, share / share.sum()) if drawn else np.rint(share * total)
    return [("".join(p), int(x)) for p, x in zip(every, counts, strict=True) if x > 0]


def test_codon_site_fits(spark):
    """Sites drawn from two classes: both models find kappa, and the one of two classes finds them and fits better."""
    from cladeworks.functions.statemodels import codon_models, codon_steps

    sense, _ = codon_steps("universal")
    nodes, x = parse_newick("(1:0.6,2:0.5,3:0.7)"), np.array([3.0, 0.7, 0.05])
    models = codon_models("M1a", x, np.full(61, 1 / 61), "universal")
    counts = expected_counts(nodes, models, np.array([n.length or 0.0 for n in nodes]), sense, 3000, drawn=True)
    fits = {r.model: r for r in fitting.fit_codons(spark.createDataFrame(counts, "pattern string, fpatt long"), "(1,2,3)", ["M0", "M1a"], rounds=8, tolerance=0.5).collect()}
    assert fits["M1a"].lnl > fits["M0"].lnl + 20 and 2 < fits["M1a"].kappa < 4.5 and fits["M1a"].omegas[0] < 0.2 and fits["M1a"].shares[0] == pytest.approx(0.7, abs=0.15)


def test_protein_fits(spark):
    from cladeworks.functions.statemodels import AMINO_ACIDS, protein_model

    nodes = parse_newick("(1:0.3,2:0.2,3:0.4)")
    counts = expected_counts(nodes, [(1.0, protein_model(None, np.full(20, 0.05)))], np.array([n.length or 0.0 for n in nodes]), AMINO_ACIDS, 1e6)
    fit = fitting.fit_proteins(spark.createDataFrame(counts, "pattern string, fpatt long"), ["(1,2,3)"]).first()
    assert fit.converged and fit.tree_length == pytest.approx(0.9, rel=0.02)
    exchange = [[1.0 + (i + j) % 3 for j in range(20)] for i in range(20)]
    other = fitting.fit_proteins(spark.createDataFrame(counts[:500], "pattern string, fpatt long"), ["(1,2,3)"], exchange=exchange, classes=4, rounds=2).first()
    assert other.alpha > 0
    got = fitting.protein_patterns(spark.createDataFrame([("TTTTAA---", 2), ("TTCTGA---", 3)], "pattern string, fpatt long")).collect()
    assert [(r.pattern, r.fpatt) for r in got] == [("FXX", 5)]
