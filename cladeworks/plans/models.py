"""Registered queries over scores by branch, curvature files, Bayes empirical Bayes, dating, search and tests of trees."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from cladeworks.functions.dating import Prior
from cladeworks.functions.frames import rounded
from cladeworks.functions.scores import Spec
from cladeworks.operators import alignment as al
from cladeworks.operators import ancestors, dating, empirical_bayes, likelihood, pairwise, placements, search, trees, treetests
from cladeworks.operators.smoothing import smoothed_rates
from cladeworks.plans import views as v
from cladeworks.plans.catalog import codon_rows, patterns, query
from cladeworks.sources import adapters as ad
from cladeworks.sources import branchfiles, sequences, textfiles

STAR, LENGTHS = "(1,2,3);", [0.1, 0.2, 0.3]


def three_taxa(s, d):
    return patterns(s, d).groupBy(F.substring("pattern", 1, 3).alias("pattern")).agg(F.sum("fpatt").alias("fpatt"))


#: Of each pattern of three taxa: probability and slope of each tip's state, for each state x of the middle.
TIPS = f"""WITH {v.PATTERNS}, p AS (SELECT substr(pattern, 1, 3) AS pattern, sum(fpatt) AS w FROM patterns GROUP BY 1), cells AS (SELECT pattern, w, x, k, t, substr(pattern, k, 1) AS c FROM p, (VALUES ('T'), ('C'), ('A'), ('G')) AS s(x), (VALUES (1, 0.1), (2, 0.2), (3, 0.3)) AS b(k, t)),
  moved AS (SELECT pattern, w, x, k, CASE WHEN c = '-' THEN 1.0 WHEN c = x THEN 0.25 + 0.75 * exp(-4 * t / 3) ELSE 0.25 - 0.25 * exp(-4 * t / 3) END AS p, CASE WHEN c = '-' THEN 0.0 WHEN c = x THEN -exp(-4 * t / 3) ELSE exp(-4 * t / 3) / 3 END AS d FROM cells),
  wide AS (SELECT pattern, w, x, max(p) FILTER (k = 1) AS p1, max(p) FILTER (k = 2) AS p2, max(p) FILTER (k = 3) AS p3, max(d) FILTER (k = 1) AS d1, max(d) FILTER (k = 2) AS d2, max(d) FILTER (k = 3) AS d3 FROM moved GROUP BY pattern, w, x),
  f AS (SELECT pattern, w, sum(p1 * p2 * p3) AS f, sum(d1 * p2 * p3) AS f1, sum(p1 * d2 * p3) AS f2, sum(p1 * p2 * d3) AS f3 FROM wide GROUP BY pattern, w),
  g AS (SELECT w, ln(f / 4) AS lnf, unnest([1, 2, 3]) AS i, unnest([f1 / f, f2 / f, f3 / f]) AS s, [f1 / f, f2 / f, f3 / f] AS all_s FROM f)"""


def star_scores(s, d):
    point = likelihood.Point(STAR, np.full(4, 0.25), np.zeros(0), np.array(LENGTHS))
    return likelihood.summed_scores(likelihood.spread(three_taxa(s, d)), Spec("bases", "JC69"), {0: point}, outer=True)


@query("branch_gradient", f"{TIPS} SELECT CAST(i AS INT) AS branch, round(sum(w * s), 4) + 0.0 AS gradient FROM g GROUP BY i")
def _(s, d):
    return star_scores(s, d).where("at between 0 and 2").select((F.col("at") + 1).alias("branch"), rounded("value", 4).alias("gradient"))


@query("branch_hessian", f"{TIPS} SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(-sum(w * s * all_s[j]), 3) + 0.0 AS value FROM g, range(1, 4) AS r(j) GROUP BY ALL")
def _(s, d):
    at = F.col("at") - 3
    return star_scores(s, d).where("at > 2").select((F.expr("(at - 3) div 3") + 1).cast("int").alias("i"), (at % 3 + 1).cast("int").alias("j"), rounded(-F.col("value"), 3).alias("value"))


BLOCKS = """WITH m AS (SELECT label, k, round(avg(abs(embedding[k])), 4) AS x FROM embeddings, range(1, 31) AS r(k) GROUP BY 1, 2), b AS (SELECT label, k AS i, x + 0.05 AS b FROM m WHERE k <= 5), g AS (SELECT label, k - 5 AS i, x - 0.5 AS g FROM m WHERE k BETWEEN 6 AND 10),
  h AS (SELECT label, i, j, -100.0 * (SELECT x FROM m n WHERE n.label = l.label AND n.k = 6 + (least(i, j) * 5 + greatest(i, j)) % 25) - CASE WHEN i = j THEN 300 ELSE 0 END AS h FROM (SELECT DISTINCT label FROM m) l, range(1, 6) AS a(i), range(1, 6) AS c(j))"""


def made_blocks(s, d):
    """Lengths, gradient and Hessian of a tree of four taxa for each label, from means of the label's vectors."""
    cells = ad.table(s, d, "embeddings").select("label", F.posexplode("embedding").alias("at", "v")).where("at < 30")
    means = cells.groupBy("label", "at").agg(F.round(F.avg(F.abs(F.col("v").cast("double"))), 4).alias("x"))
    x = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda c: c["x"])
    rows = means.groupBy("label").agg(x.alias("x"))
    cell = lambda i, j: -100.0 * F.get("x", (5 + (F.least(i, j) * 5 + F.greatest(i, j)) % 25).cast("int")) - F.when(i == j, 300.0).otherwise(0.0)
    one_to_five = F.sequence(F.lit(1), F.lit(5))
    h = F.transform(one_to_five, lambda i: F.transform(one_to_five, lambda j: cell(i, j)))
    return rows.select(F.col("label").cast("int").alias("locus"), F.lit(4).alias("taxa"), F.lit("((a: 0.1, b: 0.2): 0.1, c: 0.2, d: 0.3);").alias("tree"), F.transform(F.slice("x", 1, 5), lambda v: v + 0.05).alias("b"), F.transform(F.slice("x", 6, 5), lambda v: v - 0.5).alias("g"), h.alias("h"))


@query("branch_file", f"{BLOCKS} SELECT CAST(label AS INT) AS file_id, 1 AS locus, CAST(i AS INT) AS i, round(b, 6) + 0.0 AS b, round(g, 6) + 0.0 AS g, round(sum(h), 6) + 0.0 AS h_row FROM b JOIN g USING (label, i) JOIN h USING (label, i) GROUP BY ALL")
def _(s, d):
    """Written as files, one a label, and read back."""
    texts = branchfiles.branch_file_text(made_blocks(s, d))
    lines = texts.select(F.col("locus").alias("file_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = branchfiles.branch_file(lines).where("complete").select("file_id", "locus", F.posexplode("b").alias("at", "b"), "g", "h")
    total = F.aggregate(F.get("h", F.col("at")), F.lit(0.0), lambda acc, x: acc + x)
    return rows.select("file_id", "locus", (F.col("at") + 1).cast("int").alias("i"), rounded("b").alias("b"), rounded(F.get("g", F.col("at"))).alias("g"), rounded(total).alias("h_row"))


@query("approximate_lnl", f"""{BLOCKS}, u AS (SELECT label, i, sqrt(b) AS u, 2 * sqrt(b) * g AS g, g AS plain FROM b JOIN g USING (label, i)), z AS (SELECT label, i, sample, 0.01 * sample * i AS z FROM u, range(1, 4) AS s(sample))
  SELECT CAST(z.label AS INT) AS locus, CAST(z.sample AS INT) AS sample, round(any_value(q.q) + sum(z.z * u.g), 6) + 0.0 AS lnl FROM z JOIN u USING (label, i) JOIN (SELECT label, sample, sum(a.z * c.z * (h * 4 * ua.u * uc.u + CASE WHEN h.i = h.j THEN 2 * ua.plain ELSE 0 END)) / 2 AS q FROM h JOIN z a USING (label, i) JOIN z c USING (label, sample) JOIN u ua USING (label, i) JOIN u uc ON uc.label = label AND uc.i = h.j WHERE c.i = h.j GROUP BY ALL) q ON q.label = z.label AND q.sample = z.sample GROUP BY ALL""")
def _(s, d):
    blocks = branchfiles.transformed(made_blocks(s, d), "sqrt")
    moved = blocks.select("locus", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("sample"), "b")
    at = moved.select("locus", "sample", F.transform("b", lambda x, i: x + 0.01 * F.col("sample") * (i + 1)).alias("x"))
    return branchfiles.approximate_lnl(blocks, at).select("locus", "sample", rounded("lnl").alias("lnl"))


OMEGAS, GRID = [0.2, 1.0, 3.0], [[0.5, 0.3, 0.2], [0.2, 0.3, 0.5], [0.1, 0.8, 0.1], [0.6, 0.0, 0.4]]


@query("empirical_bayes", f"""WITH s AS (SELECT p_partkey AS site, p_size % 3 + 1 AS w, [exp(-p_size / 4e3), exp(-p_retailprice / 2e4), exp(-(p_partkey % 17) / 3e2)] AS f FROM part), grid AS (SELECT * FROM (VALUES {", ".join(f"({k}, {row[0]}, {row[1]}, {row[2]})" for k, row in enumerate(GRID))}) AS g(point, a, b, c)),
  mixed AS (SELECT site, w, f, point, a, b, c, a * f[1] + b * f[2] + c * f[3] AS m FROM s, grid), lnl AS (SELECT point, sum(w * ln(m)) AS lnl FROM mixed GROUP BY point), weight AS (SELECT point, exp(lnl - (SELECT max(lnl) FROM lnl)) / (SELECT sum(exp(lnl - (SELECT max(lnl) FROM lnl))) FROM lnl) AS q FROM lnl),
  post AS (SELECT site, sum(q * a * f[1] / m) AS p1, sum(q * b * f[2] / m) AS p2, sum(q * c * f[3] / m) AS p3 FROM mixed JOIN weight USING (point) GROUP BY site)
  SELECT site, round(p3, 6) + 0.0 AS p_positive, round(0.2 * p1 + p2 + 3 * p3, 6) + 0.0 AS mean, round(sqrt(0.04 * p1 + p2 + 9 * p3 - (0.2 * p1 + p2 + 3 * p3) ** 2), 6) + 0.0 AS sd FROM post""")
def _(s, d):
    lnf = F.array(-F.col("p_size") / 4e3, -F.col("p_retailprice") / 2e4, -(F.col("p_partkey") % 17) / 3e2)
    rows = ad.table(s, d, "part").select(F.col("p_partkey").alias("site"), (F.col("p_size") % 3 + 1).cast("long").alias("fpatt"), lnf.alias("lnf"))
    found = empirical_bayes.empirical_bayes(rows, ["site"], np.array(OMEGAS), np.array(GRID))
    return found.select("site", *[rounded(c).alias(c) for c in ("p_positive", "mean", "sd")])


@query("joint_states", f"""{TIPS}, best AS (SELECT pattern, x, p1 * p2 * p3 AS q FROM (SELECT pattern, x, CASE WHEN substr(pattern, 1, 1) = '-' THEN 0.25 + 0.75 * exp(-0.4 / 3) ELSE p1 END AS p1, CASE WHEN substr(pattern, 2, 1) = '-' THEN 0.25 + 0.75 * exp(-0.8 / 3) ELSE p2 END AS p2, CASE WHEN substr(pattern, 3, 1) = '-' THEN 0.25 + 0.75 * exp(-1.2 / 3) ELSE p3 END AS p3 FROM wide)),
  o AS (SELECT pattern, x, q, row_number() OVER (PARTITION BY pattern ORDER BY round(q, 12) DESC, position(x IN 'TCAG')) AS k FROM best)
  SELECT pattern, x AS state, round(q / f, 6) + 0.0 AS posterior FROM o JOIN f USING (pattern) WHERE k = 1""")
def _(s, d):
    found = ancestors.joint_states(three_taxa(s, d), STAR, Spec("bases", "JC69"), [], [0.25] * 4, LENGTHS)
    return found.select("pattern", F.get("states", F.lit(0)).alias("state"), rounded("posterior").alias("posterior"))


@query("correlated_rates", None)
def _(s, d):
    """Rate classes of neighbouring sites, by how often events of a site are of high value."""
    sites = ad.table(s, d, "events").groupBy(F.expr("event_id div 5").alias("site")).agg(F.avg("value").alias("x"))
    rates = [0.2, 0.6, 1.2, 2.0]
    lnf = F.array(*[-F.abs(F.col("x") / 20 - r) for r in rates])
    _, found = ancestors.correlated_rates(sites.select("site", lnf.alias("lnf")), ancestors.class_moves(0.5, 4), rates)
    return found.select("site", rounded("mean_rate").alias("mean_rate"), "best")


@query("tree_test", None)
def _(s, d):
    """Three trees whose ln f differ by what an order's numbers make of them."""
    base = -F.log1p(F.col("o_totalprice") / 1000)
    lnf = F.array(base, base + (F.col("o_custkey") % 7 - 3) / 50, base - (F.col("o_orderkey") % 5) / 40)
    rows = ad.table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("pattern"), (F.col("o_custkey") % 3).alias("fpatt"), lnf.alias("lnf"))
    found = treetests.tree_test(rows, 500)
    return found.select("tree", *[rounded(c, 4).alias(c) for c in ("lnl", "behind", "p_kh", "p_sh", "best_share")])


@query("tree_search", None)
def _(s, d):
    return search.search_trees(patterns(s, d), ad.TAXA).select("round", "step", "candidates", "tree", rounded("score", 3).alias("score"))


LABELLED = "((1,2)#1,(3,4),5);"


@query("branch_omega_fits", None)
def _(s, d):
    """The two-ratio model, and branch-site model A with the model without selection inside it."""
    each = likelihood.spread(pairwise.codon_patterns(codon_rows(s, d)))
    fits = [likelihood.fit_blocks(each, LABELLED, Spec("codons", m), tolerance=0.05) for m in ("branch", "A_null", "A")]
    return fits[0].unionAll(fits[1]).unionAll(fits[2]).select("model", rounded("lnl", 1).alias("lnl"), "converged")


ROOTED, UNROOTED = "(((1,2),(3,4))'B(0.5, 0.7)',5)'B(0.9, 1.1)';", "((1,2),(3,4),5);"


@query("dating", None)
def _(s, d):
    """Three loci's branch lengths and curvature, written as a file and read back, then chains over ages under both bounds."""
    cells = ad.alignment(s, d)
    loci = al.site_patterns(cells, ((F.col("site") - 1) % 3).cast("int")).withColumnRenamed("partition_id", "locus")
    found = likelihood.branch_curvature(loci, UNROOTED, Spec("bases", "K80"))
    exact = found.withColumns({c: F.transform(c, lambda x: F.round(x, 3)) for c in ("b", "g")}).withColumn("h", F.transform("h", lambda r: F.transform(r, lambda x: F.round(x, -1))))
    lines = branchfiles.branch_file_text(exact).select(F.col("locus").alias("file_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    blocks = branchfiles.branch_file(lines).select(F.lit(0).alias("dataset"), F.col("file_id").alias("locus"), "tree", "b", "g", "h")
    folder = s.conf.get("spark.checkpoint.dir", None) or "file:///tmp/checkpoints/cladeworks"
    chains = dating.dating_samples(blocks, ROOTED, f"{folder.rstrip('/')}/dating-{uuid.uuid4().hex}", Prior(clock=2), burn_in=200, samples=100, every=2, versions=2)
    return dating.age_summary(chains, ROOTED).select("dataset", "node_id", "n", *[rounded(c, 3).alias(c) for c in ("mean", "sd", "low", "high")])


@query("phylip_found", f"""WITH {v.ALIGNMENT}, c AS (SELECT *, (site - 1) // 30 AS k FROM alignment WHERE site <= (SELECT max(site) // 30 * 30 FROM alignment))
  SELECT k AS file_id, 0 AS dataset_id, taxon_id, 't' || taxon_id AS taxon, CAST((site - 1) % 30 + 1 AS INT) AS site, CASE WHEN k % 2 = 0 THEN CAST((site - 1) % 3 AS INT) ELSE 0 END AS partition_id, 1 AS fpatt, state FROM c""")
def _(s, d):
    """Files as they are found: codon positions by GC alone, or interleaved with lines that number the sites; notes with numbers behind the data."""
    k = F.expr("(site - 1) div 30")
    cells = ad.alignment(s, d).groupBy(k.alias("file_id"), "taxon_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("site", "state"))), lambda c: c["state"]), "").alias("seq"))
    rows = cells.where("length(seq) = 30").groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("taxon_id", "seq"))).alias("rows"))
    name = lambda r: F.concat(F.lit("t"), r["taxon_id"].cast("string"))
    part = lambda a: F.array_join(F.transform("rows", lambda r: F.regexp_replace(F.substring(r["seq"], a, 10), "(.{3})", "$1 ")), "\n")
    whole = F.concat(F.lit("5 30  GC\n\n"), F.array_join(F.transform("rows", lambda r: F.concat(name(r), F.lit("      "), F.lower(r["seq"]), F.lit("   30"))), "\n"))
    woven = F.concat(F.lit("5 30 I\n"), F.array_join(F.transform("rows", name), "\n"), F.lit("\n1\n"), part(1), F.lit("\n11  \t\n"), part(11), F.lit("\n21\n"), part(21))
    text = F.concat(F.when(F.col("file_id") % 2 == 0, whole).otherwise(woven), F.lit("\n\nNotes (1992)\n5 30\n1231231\n"))
    return sequences.phylip_cells(rows.where("size(rows) = 5").select("file_id", text.alias("text")))


def jplace_documents(s, d):
    """(file_id, value): a document for each customer's orders; an order is a placement with two candidates, its name and its priority."""
    order = ad.table(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    p = F.array(F.array((F.col("o_orderkey") % 97).cast("double"), -F.col("o_totalprice") / 1e5), F.array((F.col("o_orderkey") % 89).cast("double"), -F.col("o_totalprice") / 5e4))
    nm = F.array(F.array(F.concat(F.lit("q"), F.col("o_orderkey").cast("string")), F.lit("1")), F.array(F.col("o_orderpriority"), (F.col("o_orderkey") % 4 + 1).cast("string")))
    placed = order.select(F.col("o_custkey").alias("file_id"), F.struct("o_orderkey", F.struct(p.alias("p"), nm.alias("nm")).alias("placement")).alias("x"))
    listed = placed.groupBy("file_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["placement"]).alias("placements"))
    return listed.select("file_id", F.to_json(F.struct(F.array(F.lit("edge_num"), F.lit("likelihood")).alias("fields"), "placements")).alias("value"))


PLACED = "WITH p AS (SELECT o_custkey AS file_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS placement_id, o_orderkey AS k, o_totalprice AS x, o_orderpriority AS name FROM orders)"


@query("jplace_cells", f"{PLACED} SELECT file_id, placement_id, CAST(rank AS INT) AS candidate_rank, field, CASE WHEN field = 'edge_num' THEN CAST(CASE rank WHEN 1 THEN k % 97 ELSE k % 89 END AS DOUBLE) ELSE round(-x / CASE rank WHEN 1 THEN 1e5 ELSE 5e4 END, 7) + 0.0 END AS value FROM p, (VALUES (1), (2)) AS r(rank), (VALUES ('edge_num'), ('likelihood')) AS f(field)")
def _(s, d):
    return placements.parse_jplace(jplace_documents(s, d), "file_id").withColumn("value", rounded("value", 7))


@query("jplace_names", f"{PLACED} SELECT file_id, placement_id, CAST(rank AS INT) AS name_rank, CASE rank WHEN 1 THEN 'q' || k ELSE name END AS name, CAST(CASE rank WHEN 1 THEN 1 ELSE k % 4 + 1 END AS INT) AS multiplicity FROM p, (VALUES (1), (2)) AS r(rank)")
def _(s, d):
    return placements.jplace_names(jplace_documents(s, d), "file_id")


@query("smoothed_rates", """WITH b AS (SELECT s_nationkey AS tree_id, s_suppkey AS node_id, abs(s_acctbal) / 1e4 AS l, (s_suppkey % 7 + 1) / 4.0 AS t, (s_suppkey % 3 + 1) / 10.0 AS v FROM supplier), p AS (SELECT *, t * t / v AS a, t * l / v AS c FROM b), top AS (SELECT tree_id, sum(2 * c / (a + 2)) / sum(2 - 4 / (a + 2)) AS base FROM p GROUP BY tree_id)
  SELECT tree_id, node_id, round((c + 2 * base) / (a + 2), 6) + 0.0 AS rate FROM p JOIN top USING (tree_id)""")
def _(s, d):
    """A star for each nation, whose tips are its suppliers."""
    k = F.col("s_suppkey")
    rows = ad.table(s, d, "supplier").select(F.col("s_nationkey").alias("tree_id"), k.alias("node_id"), F.lit(-1).cast("long").alias("father_id"), (F.abs("s_acctbal") / 1e4).alias("length"), ((k % 7 + 1) / 4).alias("span"), ((k % 3 + 1) / 10).alias("variance"))
    return smoothed_rates(rows, 2.0).withColumn("rate", rounded("rate"))


@query("general_fits", None)
def _(s, d):
    """Processes that aren't reversible, or that differ between a clade and the rest."""
    blocks = likelihood.spread(patterns(s, d))
    fits = [likelihood.fit_blocks(blocks, "(((1,2)$1,(3,4)),5);", Spec("bases", m), tolerance=0.02) for m in ("UNREST", "NH")]
    return fits[0].unionAll(fits[1]).select("model", rounded("lnl", 1).alias("lnl"), "converged")


def matrix_lines(s, d):
    """Files of a matrix of six states, one a part's size: its triangle in lines of any width, frequencies, and a note."""
    parts = ad.table(s, d, "part").groupBy(F.col("p_size").alias("file_id")).agg(F.round(F.avg("p_retailprice") / 1000, 4).alias("x"))
    numbers = F.transform(F.sequence(F.lit(1), F.lit(21)), lambda k: (F.col("x") * k).cast("string"))
    line = lambda a, n: F.array_join(F.slice(numbers, a, n), "  ")
    rows = F.array(F.lit(""), line(1, 1), line(2, 5), line(7, 9), F.lit(" "), line(16, 4), line(20, 2), F.lit("notes of 2001, 18 pages"), F.lit("7 8 9"))
    return parts.select("file_id", F.posexplode(rows).alias("line_no", "line"))


MATRIX = "WITH m AS (SELECT p_size AS file_id, round(avg(p_retailprice) / 1000, 4) AS x FROM part GROUP BY 1)"


@query("exchange_file", f"{MATRIX}, c AS (SELECT file_id, CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(x * ((i - 1) * (i - 2) / 2 + j), 6) + 0.0 AS rate FROM m, range(2, 7) AS a(i), range(1, 7) AS b(j) WHERE j < i) SELECT * FROM c UNION ALL SELECT file_id, j, i, rate FROM c")
def _(s, d):
    return textfiles.exchange_file(matrix_lines(s, d), 6).withColumn("rate", rounded("rate"))


@query("frequency_file", f"{MATRIX} SELECT file_id, CAST(i AS INT) AS i, round((15 + i) / 111.0, 6) + 0.0 AS freq FROM m, range(1, 7) AS a(i)")
def _(s, d):
    return textfiles.frequency_file(matrix_lines(s, d), 6).withColumn("freq", rounded("freq"))


@query("lifted_mrca", f"WITH {v.MET} SELECT a, b, mrca, round(distance, 6) + 0.0 AS distance FROM mrca")
def _(s, d):
    found = trees.Lifted(ad.tree_nodes(s, d)).mrca(ad.tip_pairs(s, d))
    return found.select("a", "b", "mrca", rounded("distance").alias("distance"))
