"""Registered queries over files' lines and reports: lines are composed from the driver's tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cladeworks.functions.codons import code_table, degeneracy_table
from cladeworks.functions.frames import rounded
from cladeworks.functions.scores import Spec
from cladeworks.operators import alignment as al
from cladeworks.operators import fitting, likelihood, pairwise, reports, samples, trees
from cladeworks.plans import views as v
from cladeworks.plans.catalog import TOPOLOGIES, TREE, classes, codon_rows, patterns, query
from cladeworks.sources import adapters as ad
from cladeworks.sources import sequences, textfiles


def text(*columns):
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("line")


@query("mcmc_sample_file", """WITH s AS (SELECT l_suppkey AS file_id, CAST(l_orderkey AS BIGINT) AS iteration, CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_extendedprice AS DOUBLE) AS price FROM lineitem)
  SELECT file_id, iteration, 'quantity' AS param, quantity AS value FROM s UNION ALL SELECT file_id, iteration, 'price', price FROM s""")
def _(s, d):
    rows = ad.table(s, d, "lineitem").select(F.col("l_suppkey").alias("file_id"), (F.col("l_orderkey") + 1).alias("line_no"), text("l_orderkey", "l_quantity", "l_extendedprice"))
    heads = rows.select("file_id", F.lit(0).alias("line_no"), F.lit("Gen\tquantity\tprice").alias("line")).distinct()
    return textfiles.sample_file(heads.unionByName(rows))


@query("pattern_file", f"WITH {v.PATTERNS} SELECT 1 AS file_id, pattern, fpatt FROM patterns")
def _(s, d):
    return textfiles.pattern_file(patterns(s, d).select(F.lit(1).alias("file_id"), F.lit(1).alias("line_no"), F.concat_ws("  ", F.lit(" "), "pattern", F.col("fpatt").cast("string")).alias("line")))


@query("edge_list_tree", f"WITH {v.TREE} SELECT 1 AS file_id, node_id, father_id, CASE WHEN father_id IS NOT NULL THEN branch_length END AS branch_length, is_tip FROM nodes")
def _(s, d):
    edges = ad.tree_nodes(s, d).where("father_id is not null")
    return textfiles.edge_list(edges.select(F.lit(1).alias("file_id"), F.col("node_id").alias("line_no"), text("father_id", "node_id", "branch_length")))


@query("trait_file", "SELECT label AS file_id, 't' || vec_id AS taxon, CAST(t.i AS INT) AS trait, CAST(embedding[t.i] AS DOUBLE) AS value FROM embeddings, range(1, 65) AS t(i)")
def _(s, d):
    rows = ad.table(s, d, "embeddings")
    values = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), " ")
    return textfiles.trait_file(rows.select(F.col("label").alias("file_id"), (F.col("vec_id") + 1).alias("line_no"), F.concat(F.lit("t"), F.col("vec_id").cast("string"), F.lit("   "), values).alias("line")))


@query("triangle_file", """WITH c AS (SELECT a.n_nationkey + 1 AS i, b.n_nationkey + 1 AS j, (a.n_nationkey * 7 + b.n_nationkey * 3) / 4.0 AS value FROM nation a JOIN nation b ON b.n_nationkey < a.n_nationkey)
  SELECT 1 AS file_id, CAST(i AS INT) AS i, CAST(j AS INT) AS j, CAST(value AS DOUBLE) AS value FROM c UNION ALL SELECT 1, CAST(j AS INT), CAST(i AS INT), CAST(value AS DOUBLE) FROM c""")
def _(s, d):
    cells = F.transform(F.sequence(F.lit(0), F.col("n_nationkey").cast("int") - 1), lambda j: ((F.col("n_nationkey") * 7 + j * 3) / 4).cast("string"))
    return textfiles.triangle_file(ad.table(s, d, "nation").where("n_nationkey > 0").select(F.lit(1).alias("file_id"), F.col("n_nationkey").alias("line_no"), F.array_join(cells, " ").alias("line")))


@query("calibration_texts", """WITH c AS (SELECT o_orderkey AS node_id, o_orderkey % 6 AS k, o_custkey % 50 / 8.0 AS a, o_custkey % 50 / 8.0 + 0.5 AS b FROM orders)
  SELECT node_id, ['B', 'G', 'L', 'U', 'fixed', NULL][k + 1] AS kind, CASE k WHEN 0 THEN [a, b] WHEN 1 THEN [a, b] WHEN 2 THEN [a, 0.1, 1.0] WHEN 3 THEN [b] WHEN 4 THEN [a] END AS numbers FROM c""")
def _(s, d):
    a = (F.col("o_custkey") % 50) / 8
    shown, other = a.cast("string"), (a + 0.5).cast("string")
    made = F.element_at(F.array(F.concat(F.lit("'>"), shown, F.lit("<"), other, F.lit("'")), F.concat(F.lit("G("), shown, F.lit(", "), other, F.lit(")")), F.concat(F.lit("L{"), shown, F.lit(",0.1,1}")), F.concat(F.lit("<"), other), F.concat(F.lit("@"), shown), F.lit("no calibration")), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return textfiles.calibrations(ad.table(s, d, "orders").select(F.col("o_orderkey").alias("node_id"), made.alias("annotation"))).select("node_id", "kind", "numbers")


@query("phylip_files", f"""WITH {v.ALIGNMENT}, c AS (SELECT *, (site - 1) // 60 AS k FROM alignment WHERE site <= (SELECT max(site) // 60 * 60 FROM alignment))
  SELECT k // 3 AS file_id, CAST(k % 3 AS INT) AS dataset_id, taxon_id, 't' || taxon_id AS taxon, CAST((site - 1) % 60 + 1 AS INT) AS site, CAST(CASE k % 3 WHEN 0 THEN (site - 1) % 3 WHEN 1 THEN CAST((site - 1) % 60 >= 20 AS INT) ELSE site % 4 END AS INT) AS partition_id, 1 AS fpatt, state FROM c""")
def _(s, d):
    """Three data sets a file: partitions by codon position, by lengths and by marks."""
    cells = ad.alignment(s, d).withColumn("dataset_id", F.expr("(site - 1) div 60")).withColumn("taxon", F.concat(F.lit("t"), F.col("taxon_id").cast("string")))
    whole = cells.groupBy("dataset_id").agg(F.max("site").alias("last")).where("last % 60 = 0").select("dataset_id")
    marked = sequences.phylip_lines(cells.join(whole, "dataset_id"))
    k = F.col("dataset_id")
    marks = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: ((k * 60 + i) % 4 + 1).cast("string")), "")
    option = F.when(k % 3 == 0, "C").when(k % 3 == 1, "G\nG 2 20 40").otherwise(F.concat(F.lit("G\nG 4\n"), marks))
    texts = marked.select(F.expr("dataset_id div 3").alias("file_id"), F.struct("dataset_id", F.concat(F.lit("5 60 "), option, F.lit("\n"), F.substring_index("text", "\n", -5)).alias("text")).alias("x"))
    files = texts.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["text"]), "\n").alias("text"))
    return sequences.phylip_cells(files)


# Reports


NAMES = "names AS (SELECT DISTINCT taxon_id, 'taxon' || taxon_id AS name FROM alignment)"


@query("distance_lines", f"""WITH {v.TERMS}, {NAMES}, d AS (SELECT i, j, printf('%.4f', fd) AS cell FROM terms), l AS (SELECT i, string_agg(cell, '  ' ORDER BY j) AS cells FROM d GROUP BY i)
  SELECT taxon_id, name || coalesce('  ' || cells, '') AS line FROM names LEFT JOIN l ON i = taxon_id""")
def _(s, d):
    names = ad.alignment(s, d).select("taxon_id", F.concat(F.lit("taxon"), F.col("taxon_id").cast("string")).alias("name")).distinct()
    return reports.distance_lines(pairwise.distances(patterns(s, d), "p"), names)


@query("pattern_lines", f"WITH {v.PATTERNS} SELECT pattern || '  ' || fpatt AS line FROM patterns")
def _(s, d):
    return reports.pattern_lines(patterns(s, d))


@query("fasta_lines", f"WITH {v.ALIGNMENT}, s AS (SELECT (site - 1) // 90 AS dataset_id, taxon_id, string_agg(state, '' ORDER BY site) AS seq FROM alignment GROUP BY 1, 2) SELECT dataset_id, taxon_id, '>t' || taxon_id || chr(10) || substr(seq, 1, 60) || CASE WHEN length(seq) > 60 THEN chr(10) || substr(seq, 61) ELSE '' END AS text FROM s")
def _(s, d):
    cells = ad.alignment(s, d).withColumn("dataset_id", F.expr("(site - 1) div 90")).withColumn("taxon", F.concat(F.lit("t"), F.col("taxon_id").cast("string")))
    return reports.fasta_lines(cells)


@query("newick_subtrees", f"""WITH {v.TREE}, t AS (SELECT *, printf('%.6f', branch_length) AS l FROM nodes),
  low AS (SELECT father_id AS node_id, '(' || string_agg(node_id || ':' || l, ',' ORDER BY node_id) || ')' AS newick FROM t WHERE is_tip GROUP BY 1),
  middle AS (SELECT t.father_id AS node_id, '(' || string_agg(newick || ':' || l, ',' ORDER BY t.node_id) || ')' AS newick FROM t JOIN low USING (node_id) GROUP BY 1),
  top AS (SELECT t.father_id AS node_id, '(' || string_agg(newick || ':' || l, ',' ORDER BY t.node_id) || ')' AS newick FROM t JOIN middle USING (node_id) GROUP BY 1)
  SELECT * FROM low UNION ALL SELECT * FROM middle UNION ALL SELECT * FROM top""")
def _(s, d):
    return reports.newick_text(ad.tree_nodes(s, d), F.col("node_id").cast("string"), digits=6)


# Further operators


@query("informative_patterns", f"""WITH {v.PATTERNS}, s AS (SELECT pattern, fpatt, x, count(*) AS n FROM (SELECT pattern, fpatt, unnest(string_split(pattern, '')) AS x FROM patterns) WHERE x <> '-' GROUP BY ALL)
  SELECT pattern, fpatt FROM s GROUP BY ALL HAVING count(*) FILTER (n > 1) > 1""")
def _(s, d):
    return al.informative_patterns(patterns(s, d))


@query("f1x4", f"""WITH {v.ALIGNMENT}, {v.CODES}, c AS (SELECT state, count(*) AS n FROM alignment WHERE state <> '-' GROUP BY ALL), f AS (SELECT state, n / sum(n) OVER () AS freq FROM c),
  p AS (SELECT codon, x.freq * y.freq * z.freq AS p FROM codes JOIN f x ON x.state = substr(codon, 1, 1) JOIN f y ON y.state = substr(codon, 2, 1) JOIN f z ON z.state = substr(codon, 3, 1) WHERE aa <> '*')
  SELECT codon, round(p / sum(p) OVER (), 6) + 0.0 AS freq FROM p""")
def _(s, d):
    return al.f1x4(ad.alignment(s, d), code_table(s)).withColumn("freq", rounded("freq"))


@query("clean_data", f"WITH {v.ALIGNMENT} SELECT (site - 1) // 30 AS dataset_id, count(*) FILTER (state = '-') = 0 AS clean, count(*) FILTER (state = '-') AS n_unclear FROM alignment GROUP BY 1")
def _(s, d):
    return al.clean_data(ad.alignment(s, d), F.expr("(site - 1) div 30"))


@query("concatenated_loci", f"""WITH {v.ALIGNMENT}, l AS (SELECT site % 3 AS locus, taxon_id, (site - 1) // 3 + 1 AS place, state FROM alignment), sizes AS (SELECT locus, max(place) AS size FROM l GROUP BY 1), o AS (SELECT locus, coalesce(sum(size) OVER (ORDER BY locus ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS skip FROM sizes)
  SELECT locus, taxon_id, CAST(place + skip AS BIGINT) AS site, state FROM l JOIN o USING (locus)""")
def _(s, d):
    loci = ad.alignment(s, d).select((F.col("site") % 3).alias("locus"), "taxon_id", F.expr("(site - 1) div 3 + 1").alias("site"), "state")
    return al.concatenated(loci)


@query("partition_lengths", f"WITH {v.ALIGNMENT} SELECT taxon_id, site, CASE WHEN site <= 100 THEN 0 WHEN site <= 250 THEN 1 ELSE 2 END AS partition_id, state FROM alignment")
def _(s, d):
    return al.partitioned(ad.alignment(s, d), [100, 150])


@query("tip_names", f"WITH {v.TREE}, n AS (SELECT 'c' || c_custkey AS name FROM customer UNION ALL SELECT 'x' || n_nationkey FROM nation), t AS (SELECT 'c' || (node_id - 1000) // 2 AS name, node_id FROM nodes WHERE is_tip AND node_id % 2 = 0) SELECT name, node_id, node_id IS NOT NULL AS known FROM n LEFT JOIN t USING (name)")
def _(s, d):
    names = ad.table(s, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("name")).unionAll(ad.table(s, d, "nation").select(F.concat(F.lit("x"), F.col("n_nationkey").cast("string"))))
    tips = ad.tree_nodes(s, d).where("is_tip and node_id % 2 = 0").select(F.concat(F.lit("c"), F.expr("(node_id - 1000) div 2").cast("string")).alias("name"), "node_id")
    return trees.resolved(names, tips)


@query("main_tree_support", f"WITH {v.SPLITS}, main AS (SELECT split FROM splits WHERE tree_id = (SELECT min(tree_id) FROM splits) UNION SELECT '0111110'), f AS (SELECT split, count(DISTINCT tree_id) / (SELECT count(DISTINCT tree_id) FROM splits) AS support FROM splits GROUP BY split) SELECT split, round(coalesce(support, 0), 6) + 0.0 AS support FROM main LEFT JOIN f USING (split)")
def _(s, d):
    splits = ad.sampled_splits(s, d)
    first = splits.agg(F.min("tree_id").alias("tree_id"))
    main = splits.join(F.broadcast(first), "tree_id").select("split").unionAll(s.range(1).select(F.lit("0111110"))).distinct()
    return trees.main_tree_support(main, splits).withColumn("support", rounded("support"))


@query("best_class", f"WITH {v.CLASSES}, p AS (SELECT site, class, weight * exp(lnf) / sum(weight * exp(lnf)) OVER (PARTITION BY site) AS posterior FROM classes), o AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY round(posterior, 9) DESC, class) AS k FROM p) SELECT site, class, round(posterior, 6) + 0.0 AS posterior FROM o WHERE k = 1")
def _(s, d):
    return samples.best_class(samples.class_posteriors(classes(s, d))).withColumn("posterior", rounded("posterior"))


@query("score_products", "WITH e AS (SELECT label % 3 + 1 AS w, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS g FROM embeddings), ix AS (SELECT a.i, b.i AS j FROM range(1, 65) a(i), range(1, 65) b(i) WHERE b.i <= a.i) SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(sum(w * g[i] * g[j]), 4) + 0.0 AS value FROM e, ix GROUP BY 1, 2")
def _(s, d):
    rows = ad.table(s, d, "embeddings").select((F.col("label") % 3 + 1).alias("fpatt"), F.col("embedding").cast("array<double>").alias("gradient"))
    return samples.score_products(rows).withColumn("value", rounded("value", 4))


@query("lpb93", v.LWL85[: v.LWL85.rindex("SELECT i, j, round(")] + "SELECT i, j, round((l2 * a2 + l4 * a4) / (l2 + l4) + b4, 6) + 0.0 AS ds, round(a0 + (l0 * b0 + l2 * b2) / (l0 + l2), 6) + 0.0 AS dn FROM parts")
def _(s, d):
    out = pairwise.lwl85(codon_rows(s, d), degeneracy_table(s), method="lpb93")
    return out.select("i", "j", rounded("ds").alias("ds"), rounded("dn").alias("dn"))


@query("autocorrelation", """WITH m AS (SELECT l_suppkey AS chain, l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey) AS d, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS k FROM lineitem),
  v AS (SELECT chain, count(*) AS n, sum(d * d) AS ss FROM m GROUP BY chain HAVING sum(d * d) > 0), r AS (SELECT a.chain, b.k - a.k AS lag, sum(a.d * b.d) AS s FROM m a JOIN m b ON b.chain = a.chain AND b.k - a.k BETWEEN 1 AND 10 GROUP BY 1, 2),
  c AS (SELECT v.chain, n, lag, coalesce(s, 0) / ss AS rho FROM v CROSS JOIN range(1, 11) AS g(lag) LEFT JOIN r USING (chain, lag)), stop AS (SELECT chain, min(lag) AS stop FROM c WHERE round(rho, 9) < 0.05 GROUP BY chain)
  SELECT chain, n, round(1 + 2 * coalesce(sum(rho) FILTER (stop IS NULL OR lag < stop), 0), 6) + 0.0 AS tau FROM c LEFT JOIN stop USING (chain) GROUP BY chain, n""")
def _(s, d):
    return samples.autocorrelation_time(ad.samples(s, d), "quantity", lags=10).withColumn("tau", rounded("tau"))


KAPPAS = f"""WITH {v.CODON_PAIRS}{v.MUTANTS}, free AS (SELECT codon, k, sum(CASE WHEN aa2 = aa THEN 1 ELSE 0 END) AS f FROM mutants GROUP BY codon, k),
  placed AS (SELECT i, j, n, substr(ca, x.k, 1) AS a, substr(cb, x.k, 1) AS b, CASE WHEN x.f = 0 AND y.f = 0 THEN 0 WHEN x.k = 3 AND x.f = 3 AND y.f = 3 AND p.aa = q.aa THEN 1 END AS kind
    FROM met JOIN free x ON x.codon = ca JOIN free y ON y.codon = cb AND y.k = x.k JOIN codes p ON p.codon = ca JOIN codes q ON q.codon = cb),
  twice AS (SELECT i, j, kind, a, b, n / 2.0 AS n FROM placed WHERE kind IS NOT NULL UNION ALL SELECT i, j, kind, b, a, n / 2.0 FROM placed WHERE kind IS NOT NULL),
  sums AS (SELECT i, j, kind, sum(n) AS s, {", ".join(f"sum(CASE WHEN a = '{x}' THEN n ELSE 0 END) / sum(n) AS p{x}" for x in "TCAG")}, sum(CASE WHEN a || b IN ('TC', 'CT', 'AG', 'GA') THEN n ELSE 0 END) / sum(n) AS p, sum(CASE WHEN a <> b AND a || b NOT IN ('TC', 'CT', 'AG', 'GA') THEN n ELSE 0 END) / sum(n) AS q FROM twice GROUP BY ALL),
  terms AS (SELECT *, pT + pC AS y, pA + pG AS r, pT * pC AS tc, pA * pG AS ag FROM sums),
  logs AS (SELECT *, 1 - q / (2 * y * r) AS w, (2 * (tc + ag) + 2 * (tc * r / y + ag * y / r) * (1 - q / (2 * y * r)) - p) / (2 * (tc / y + ag / r)) AS u FROM terms),
  found AS (SELECT i, j, s, CASE WHEN p + q > 1 THEN 1.0 WHEN q < least(1e-10, 0.1 / s) THEN NULL WHEN y > 0 AND r > 0 AND tc + ag > 0 AND u > 0 AND w > 0 AND w < 1 THEN least(1 + (tc / y + ag / r) / (tc + ag) * (ln(u) / ln(w) - 1), 999)
    WHEN 1 - 2 * p - q > 0 AND 1 - 2 * q > 0 THEN least((-0.5 * ln(1 - 2 * p - q) + 0.25 * ln(1 - 2 * q)) / (-0.25 * ln(1 - 2 * q)), 999) END AS kappa FROM logs)"""


@query("pair_kappas", KAPPAS + " SELECT f.i, f.j, round(coalesce(sum(s * kappa) FILTER (kappa > 0) / sum(s) FILTER (kappa > 0), 2.0), 5) + 0.0 AS kappa, (SELECT CAST(sum(n) AS BIGINT) FROM met m WHERE m.i = f.i AND m.j = f.j) AS codons FROM found f GROUP BY f.i, f.j")
def _(s, d):
    return pairwise.pair_kappas(pairwise.codon_pairs(codon_rows(s, d))).withColumn("kappa", rounded("kappa", 5))


@query("yn00", None)
def _(s, d):
    return pairwise.yn00(pairwise.codon_pairs(codon_rows(s, d)), weighted=True)


# Fits: iterative, so without SQL; each round is a job over blocks of patterns


def told(fits):
    """What two runs agree on: sums over tasks differ in their last digits."""
    return fits.select("locus", "model", rounded("lnl", 2).alias("lnl"), F.transform("parameters", lambda x: F.round(x, 2)).alias("parameters"), rounded("tree_length", 2).alias("tree_length"), "converged")


@query("nucleotide_model_fits", None)
def _(s, d):
    blocks = likelihood.spread(patterns(s, d))
    fits = [told(likelihood.fit_blocks(blocks, TREE, Spec("bases", m), tolerance=0.001)) for m in ("JC69", "HKY85", "TN93")]
    return fits[0].unionAll(fits[1]).unionAll(fits[2])


@query("protein_fits", None)
def _(s, d):
    blocks = likelihood.spread(fitting.protein_patterns(pairwise.codon_patterns(codon_rows(s, d))))
    trees_ = [TREE, "((1,3),(2,4),5)"]
    fits = [told(likelihood.fit_blocks(blocks, t, Spec("proteins", "equal"), tolerance=0.001)).withColumn("tree", F.lit(t)) for t in trees_]
    return fits[0].unionAll(fits[1])


@query("codon_site_fits", None)
def _(s, d):
    blocks = likelihood.spread(pairwise.codon_patterns(codon_rows(s, d)))
    fits = [told(likelihood.fit_blocks(blocks, TREE, Spec("codons", m), tolerance=0.02)).drop("parameters") for m in ("M0", "M1a")]
    return fits[0].unionAll(fits[1])


@query("protein_patterns", f"""WITH {v.CODONS}, {v.CODES}, t AS (SELECT codon_site, taxon_id, CASE WHEN aa IS NULL OR aa = '*' THEN 'X' ELSE aa END AS aa FROM codon_rows LEFT JOIN codes USING (codon)), p AS (SELECT codon_site, string_agg(aa, '' ORDER BY taxon_id) AS pattern FROM t GROUP BY 1) SELECT pattern, count(*) AS fpatt FROM p GROUP BY 1""")
def _(s, d):
    return fitting.protein_patterns(pairwise.codon_patterns(codon_rows(s, d)))


@query("credible_trees", f"WITH {TOPOLOGIES}, r AS (SELECT topology, n_trees, row_number() OVER w AS rank, sum(n_trees) OVER w AS up_to, (SELECT sum(n_trees) FROM topologies) AS total FROM topologies WINDOW w AS (ORDER BY n_trees DESC, topology ROWS UNBOUNDED PRECEDING)) SELECT topology, n_trees, rank FROM r WHERE round((up_to - n_trees) / total, 9) < 0.5")
def _(s, d):
    return trees.credible_trees(ad.sampled_splits(s, d), 0.5)


@query("phylip_text", f"""WITH {v.ALIGNMENT}, c AS (SELECT CAST((site - 1) % 3 AS INT) AS part, (site - 1) // 300 AS block, taxon_id, site, state FROM alignment), s AS (SELECT block * 3 + part AS dataset_id, taxon_id, string_agg(state, '' ORDER BY site) AS seq FROM c GROUP BY 1, 2)
  SELECT dataset_id, count(*) || ' ' || any_value(length(seq)) || chr(10) || string_agg('t' || taxon_id || '  ' || seq, chr(10) ORDER BY taxon_id) AS text FROM s GROUP BY 1""")
def _(s, d):
    """A file's text for each partition by codon position of each stretch of 300 sites."""
    cells = ad.alignment(s, d).withColumn("dataset_id", F.expr("(site - 1) div 300 * 3 + (site - 1) % 3")).withColumn("taxon", F.concat(F.lit("t"), F.col("taxon_id").cast("string")))
    return sequences.phylip_lines(cells)
