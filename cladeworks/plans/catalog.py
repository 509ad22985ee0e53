"""The registered queries of the library outside the training-data subpackage, each with its SQL.

A query applies an operator to an adapter view of the driver's tables (see ``sources.adapters``).
"""

from __future__ import annotations

from collections.abc import Callable
from math import lgamma

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.functions.codons import code_table, degeneracy_table, pair_table
from cladeworks.functions.frames import rounded
from cladeworks.operators import alignment as al
from cladeworks.operators import fitting, pairwise, placements, resampling, samples, trees
from cladeworks.plans import views as v
from cladeworks.sources import adapters as ad
from cladeworks.sources.newick import parse_newick

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from cladeworks.plans import files, models  # noqa: F401  register their own

    return QUERIES


def oracle_sql() -> dict[str, str]:
    queries()
    return SQL


def patterns(s, d):
    return al.site_patterns(ad.alignment(s, d))


def codon_rows(s, d):
    return al.codons(ad.alignment(s, d))


# Columns of the alignment


@query("site_patterns", f"WITH {v.PATTERNS} SELECT pattern, fpatt FROM patterns")
def _(s, d):
    return patterns(s, d)


@query("site_patterns_partitioned", f"WITH {v.COLUMNS} SELECT CAST((site - 1) % 3 AS INT) AS partition_id, pattern, count(*) AS fpatt FROM cols GROUP BY 1, 2")
def _(s, d):
    return al.site_patterns(ad.alignment(s, d), ((F.col("site") - 1) % 3).cast("int"))


@query("site_to_pattern", f"WITH {v.COLUMNS} SELECT site, dense_rank() OVER (ORDER BY pattern) AS pattern_id FROM cols")
def _(s, d):
    return al.site_to_pattern(ad.alignment(s, d))


@query("canonical_patterns", f"""WITH {v.PATTERNS}, letters AS (SELECT pattern, fpatt, list_filter(string_split(replace(pattern, '-', ''), ''), lambda x: x <> '') AS l FROM patterns),
  firsts AS (SELECT pattern, fpatt, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '') AS f FROM letters)
  SELECT translate(pattern, f, substr('TCAG', 1, CAST(length(f) AS INT))) AS pattern, CAST(sum(fpatt) AS BIGINT) AS fpatt FROM firsts GROUP BY 1""")
def _(s, d):
    return al.canonical_patterns(patterns(s, d))


@query("clean_sites", f"WITH {v.ALIGNMENT} SELECT taxon_id, site, state FROM alignment WHERE site NOT IN (SELECT site FROM alignment WHERE state = '-')")
def _(s, d):
    return al.clean_sites(ad.alignment(s, d)).select("taxon_id", "site", "state")


@query("constant_sites", f"WITH {v.ALIGNMENT} SELECT site, min(state) AS state FROM alignment GROUP BY site HAVING min(state) = max(state) AND min(state) <> '-'")
def _(s, d):
    return al.constant_sites(ad.alignment(s, d))


@query("informative_sites", f"WITH {v.ALIGNMENT}, c AS (SELECT site, state FROM alignment WHERE state <> '-' GROUP BY ALL HAVING count(*) > 1) SELECT site, count(*) AS n_states FROM c GROUP BY site HAVING count(*) > 1")
def _(s, d):
    return al.informative_sites(ad.alignment(s, d))


@query("duplicate_sequences", f"""WITH {v.ALIGNMENT}, seqs AS (SELECT (site - 1) // 6 AS dataset_id, taxon_id, string_agg(state, '' ORDER BY site) AS seq FROM alignment GROUP BY 1, 2),
  f AS (SELECT *, min(taxon_id) OVER (PARTITION BY dataset_id, seq) AS same_as FROM seqs) SELECT dataset_id, taxon_id, same_as FROM f WHERE same_as < taxon_id""")
def _(s, d):
    return al.duplicate_sequences(ad.alignment(s, d), F.expr("(site - 1) div 6"))


FREQS = f"{v.ALIGNMENT}, counts AS (SELECT taxon_id, state, count(*) AS n FROM alignment WHERE state <> '-' GROUP BY ALL), freqs AS (SELECT *, n / sum(n) OVER (PARTITION BY taxon_id) AS freq FROM counts)"


@query("state_freq_by_taxon", f"WITH {FREQS} SELECT taxon_id, state, n, round(freq, 6) + 0.0 AS freq FROM freqs")
def _(s, d):
    return al.state_frequencies(ad.alignment(s, d)).withColumn("freq", rounded("freq"))


@query("state_freq_mean", f"WITH {FREQS} SELECT state, round(sum(freq) / 5, 6) + 0.0 AS freq, round(sum(n) / (SELECT sum(n) FROM counts), 6) + 0.0 AS pooled FROM freqs GROUP BY state")
def _(s, d):
    freqs = al.state_frequencies(ad.alignment(s, d))
    pooled = al.mean_frequencies(freqs, pooled=True).withColumnRenamed("freq", "pooled")
    return al.mean_frequencies(freqs).join(pooled, "state").select("state", rounded("freq").alias("freq"), rounded("pooled").alias("pooled"))


@query("homogeneity_x2_g", f"WITH {FREQS}, m AS (SELECT *, avg(freq) OVER (PARTITION BY state) AS mean FROM freqs) SELECT round(sum(pow(freq - mean, 2) / mean), 6) + 0.0 AS x2, round(2 * sum(freq * ln(freq / mean)), 6) + 0.0 AS g FROM m")
def _(s, d):
    return al.homogeneity(al.state_frequencies(ad.alignment(s, d))).select(rounded("x2").alias("x2"), rounded("g").alias("g"))


@query("codon_usage", f"WITH {v.CODONS} SELECT taxon_id, codon, count(*) AS n FROM codon_rows WHERE codon NOT LIKE '%-%' GROUP BY 1, 2")
def _(s, d):
    return al.codon_usage(codon_rows(s, d))


@query("codon_translate", f"WITH {v.CODONS}, {v.CODES} SELECT taxon_id, codon_site, codon, coalesce(aa, '-') AS aa FROM codon_rows LEFT JOIN codes USING (codon)")
def _(s, d):
    return codon_rows(s, d).join(F.broadcast(code_table(s)), "codon", "left").select("taxon_id", "codon_site", "codon", F.coalesce("aa", F.lit("-")).alias("aa"))


@query("stop_masking", f"WITH {v.CODONS}, {v.CODES}, stops AS (SELECT DISTINCT codon_site FROM codon_rows JOIN codes USING (codon) WHERE aa = '*') SELECT taxon_id, codon_site, CASE WHEN codon_site IN (SELECT codon_site FROM stops) THEN '---' ELSE codon END AS codon FROM codon_rows")
def _(s, d):
    return al.mask_stops(codon_rows(s, d), code_table(s))


@query("f3x4", f"""WITH {v.ALIGNMENT}, {v.CODES}, c AS (SELECT (site - 1) % 3 + 1 AS k, state, count(*) AS n FROM alignment WHERE state <> '-' GROUP BY ALL), f AS (SELECT k, state, n / sum(n) OVER (PARTITION BY k) AS freq FROM c),
  p AS (SELECT codon, x.freq * y.freq * z.freq AS p FROM codes JOIN f x ON x.k = 1 AND x.state = substr(codon, 1, 1) JOIN f y ON y.k = 2 AND y.state = substr(codon, 2, 1) JOIN f z ON z.k = 3 AND z.state = substr(codon, 3, 1) WHERE aa <> '*')
  SELECT codon, round(p / sum(p) OVER (), 6) + 0.0 AS freq FROM p""")
def _(s, d):
    return al.f3x4(ad.alignment(s, d), code_table(s)).withColumn("freq", rounded("freq"))


@query("fourfold_sites", f"""WITH {v.CODONS}, {v.CODES}, free AS (SELECT substr(codon, 1, 2) AS box FROM codes GROUP BY 1 HAVING count(DISTINCT aa) = 1),
  same AS (SELECT codon_site FROM codon_rows GROUP BY 1 HAVING min(substr(codon, 1, 2)) = max(substr(codon, 1, 2)) AND min(substr(codon, 1, 2)) IN (SELECT box FROM free))
  SELECT codon_site, taxon_id, substr(codon, 3, 1) AS state FROM codon_rows WHERE codon_site IN (SELECT codon_site FROM same)""")
def _(s, d):
    return al.fourfold_sites(codon_rows(s, d), code_table(s))


@query("sliding_window_counts", f"""WITH {v.ALIGNMENT}, f AS (SELECT site, CAST(min(state) <> max(state) AS INT) AS x FROM alignment WHERE state <> '-' GROUP BY site), last AS (SELECT max(site) AS m FROM alignment)
  SELECT w AS window_start, CAST(sum(x) AS BIGINT) AS n_variable FROM f, last, unnest(generate_series(greatest(site - 19, 1), site)) AS u(w) WHERE w + 19 <= m GROUP BY w""")
def _(s, d):
    return al.window_counts(ad.alignment(s, d), 20)


# Pairs of taxa


@query("pair_counts", f"WITH {v.PAIRS} SELECT i, j, a, b, n FROM pairs")
def _(s, d):
    return pairwise.pair_counts(patterns(s, d))


def _distance_query(name: str, model: str, alpha: float | None) -> None:
    def run(s, d):
        return pairwise.distances(patterns(s, d), model, alpha).withColumn("distance", rounded("distance"))

    query(f"dist_{name}", v.distance_sql(name))(run)


for _name in v.DISTANCES:
    _distance_query(_name, _name.removesuffix("_gamma"), 0.5 if _name.endswith("_gamma") else None)


@query("ng86", v.NG86)
def _(s, d):
    out = pairwise.ng86(codon_rows(s, d), pair_table(s))
    return out.select("i", "j", *[rounded(c).alias(c) for c in ("s", "n", "ds", "dn")])


@query("lwl85", v.LWL85)
def _(s, d):
    out = pairwise.lwl85(codon_rows(s, d), degeneracy_table(s))
    return out.select("i", "j", rounded("ds").alias("ds"), rounded("dn").alias("dn"))


# Trees


@query("tree_closure", f"WITH {v.PATHS} SELECT node_id, ancestor_id, steps, round(length, 6) + 0.0 AS length FROM paths")
def _(s, d):
    return trees.closure(ad.tree_nodes(s, d)).withColumn("length", rounded("length"))


def met_pairs(s, d):
    return trees.mrca(ad.tip_pairs(s, d), trees.closure(ad.tree_nodes(s, d)))


@query("tree_mrca", f"WITH {v.MET} SELECT a, b, mrca FROM mrca")
def _(s, d):
    return met_pairs(s, d).select("a", "b", "mrca")


@query("tree_path_distance", f"WITH {v.MET} SELECT a, b, round(distance, 6) + 0.0 AS distance FROM mrca")
def _(s, d):
    return met_pairs(s, d).select("a", "b", rounded("distance").alias("distance"))


@query("group_distance", f"WITH {v.MET} SELECT x.father_id AS group_a, y.father_id AS group_b, round(avg(distance), 4) + 0.0 AS mean_distance, count(*) AS n FROM mrca JOIN nodes x ON x.node_id = a JOIN nodes y ON y.node_id = b GROUP BY 1, 2")
def _(s, d):
    groups = ad.tree_nodes(s, d).select("node_id", F.col("father_id").alias("group_id"))
    return trees.group_distances(met_pairs(s, d), groups).withColumn("mean_distance", rounded("mean_distance", 4))


@query("tree_tip_sets", f"WITH {v.PATHS} SELECT ancestor_id AS node_id, count(*) AS n_tips, min(p.node_id) AS least, max(p.node_id) AS most FROM paths p JOIN nodes n ON n.node_id = p.node_id WHERE is_tip AND steps > 0 GROUP BY 1")
def _(s, d):
    nodes = ad.tree_nodes(s, d)
    return trees.tip_sets(nodes, trees.closure(nodes))


@query("branch_length_from_age", f"WITH {v.TREE}, ages AS (SELECT node_id, CASE WHEN is_tip THEN branch_length ELSE 10.0 - father_id * 0.01 END AS age FROM nodes WHERE father_id IS NOT NULL UNION ALL SELECT 0, 20.0) SELECT n.node_id, round(CAST((f.age - o.age) AS DOUBLE) * 0.5, 8) + 0.0 AS branch_length FROM nodes n JOIN ages o ON o.node_id = n.node_id JOIN ages f ON f.node_id = n.father_id")
def _(s, d):
    nodes = ad.tree_nodes(s, d)
    age = F.when(F.col("father_id").isNull(), 20.0).when(F.col("is_tip"), F.col("branch_length")).otherwise(10.0 - F.col("father_id") * 0.01)
    return trees.branch_lengths_from_ages(nodes, nodes.select("node_id", age.alias("age")), F.lit(0.5)).withColumn("branch_length", rounded("branch_length", 8))


@query("tree_splits", f"WITH {v.SPLITS} SELECT tree_id, split FROM splits")
def _(s, d):
    return ad.sampled_splits(s, d)


@query("shared_splits", f"WITH {v.SPLITS} SELECT a.tree_id AS tree_a, b.tree_id AS tree_b, count(*) AS n_shared FROM splits a JOIN splits b ON b.tree_id = a.tree_id + 1 AND b.split = a.split GROUP BY 1, 2")
def _(s, d):
    return trees.shared_splits(ad.sampled_splits(s, d), F.col("tree_id") + 1)


@query("clade_support", f"WITH {v.SPLITS} SELECT split, count(DISTINCT tree_id) AS n_trees, round(count(DISTINCT tree_id) / (SELECT count(DISTINCT tree_id) FROM splits), 6) + 0.0 AS support FROM splits GROUP BY split")
def _(s, d):
    return trees.clade_support(ad.sampled_splits(s, d)).withColumn("support", rounded("support"))


TOPOLOGIES = f"{v.SPLITS}, keys AS (SELECT tree_id, string_agg(split, ' ' ORDER BY split) AS topology FROM splits GROUP BY tree_id), topologies AS (SELECT topology, count(*) AS n_trees FROM keys GROUP BY topology)"


@query("credible_set", f"WITH {TOPOLOGIES} SELECT topology, n_trees, row_number() OVER w AS rank, round(sum(n_trees) OVER w / (SELECT sum(n_trees) FROM topologies), 6) + 0.0 AS cumulative FROM topologies WINDOW w AS (ORDER BY n_trees DESC, topology ROWS UNBOUNDED PRECEDING)")
def _(s, d):
    return trees.credible_set(ad.sampled_splits(s, d)).withColumn("cumulative", rounded("cumulative"))


@query("tree_jumps", f"""WITH {v.SPLITS}, keys AS (SELECT tree_id, string_agg(split, ' ' ORDER BY split) AS topology FROM splits GROUP BY tree_id), c AS (SELECT tree_id % 50 AS chain, tree_id // 50 AS iteration, topology FROM keys),
  j AS (SELECT chain, CASE WHEN topology <> lag(topology) OVER (PARTITION BY chain ORDER BY iteration) THEN 1 ELSE 0 END AS jump FROM c) SELECT chain, CAST(sum(jump) AS BIGINT) AS n_jumps, count(*) AS n FROM j GROUP BY chain""")
def _(s, d):
    keys = ad.sampled_splits(s, d).groupBy("tree_id").agg(F.array_join(F.array_sort(F.collect_set("split")), " ").alias("topology"))
    return trees.tree_jumps(keys.select((F.col("tree_id") % 50).alias("chain"), F.expr("tree_id div 50").alias("iteration"), "topology"))


@query("tip_dates", "WITH n AS (SELECT 'tip' || o_orderkey || '_' || strftime(o_orderdate, '%Y-%m-%d') AS name, CAST(o_orderdate AS DATE) AS dt FROM orders) SELECT name, round(date_diff('day', dt, (SELECT max(dt) FROM n)) / 365.25, 6) + 0.0 AS age FROM n")
def _(s, d):
    names = ad.table(s, d, "orders").select(F.concat(F.lit("tip"), F.col("o_orderkey").cast("string"), F.lit("_"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("name"))
    return trees.tip_dates(names, 365.25).withColumn("age", rounded("age"))


# Samples, runs and likelihood tables

PARAMETERS = ["quantity", "extendedprice", "discount", "tax"]


def values(s, d):
    return samples.long_samples(ad.samples(s, d), PARAMETERS)


@query("mcmc_summary", f"""WITH {v.VALUES} SELECT param, n, round(avg(value), 4) + 0.0 AS mean, round(var_samp(value), 2) + 0.0 AS variance,
  (max(CASE WHEN rank = (n - 1) // 2 THEN value END) + max(CASE WHEN rank = n // 2 THEN value END)) / 2 AS median, min(value) AS least, max(value) AS most,
  max(CASE WHEN rank = CAST(floor(n * 0.025) AS BIGINT) THEN value END) AS q025, max(CASE WHEN rank = CAST(floor(n * 0.975) AS BIGINT) THEN value END) AS q975,
  max(CASE WHEN rank = CAST(floor(n * 0.005) AS BIGINT) THEN value END) AS q005, max(CASE WHEN rank = CAST(floor(n * 0.995) AS BIGINT) THEN value END) AS q995 FROM placed GROUP BY param, n""")
def _(s, d):
    return samples.summaries(values(s, d)).withColumn("mean", rounded("mean", 4)).withColumn("variance", rounded("variance", 2))


@query("mcmc_hpd", f"""WITH {v.VALUES}, spans AS (SELECT a.param, b.value - a.value AS width, a.value AS low, b.value AS high FROM placed a JOIN placed b ON b.param = a.param AND b.rank = a.rank + CAST(floor(a.n * 0.95) AS BIGINT)),
  o AS (SELECT *, row_number() OVER (PARTITION BY param ORDER BY width, low) AS k FROM spans) SELECT param, low, high FROM o WHERE k = 1""")
def _(s, d):
    return samples.hpd(values(s, d))


@query("mcmc_lag1", """WITH m AS (SELECT l_suppkey AS chain, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey) AS d FROM lineitem),
  b AS (SELECT chain, d, lag(d) OVER (PARTITION BY chain ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS e FROM m)
  SELECT chain, count(*) AS n, round(sum(d * e) / sum(d * d), 6) + 0.0 AS rho FROM b GROUP BY chain HAVING sum(d * d) > 0 AND count(e) > 0""")
def _(s, d):
    return samples.lag_one(ad.samples(s, d), "quantity").withColumn("rho", rounded("rho"))


@query("best_of_runs", """WITH o AS (SELECT o_custkey AS "index", o_orderpriority AS run, o_totalprice AS lnl, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderpriority) AS k FROM orders) SELECT "index", run, lnl FROM o WHERE k = 1""")
def _(s, d):
    runs = ad.table(s, d, "orders").select(F.col("o_custkey").alias("index"), F.col("o_orderpriority").alias("run"), F.col("o_totalprice").alias("lnl"))
    return samples.best_runs(runs)


@query("confusion_sites", "WITH t AS (SELECT DISTINCT l_orderkey AS site FROM lineitem WHERE l_returnflag = 'R'), i AS (SELECT o_orderkey AS site FROM orders WHERE o_orderstatus = 'F') SELECT count(t.site) FILTER (i.site IS NOT NULL) AS true_positive, count(i.site) FILTER (t.site IS NULL) AS false_positive, count(t.site) FILTER (i.site IS NULL) AS false_negative FROM t FULL JOIN i ON t.site = i.site")
def _(s, d):
    truth = ad.table(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("site")).distinct()
    return samples.confusion(truth, ad.table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("site")))


@query("kh_test", f"""WITH {v.LNF}, totals AS (SELECT tree_id, sum(lnf) AS lnl FROM lnf GROUP BY tree_id), best AS (SELECT tree_id FROM totals ORDER BY lnl DESC, tree_id LIMIT 1), g AS (SELECT a.tree_id, a.lnf - b.lnf AS gap FROM lnf a JOIN lnf b ON a.site = b.site WHERE b.tree_id = (SELECT tree_id FROM best))
  SELECT t.tree_id, round(lnl, 4) + 0.0 AS lnl, round(sum(gap), 4) + 0.0 AS delta, round(sqrt(var_pop(gap) * count(*)), 4) + 0.0 AS se FROM totals t JOIN g ON g.tree_id = t.tree_id GROUP BY t.tree_id, lnl""")
def _(s, d):
    out = samples.kh_test(ad.site_likelihoods(s, d))
    return out.select("tree_id", *[rounded(c, 4).alias(c) for c in ("lnl", "delta", "se")])


def classes(s, d):
    rank = F.least("l_linenumber", F.lit(3))
    return ad.table(s, d, "lineitem").select(F.col("l_orderkey").alias("site"), rank.alias("class"), (0.5 / rank).alias("weight"), (-F.col("l_extendedprice") / 5e4).alias("lnf"))


@query("mix_loglik", f"WITH {v.CLASSES} SELECT site, round(ln(sum(weight * exp(lnf))), 6) + 0.0 AS lnl FROM classes GROUP BY site")
def _(s, d):
    return samples.mixture_lnl(classes(s, d)).withColumn("lnl", rounded("lnl"))


@query("selected_sites", f"WITH {v.CLASSES}, p AS (SELECT site, class, weight * exp(lnf) / sum(weight * exp(lnf)) OVER (PARTITION BY site) AS posterior FROM classes), s AS (SELECT site, sum(CASE WHEN class = 3 THEN posterior ELSE 0 END) AS p FROM p GROUP BY site) SELECT site, round(p, 6) + 0.0 AS p, CASE WHEN p > 0.99 THEN '**' WHEN p > 0.95 THEN '*' ELSE '' END AS mark FROM s WHERE p > 0.5")
def _(s, d):
    return samples.selected_sites(samples.class_posteriors(classes(s, d)), F.col("class") == 3).withColumn("p", rounded("p"))


# Placements and haplogroups


@query("softmax_weights", f"WITH {v.PLACEMENTS} SELECT placement_id, edge_num, round(exp(likelihood) / sum(exp(likelihood)) OVER (PARTITION BY placement_id), 6) + 0.0 AS like_weight_ratio, round(exp(marginal_like) / sum(exp(marginal_like)) OVER (PARTITION BY placement_id), 6) + 0.0 AS post_prob FROM candidates")
def _(s, d):
    c = placements.softmax_weights(placements.softmax_weights(ad.placements(s, d), "likelihood", "like_weight_ratio"), "marginal_like", "post_prob")
    return c.select("placement_id", "edge_num", rounded("like_weight_ratio").alias("like_weight_ratio"), rounded("post_prob").alias("post_prob"))


RANKED = f"{v.PLACEMENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY placement_id ORDER BY likelihood DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS candidate_rank FROM candidates)"


@query("candidate_rank", f"WITH {RANKED} SELECT placement_id, edge_num, CAST(candidate_rank AS INT) AS candidate_rank FROM r")
def _(s, d):
    return placements.candidate_ranks(ad.placements(s, d), "likelihood").select("placement_id", "edge_num", "candidate_rank")


@query("placement_flatten", f"WITH {v.PLACEMENTS} SELECT placement_id, edge_num, o_orderpriority AS name, likelihood FROM candidates JOIN orders ON o_orderkey = placement_id")
def _(s, d):
    names = ad.table(s, d, "orders").select(F.col("o_orderkey").alias("placement_id"), F.col("o_orderpriority").alias("name"))
    return placements.flatten(ad.placements(s, d), names).select("placement_id", "edge_num", "name", "likelihood")


@query("jplace_key_value", f"""WITH {RANKED} SELECT placement_id, candidate_rank, unnest(['edge_num', 'likelihood']) AS field, unnest([CAST(edge_num AS DOUBLE), likelihood]) AS value FROM r""")
def _(s, d):
    ranked = placements.candidate_ranks(ad.placements(s, d), "likelihood")
    field = F.explode(F.map_from_arrays(F.array(F.lit("edge_num"), F.lit("likelihood")), F.array(F.col("edge_num").cast("double"), F.col("likelihood")))).alias("field", "value")
    return ranked.select("placement_id", F.col("candidate_rank").cast("long").alias("candidate_rank"), field)


def rho_long(s, d):
    met = ad.table(s, d, "customer").join(ad.table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return placements.rho(met.select(F.col("n_name").alias("group"), F.col("c_mktsegment").alias("region"), (F.col("c_custkey") % 7).alias("changes")))


def _wide_sql() -> str:
    return ", ".join(f"round(max(CASE WHEN region = '{r}' THEN {c} END), 6) + 0.0 AS RHO_{r}{x}" for r in SEGMENTS for c, x in (("rho", ""), ("rho_se", "_SE")))


@query("rho_pivot", f'WITH {v.RHO} SELECT grp AS "group", {_wide_sql()} FROM rho_long GROUP BY grp')
def _(s, d):
    wide = placements.pivot_regions(rho_long(s, d), SEGMENTS)
    return wide.select("group", *[rounded(c).alias(c) for c in wide.columns[1:]])


@query("rho_unpivot", f'WITH {v.RHO} SELECT grp AS "group", region, round(rho, 6) + 0.0 AS rho, round(rho_se, 6) + 0.0 AS rho_se FROM rho_long')
def _(s, d):
    out = placements.unpivot_regions(placements.pivot_regions(rho_long(s, d), SEGMENTS), SEGMENTS)
    return out.select("group", "region", rounded("rho").alias("rho"), rounded("rho_se").alias("rho_se"))


@query("rho_resume", f"WITH {v.RHO}, done AS (SELECT * FROM rho_long WHERE rho < 3), g AS (SELECT DISTINCT n_name AS grp FROM nation), r(region) AS (VALUES {', '.join(f"('{r}')" for r in SEGMENTS)}) SELECT g.grp AS \"group\", r.region FROM g, r WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.grp = g.grp AND done.region = r.region)")
def _(s, d):
    groups = ad.table(s, d, "nation").select(F.col("n_name").alias("group"))
    return placements.missing_regions(rho_long(s, d).where("rho < 3"), groups, SEGMENTS)


@query("group_counts", "SELECT n_name AS haplogroup, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(s, d):
    met = ad.table(s, d, "customer").join(ad.table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return met.groupBy(F.col("n_name").alias("haplogroup")).agg(F.count("*").alias("n"))


# Closed forms and grids over columns


@query("grid_cross", f"""WITH {v.PATTERNS}, v AS (SELECT fpatt, CAST(len(list_distinct(string_split(pattern, ''))) > 1 AS INT) AS x FROM patterns), g AS (SELECT k / 10.0 - 0.05 AS p FROM range(1, 11) AS r(k))
  SELECT round(p, 2) AS p, round(sum(fpatt * (CASE WHEN x = 1 THEN ln(p) ELSE ln(1 - p) END)), 4) + 0.0 AS lnl FROM v, g GROUP BY p""")
def _(s, d):
    return fitting.variable_share_grid(patterns(s, d), 10).select(F.round("p", 2).alias("p"), rounded("lnl", 4).alias("lnl"))


@query("calibration_density", f"SELECT o_orderkey AS node_id, round(-{lgamma(2.0)} + 2 * ln(3.0) + ln(age) - 3 * age, 6) + 0.0 AS ln_density FROM (SELECT o_orderkey, o_totalprice / 100000 AS age FROM orders WHERE o_totalprice > 0)")
def _(s, d):
    ages = ad.table(s, d, "orders").where("o_totalprice > 0").select(F.col("o_orderkey").alias("node_id"), (F.col("o_totalprice") / 100000).alias("age"))
    return ages.select("node_id", rounded(fitting.ln_gamma_density(F.col("age"), 2.0, 3.0)).alias("ln_density"))


@query("bound_densities", "WITH a AS (SELECT o_orderkey, o_totalprice / 100000 AS t FROM orders WHERE o_totalprice > 0), c AS (SELECT *, 0.95 / 2.0 AS h, 0.95 * 1 / (0.025 * 2.0) AS lo, 0.95 / (0.025 * 2.0) AS hi FROM a) SELECT o_orderkey AS node_id, round(CASE WHEN t < 1 THEN ln(0.025 * lo) + (lo - 1) * ln(t) WHEN t > 3 THEN ln(0.025 * hi) - hi * (t - 3) ELSE ln(h) END, 6) + 0.0 AS ln_density FROM c")
def _(s, d):
    ages = ad.table(s, d, "orders").where("o_totalprice > 0").select(F.col("o_orderkey").alias("node_id"), (F.col("o_totalprice") / 100000).alias("age"))
    return ages.select("node_id", rounded(fitting.ln_bound_density(F.col("age"), 1.0, 3.0, 0.025, 0.025)).alias("ln_density"))


@query("count_trees", "SELECT l_orderkey AS dataset_id, count(DISTINCT l_suppkey) AS ns, round(coalesce(product(f), 1)) AS n_trees FROM (SELECT l_orderkey, l_suppkey, CASE WHEN k >= 3 THEN 2.0 * k - 3 ELSE 1 END * CASE WHEN k = 2 THEN 1 ELSE 1 END AS f FROM (SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) AS k FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem))) GROUP BY 1")
def _(s, d):
    sizes = ad.table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("dataset_id")).agg(F.countDistinct("l_suppkey").alias("ns"))
    return sizes.withColumn("n_trees", fitting.count_trees(F.col("ns"), rooted=True))


@query("pt_jc69", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(0.25 + 0.75 * exp(-4.0 / 3 * l_discount), 6) + 0.0 AS p_same, round(0.25 - 0.25 * exp(-4.0 / 3 * l_discount), 6) + 0.0 AS p_other FROM lineitem")
def _(s, d):
    same, other = fitting.pt_jc69(F.col("l_discount"), 4)
    return ad.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rounded(same).alias("p_same"), rounded(other).alias("p_other"))


@query("pt_k80", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(0.25 + 0.25 * exp(-4 * l_discount / 4.0) + 0.5 * exp(-2 * l_discount * 3.0 / 4.0), 6) + 0.0 AS p_same, round(0.25 + 0.25 * exp(-4 * l_discount / 4.0) - 0.5 * exp(-2 * l_discount * 3.0 / 4.0), 6) + 0.0 AS p_transition, round(0.25 - 0.25 * exp(-4 * l_discount / 4.0), 6) + 0.0 AS p_transversion FROM lineitem")
def _(s, d):
    cells = dict(zip(("p_same", "p_transition", "p_transversion"), fitting.pt_k80(F.col("l_discount"), 2.0), strict=True))
    return ad.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[rounded(c).alias(n) for n, c in cells.items()])


@query("all_patterns", f"""WITH s(x) AS (VALUES ('T'), ('C'), ('A'), ('G')), {v.PATTERNS}, every AS (SELECT a.x || b.x || c.x || d.x || e.x AS pattern FROM s a, s b, s c, s d, s e)
  SELECT pattern, CAST(coalesce(fpatt, 0) AS BIGINT) AS n FROM every LEFT JOIN patterns USING (pattern)""")
def _(s, d):
    return fitting.all_patterns(s, patterns(s, d), 5)


# Trees over the alignment

TREE = "((1,2),(3,4),5)"


CHANGES = f"""WITH RECURSIVE {v.PATTERNS}, c AS (SELECT pattern, fpatt, x FROM patterns, (VALUES ('T'), ('C'), ('A'), ('G')) AS s(x)),
  tip AS (SELECT pattern, fpatt, x, k, CASE WHEN substr(pattern, k, 1) = x OR substr(pattern, k, 1) = '-' THEN 0 ELSE 1000 END AS cost FROM c, range(1, 6) AS r(k)),
  up AS (SELECT pattern, fpatt, x, k, least(cost, min(cost) OVER (PARTITION BY pattern, k) + 1) AS cost FROM tip),
  inner_nodes AS (SELECT pattern, fpatt, x, CASE WHEN k IN (1, 2) THEN 'a' ELSE 'b' END AS node, sum(cost) AS cost FROM up WHERE k < 5 GROUP BY ALL),
  up2 AS (SELECT pattern, fpatt, x, least(cost, min(cost) OVER (PARTITION BY pattern, node) + 1) AS cost FROM inner_nodes UNION ALL SELECT pattern, fpatt, x, cost FROM up WHERE k = 5),
  root AS (SELECT pattern, fpatt, x, sum(cost) AS cost FROM up2 GROUP BY ALL), best AS (SELECT pattern, fpatt, min(cost) AS changes FROM root GROUP BY ALL)"""


@query("parsimony_score", CHANGES + " SELECT pattern, fpatt, CAST(changes AS INT) AS changes FROM best")
def _(s, d):
    return fitting.parsimony_changes(patterns(s, d), TREE)


@query("change_histogram", CHANGES + " SELECT CAST(changes AS INT) AS changes, CAST(sum(fpatt) AS BIGINT) AS n_sites FROM best GROUP BY 1")
def _(s, d):
    return fitting.change_histogram(fitting.parsimony_changes(patterns(s, d), TREE))


@query("pattern_likelihoods", None)
def _(s, d):
    return fitting.pattern_likelihoods(patterns(s, d), TREE, 0.05, kappa=2.0, alpha=0.5, classes=4)


@query("ancestral_states", None)
def _(s, d):
    return fitting.ancestral_states(patterns(s, d), TREE, 0.05, kappa=2.0)


@query("ml_fits", None)
def _(s, d):
    """Each partition on each tree: all partitions share the jobs of a tree."""
    from cladeworks.functions.scores import Spec
    from cladeworks.operators import likelihood

    blocks = likelihood.spread(al.site_patterns(ad.alignment(s, d), ((F.col("site") - 1) % 3).cast("int")).withColumnRenamed("partition_id", "locus"))
    fits = [likelihood.fit_blocks(blocks, t, Spec("bases", "K80"), tolerance=0.001).select(F.col("locus").alias("partition_id"), F.lit(k).alias("tree_id"), rounded("lnl", 2).alias("lnl"), rounded("tree_length", 2).alias("tree_length"), "converged") for k, t in enumerate([TREE, "((1,3),(2,4),5)", "((1,4),(2,3),5)"])]
    return fits[0].unionAll(fits[1]).unionAll(fits[2])


@query("bootstrap_sites", None)
def _(s, d):
    return resampling.bootstrap_patterns(al.site_patterns(ad.alignment(s, d), ((F.col("site") - 1) % 3).cast("int")), 20)


@query("rell", None)
def _(s, d):
    return resampling.rell(ad.site_likelihoods(s, d), 200)


@query("jackknife_sites", f"""WITH {v.COLUMNS}, b AS (SELECT site % 10 AS block, pattern FROM cols), t AS (SELECT block, count(*) AS n FROM b GROUP BY 1), x AS (SELECT block, count(*) FILTER (len(list_distinct(string_split(pattern, ''))) > 1) AS v FROM b GROUP BY 1)
  SELECT t.block AS left_out, round(((SELECT sum(v) FROM x) - v) / ((SELECT sum(n) FROM t) - n), 6) + 0.0 AS share FROM t JOIN x USING (block)""")
def _(s, d):
    columns = al.columns_of(ad.alignment(s, d), "site")
    return resampling.jackknife_variable(columns, F.col("site") % 10).withColumn("share", rounded("share"))


# Further summaries


@query("nonempty_taxa", f"WITH {v.ALIGNMENT} SELECT taxon_id, count(*) AS n_known FROM alignment WHERE state <> '-' GROUP BY 1")
def _(s, d):
    return al.nonempty_taxa(ad.alignment(s, d))


@query("induced_subtree", f"""WITH {v.PATHS}, tips AS (SELECT node_id FROM nodes WHERE is_tip AND node_id % 7 = 0), alive AS (SELECT DISTINCT ancestor_id AS node_id FROM paths WHERE node_id IN (SELECT node_id FROM tips)),
  kept AS (SELECT father_id AS node_id FROM nodes JOIN alive USING (node_id) WHERE father_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1 UNION SELECT node_id FROM tips),
  up AS (SELECT p.node_id, p.ancestor_id, p.length, row_number() OVER (PARTITION BY p.node_id ORDER BY steps) AS k FROM paths p JOIN kept a ON a.node_id = p.node_id JOIN kept b ON b.node_id = p.ancestor_id WHERE steps > 0)
  SELECT kept.node_id, ancestor_id AS father_id, round(length, 6) + 0.0 AS branch_length FROM kept LEFT JOIN up ON up.node_id = kept.node_id AND k = 1""")
def _(s, d):
    nodes = ad.tree_nodes(s, d)
    out = trees.induced_subtree(nodes, trees.closure(nodes), nodes.where("is_tip and node_id % 7 = 0").select("node_id"))
    return out.withColumn("branch_length", rounded("branch_length"))


@query("nearest_clade_label", f"WITH {v.PATHS}, labels AS (SELECT node_id, node_id % 4 AS label FROM nodes WHERE NOT is_tip AND (node_id < 100 OR node_id % 3 = 0)), m AS (SELECT p.node_id, label, row_number() OVER (PARTITION BY p.node_id ORDER BY steps) AS k FROM paths p JOIN labels l ON l.node_id = p.ancestor_id) SELECT node_id, label FROM m WHERE k = 1")
def _(s, d):
    nodes = ad.tree_nodes(s, d)
    labels = nodes.where("not is_tip and (node_id < 100 or node_id % 3 = 0)").select("node_id", (F.col("node_id") % 4).alias("label"))
    return trees.nearest_labels(trees.closure(nodes), labels)


@query("age_ranks", "SELECT o_custkey AS tree_id, o_orderkey AS node_id, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rank FROM orders")
def _(s, d):
    ages = ad.table(s, d, "orders").select(F.col("o_custkey").alias("tree_id"), F.col("o_orderkey").alias("node_id"), F.col("o_totalprice").alias("age"))
    return trees.age_ranks(ages)


@query("tree_lnl", "SELECT o_orderkey % 3 AS tree_id, round(sum((o_custkey % 5) * -ln(1 + o_totalprice / 1000)), 4) + 0.0 AS lnl FROM orders WHERE o_custkey % 5 > 0 GROUP BY 1")
def _(s, d):
    rows = ad.table(s, d, "orders").select((F.col("o_orderkey") % 3).alias("tree_id"), (F.col("o_custkey") % 5).alias("fpatt"), (-F.log1p(F.col("o_totalprice") / 1000)).alias("lnf"))
    return samples.tree_lnl(rows, "tree_id").withColumn("lnl", rounded("lnl", 4))


@query("power_posterior", "WITH m AS (SELECT o_orderstatus AS model, o_orderpriority AS point, avg(-o_totalprice / 1e5) AS mean FROM orders GROUP BY 1, 2) SELECT model, round(sum(CAST(substr(point, 1, 1) AS INT) / 15.0 * mean) / 2, 6) + 0.0 AS ln_m FROM m GROUP BY model")
def _(s, d):
    rows = ad.table(s, d, "orders").select(F.col("o_orderstatus").alias("model"), F.col("o_orderpriority").alias("point"), (F.substring("o_orderpriority", 1, 1).cast("int") / 15.0).alias("weight"), (-F.col("o_totalprice") / 1e5).alias("lnl"))
    return samples.power_posterior(rows).withColumn("ln_m", rounded("ln_m"))


@query("quadratic_lnl", """WITH z AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS z FROM embeddings)
  SELECT vec_id, round(list_sum(list_transform(z, lambda x, i: x * (1.5 - 0.05 * (i - 1)))) + (list_sum(list_transform(z, lambda x, i: -2.0 * x * x)) + 0.5 * list_sum(list_transform(z[2:], lambda x, i: x * z[i]))) / 2, 6) + 0.0 AS lnl FROM z""")
def _(s, d):
    rows = ad.table(s, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("z"))
    size = 64
    hessian = [[-2.0 if i == j else 0.25 if abs(i - j) == 1 else 0.0 for j in range(size)] for i in range(size)]
    return samples.quadratic_lnl(rows, [1.5 - 0.05 * k for k in range(size)], hessian).select("vec_id", rounded("lnl").alias("lnl"))


@query("trait_contrasts", """WITH p AS (SELECT a.vec_id // 2 AS node_id, a.embedding AS x, b.embedding AS y, 0.1 * (a.label + 1) + 0.1 * (b.label + 1) AS v FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0)
  SELECT node_id, round(-0.5 * len(x) * ln(2 * pi() * v) - list_sum(list_transform(list_zip(x, y), lambda z: pow(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE), 2))) / (2 * v), 5) + 0.0 AS ln_density FROM p""")
def _(s, d):
    rows = ad.table(s, d, "embeddings").select(F.expr("vec_id div 2").alias("node_id"), (F.col("vec_id") % 2).alias("side"), F.col("embedding").cast("array<double>").alias("x"), (0.1 * (F.col("label") + 1)).alias("v"))
    one = lambda k: rows.where(F.col("side") == k).select("node_id", F.col("x").alias(f"x{k + 1}"), F.col("v").alias(f"v{k + 1}"))
    return samples.trait_contrasts(one(0).join(one(1), "node_id")).withColumn("ln_density", rounded("ln_density", 5))


@query("state_freq_em", f"""WITH RECURSIVE {v.ALIGNMENT}, c AS (SELECT CASE WHEN site % 11 = 0 THEN translate(state, 'TA', 'YR') ELSE state END AS x FROM alignment),
  n AS (SELECT count(*) FILTER (x = 'T') AS t, count(*) FILTER (x = 'C') AS c, count(*) FILTER (x = 'A') AS a, count(*) FILTER (x = 'G') AS g, count(*) FILTER (x = 'Y') AS y, count(*) FILTER (x = 'R') AS r FROM c),
  em AS (SELECT 0 AS k, CAST(0.25 AS DOUBLE) AS ft, CAST(0.25 AS DOUBLE) AS fc, CAST(0.25 AS DOUBLE) AS fa, CAST(0.25 AS DOUBLE) AS fg
    UNION ALL SELECT k + 1, (t + y * ft / (ft + fc)) / (t + c + a + g + y + r), (c + y * fc / (ft + fc)) / (t + c + a + g + y + r), (a + r * fa / (fa + fg)) / (t + c + a + g + y + r), (g + r * fg / (fa + fg)) / (t + c + a + g + y + r) FROM em, n WHERE k < 20)
  SELECT state, round(freq, 6) + 0.0 AS freq FROM (SELECT unnest(['T', 'C', 'A', 'G']) AS state, unnest([ft, fc, fa, fg]) AS freq FROM em WHERE k = 20)""")
def _(s, d):
    freqs = al.frequencies_by_em(ad.alignment(s, d).withColumn("state", F.when(F.col("site") % 11 == 0, F.translate("state", "TA", "YR")).otherwise(F.col("state"))))
    return s.createDataFrame(list(zip("TCAG", freqs, strict=True)), "state string, freq double").withColumn("freq", rounded("freq"))


def cherries(tree: str) -> list[int]:
    """Five tips of an unrooted tree as two pairs and the tip between them."""
    nodes = parse_newick(tree)
    below = {}
    for n in reversed(nodes):
        below[n.node_id] = frozenset().union(*(below[s] for s in n.sons)) if n.sons else frozenset([int(n.name)])
    every = below[0]
    pairs = sorted({tuple(sorted(x)) for n in nodes for x in (below[n.node_id], every - below[n.node_id]) if len(x) == 2})
    return [x for p in pairs for x in p] + sorted(every - {x for p in pairs for x in p})


FIVE = fitting.all_topologies(5)
BITS = lambda tip: f"CASE substr(pattern, {tip}, 1) WHEN 'T' THEN 1 WHEN 'C' THEN 2 WHEN 'A' THEN 4 WHEN 'G' THEN 8 ELSE 15 END"
MET = lambda x, y: f"CASE WHEN {x} & {y} > 0 THEN {x} & {y} ELSE {x} | {y} END"


@query("parsimony_search", f"""WITH {v.PATTERNS}, trees(tree, a, b, c, d, e) AS (VALUES {", ".join(f"('{t}', {', '.join(map(str, cherries(t)))})" for t in FIVE)}),
  tips AS (SELECT tree, fpatt, {", ".join(f"{BITS(x)} AS {x}" for x in "abcde")} FROM patterns, trees),
  pairs AS (SELECT *, {MET("a", "b")} AS p, {MET("c", "d")} AS q, CAST(a & b = 0 AS INT) + CAST(c & d = 0 AS INT) AS n FROM tips),
  joined AS (SELECT *, {MET("p", "q")} AS r, n + CAST(p & q = 0 AS INT) AS m FROM pairs),
  scores AS (SELECT tree, CAST(sum(fpatt * (m + CAST(r & e = 0 AS INT))) AS BIGINT) AS score FROM joined GROUP BY tree)
  SELECT tree, score, score = (SELECT min(score) FROM scores) AS best FROM scores""")
def _(s, d):
    return fitting.parsimony_search(patterns(s, d), FIVE)


@query("dating_chains", None)
def _(s, d):
    pairs = pairwise.pair_counts(patterns(s, d)).groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") != F.col("b"), F.col("n")).otherwise(0)).alias("differ"))
    return fitting.dating_chains(pairs)


@query("codon_pair_fits", None)
def _(s, d):
    return fitting.codon_pair_fits(pairwise.codon_pairs(codon_rows(s, d)))
