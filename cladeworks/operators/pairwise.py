"""All pairs of taxa: state pairs, distances, and counting estimates of dN and dS."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeworks.functions.distances import distance
from cladeworks.functions.yn00 import estimate, pair_kappa, tables
from cladeworks.operators.alignment import columns_of


def pairs_of(patterns: DataFrame) -> DataFrame:
    """(i, j, a, b, fpatt) with i > j, from collapsed patterns: pairs arise within rows, without a join."""
    n = F.length("pattern")
    ordered = F.flatten(F.transform(F.sequence(F.lit(2), n), lambda i: F.transform(F.sequence(F.lit(1), i - 1), lambda j: F.struct(i.alias("i"), j.alias("j"), F.substring("pattern", i, F.lit(1)).alias("a"), F.substring("pattern", j, F.lit(1)).alias("b")))))
    return patterns.where(n > 1).select(F.explode(ordered).alias("p"), "fpatt").select("p.*", "fpatt")


def pair_counts(patterns: DataFrame) -> DataFrame:
    """(i, j, a, b, n): how often two taxa have states a and b, over sites at which both are known."""
    known = F.col("a").isin(*"TCAG") & F.col("b").isin(*"TCAG")
    return pairs_of(patterns).where(known).groupBy("i", "j", "a", "b").agg(F.sum("fpatt").alias("n"))


def pair_matrices(patterns: DataFrame) -> DataFrame:
    """One row per pair with the sixteen counts n_XY."""
    cell = lambda x, y: F.sum(F.when((F.col("a") == x) & (F.col("b") == y), F.col("n")).otherwise(0)).alias(f"n_{x}{y}")
    return pair_counts(patterns).groupBy("i", "j").agg(*[cell(x, y) for x in "TCAG" for y in "TCAG"])


def distances(patterns: DataFrame, model: str, alpha: float | None = None, legacy: bool = False) -> DataFrame:
    """(i, j, distance) for all pairs of taxa, i > j."""
    return pair_matrices(patterns).select("i", "j", distance(model, alpha, legacy).alias("distance"))


def codon_patterns(codon_table: DataFrame) -> DataFrame:
    """(pattern, fpatt): collapsed codon columns, three characters a taxon."""
    columns = codon_table.select("taxon_id", F.col("codon_site").alias("site"), F.col("codon").alias("state"))
    return columns_of(columns, "site").groupBy("pattern").agg(F.count("*").alias("fpatt"))


def codon_pairs(codon_table: DataFrame) -> DataFrame:
    """(i, j, codon_a, codon_b, n): collapsed codon columns, then pairs within rows."""
    patterns = codon_patterns(codon_table)
    n = F.expr("length(pattern) div 3")
    at = lambda k: F.substring("pattern", k * 3 - 2, F.lit(3))
    ordered = F.flatten(F.transform(F.sequence(F.lit(2), n.cast("int")), lambda i: F.transform(F.sequence(F.lit(1), i - 1), lambda j: F.struct(i.alias("i"), j.alias("j"), at(i).alias("codon_a"), at(j).alias("codon_b")))))
    rows = patterns.where(n > 1).select(F.explode(ordered).alias("p"), "fpatt").select("p.*", "fpatt")
    return rows.groupBy("i", "j", "codon_a", "codon_b").agg(F.sum("fpatt").alias("n"))


def corrected(p: Column) -> Column:
    return F.when(p < 0.75, -0.75 * F.log(1 - p * 4 / 3))


def ng86(codon_table: DataFrame, pair_table: DataFrame) -> DataFrame:
    """(i, j, s, n, ds, dn): sites averaged over both codons, changes over pathways; null beyond saturation."""
    met = codon_pairs(codon_table).join(F.broadcast(pair_table), ["codon_a", "codon_b"])  # 61 x 61 rows
    total = lambda c: F.sum(F.col(c) * F.col("n"))
    sums = met.groupBy("i", "j").agg(F.sum("n").alias("codons"), total("s_sites").alias("s0"), total("n_sites").alias("n0"), total("s_changes").alias("sd"), total("n_changes").alias("nd"))
    scale = 3 * F.col("codons") / (F.col("s0") + F.col("n0"))
    sums = sums.select("i", "j", (F.col("s0") * scale).alias("s"), (F.col("n0") * scale).alias("n"), "sd", "nd")
    return sums.select("i", "j", "s", "n", corrected(F.col("sd") / F.col("s")).alias("ds"), corrected(F.col("nd") / F.col("n")).alias("dn"))


def lwl85(codon_table: DataFrame, degeneracy: DataFrame, method: str = "lwl85") -> DataFrame:
    """(i, j, ds, dn) from transitions and transversions by degeneracy class; sites averaged over both codons.

    ``lwl85`` counts a third of the twofold sites as synonymous; ``lpb93`` pools the rates of the classes instead.
    """
    d = lambda side: F.broadcast(degeneracy.select(F.col("codon").alias(f"codon_{side}"), F.array("d1", "d2", "d3").alias(f"d_{side}")))
    met = codon_pairs(codon_table).join(d("a"), "codon_a").join(d("b"), "codon_b")
    three = F.explode(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.struct(F.substring("codon_a", k + 1, F.lit(1)).alias("a"), F.substring("codon_b", k + 1, F.lit(1)).alias("b"), F.get("d_a", k).alias("da"), F.get("d_b", k).alias("db"))))
    rows = met.select("i", "j", "n", three.alias("p")).select("i", "j", "n", "p.*")
    transition = F.concat("a", "b").isin("TC", "CT", "AG", "GA")
    sides = rows.select("i", "j", (F.col("n") / 2).alias("w"), F.explode(F.array("da", "db")).alias("k"), (transition & (F.col("a") != F.col("b"))).alias("ts"), (~transition & (F.col("a") != F.col("b"))).alias("tv"))
    sums = sides.groupBy("i", "j").agg(*[F.sum(F.when((F.col("k") == k) & cond, F.col("w")).otherwise(0.0)).alias(f"{name}{k}") for k in (0, 2, 4) for name, cond in (("l", F.lit(True)), ("ts", F.col("ts")), ("tv", F.col("tv")))])

    def parts(k: int) -> tuple[Column, Column]:
        p, q = F.col(f"ts{k}") / F.col(f"l{k}"), F.col(f"tv{k}") / F.col(f"l{k}")
        u, v = 1 - 2 * p - q, 1 - 2 * q
        return F.when((u > 0) & (v > 0), -0.5 * F.log(u) + 0.25 * F.log(v)), F.when(v > 0, -0.5 * F.log(v))

    (a0, b0), (a2, b2), (a4, b4) = parts(0), parts(2), parts(4)
    l0, l2, l4 = F.col("l0"), F.col("l2"), F.col("l4")
    if method == "lpb93":
        return sums.select("i", "j", ((l2 * a2 + l4 * a4) / (l2 + l4) + b4).alias("ds"), (a0 + (l0 * b0 + l2 * b2) / (l0 + l2)).alias("dn"))
    ds = (l2 * a2 + l4 * (a4 + b4)) / (l2 / 3 + l4)
    dn = (l2 * b2 + l0 * (a0 + b0)) / (l2 * 2 / 3 + l0)
    return sums.select("i", "j", ds.alias("ds"), dn.alias("dn"))


def count_matrix(pdf, code: str):
    """Counts of sense codons against each other; rows with anything else are left out."""
    found = tables(code)["at"]
    a, b = pdf["codon_a"].map(found), pdf["codon_b"].map(found)
    known = a.notna() & b.notna()
    out = np.zeros((len(found), len(found)))
    np.add.at(out, (a[known].astype(int), b[known].astype(int)), pdf["n"][known].to_numpy(float))
    return out


def pair_kappas(pairs: DataFrame, code: str = "universal") -> DataFrame:
    """(i, j, kappa, codons) of every pair (i, j, codon_a, codon_b, n): a group has as many rows as there are pairs of codons, at most."""

    def run(key, pdf):
        counts = count_matrix(pdf, code)
        return pd.DataFrame({"i": [key[0]], "j": [key[1]], "kappa": [pair_kappa(counts, code) if counts.sum() else np.nan], "codons": [int(counts.sum())]})

    return pairs.groupBy("i", "j").applyInPandas(run, "i int, j int, kappa double, codons long")


def pooled_kappa(kappas: DataFrame) -> DataFrame:
    """(kappa): the mean over pairs with a codon in common."""
    return kappas.where("codons > 0").agg(F.avg("kappa").alias("kappa"))


def yn00(pairs: DataFrame, code: str = "universal", weighted: bool = False, kappa: float | None = None) -> DataFrame:
    """(i, j, s, n, ds, dn, omega, t, kappa) of every pair: transition bias and codon frequencies are allowed for; kappa is pooled unless given."""
    kappa = kappa or pooled_kappa(pair_kappas(pairs, code)).first()["kappa"] or 2.0

    def run(key, pdf):
        counts = count_matrix(pdf, code)
        found = estimate(counts, kappa, code, weighted) if counts.sum() else dict.fromkeys(("s", "n", "ds", "dn", "omega", "t"), np.nan)
        return pd.DataFrame({"i": [key[0]], "j": [key[1]], **{k: [x] for k, x in found.items()}, "kappa": [kappa]})

    return pairs.groupBy("i", "j").applyInPandas(run, "i int, j int, s double, n double, ds double, dn double, omega double, t double, kappa double")
