"""Bootstrap and jackknife over sites."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def uniform(*parts: Column) -> Column:
    """A draw in [0, 1) that is a hash of its parts, so that a lost task draws the same again."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / float(1 << 53)


def bootstrap_patterns(patterns: DataFrame, replicates: int, seed: int = 1, blocks: int = 64) -> DataFrame:
    """(replicate, partition_id, pattern, fpatt): as many sites as a partition (partition_id, pattern, fpatt) has, drawn with replacement; patterns that aren't drawn are left out.

    Counts are exactly multinomial, whatever the counts of sites: for each partition the totals of its blocks of patterns are drawn first, then
    within each block its patterns' counts, given its total. Draws are seeded by partition and block, so a lost task gives the same again.
    """
    kind = patterns.schema["partition_id"].dataType.simpleString()
    each = patterns.groupBy("partition_id", "pattern").agg(F.sum("fpatt").cast("long").alias("fpatt")).where("fpatt > 0")
    placed = each.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(blocks)).cast("int"))

    def rng_of(*parts):
        return np.random.default_rng([seed, *(zlib.crc32(str(x).encode()) for x in parts)])

    def totals(key, pdf):
        pdf = pdf.sort_values("block")
        n = pdf["n"].to_numpy()
        counts = rng_of(key[0]).multinomial(n.sum(), n / n.sum(), replicates)
        return pd.DataFrame({"partition_id": key[0], "block": pdf["block"], "totals": list(counts.T)})

    def counts(key, pdf):
        pdf = pdf.sort_values("pattern")
        n = pdf["fpatt"].to_numpy()
        drawn = rng_of(*key).multinomial(np.array(pdf["totals"].iloc[0]), n / n.sum())
        replicate, at = np.nonzero(drawn)
        return pd.DataFrame({"replicate": replicate + 1, "partition_id": key[0], "pattern": pdf["pattern"].to_numpy()[at], "fpatt": drawn[replicate, at]})

    sums = placed.groupBy("partition_id", "block").agg(F.sum("fpatt").alias("n"))
    of_blocks = sums.groupBy("partition_id").applyInPandas(totals, f"partition_id {kind}, block int, totals array<long>")
    both = placed.join(of_blocks, ["partition_id", "block"])
    return both.groupBy("partition_id", "block").applyInPandas(counts, f"replicate int, partition_id {kind}, pattern string, fpatt long")


def poisson_one(u: Column) -> Column:
    """A Poisson draw of mean 1 from a uniform one."""
    p, total, out = 0.36787944117144233, 0.0, F.lit(0)
    cuts = []
    for k in range(1, 12):
        total += p
        cuts.append(total)
        p /= k
    for c in cuts:
        out = out + (u >= c).cast("int")
    return out


def rell(site_lnl: DataFrame, replicates: int, seed: int = 1) -> DataFrame:
    """(tree_id, share): how often a tree is best when sites are resampled and nothing is fitted again; ties go to the smaller id.

    Rows (tree_id, site, lnf). Each site's weight in a replicate is a Poisson draw of its hash: the usual
    form of the bootstrap for data that are spread out, without a join.
    """
    every = F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")
    weighted = site_lnl.select("tree_id", "site", "lnf", every)
    sums = weighted.groupBy("replicate", "tree_id").agg(F.sum(F.col("lnf") * poisson_one(uniform(F.lit(seed), F.col("replicate"), F.col("site")))).alias("lnl"))
    wins = sums.groupBy("replicate").agg(F.min(F.struct((-F.col("lnl")).alias("minus"), "tree_id")).alias("best")).groupBy(F.col("best.tree_id").alias("tree_id")).agg(F.count("*").alias("n"))
    return wins.select("tree_id", (F.col("n") / replicates).alias("share"))


def jackknife_variable(columns: DataFrame, block: Column) -> DataFrame:
    """(left_out, share): the share of variable columns (site, pattern) when a block of sites is left out."""
    vary = (F.size(F.array_distinct(F.split("pattern", ""))) > 1).cast("int")
    blocks = columns.groupBy(block.alias("left_out")).agg(F.count("*").alias("n"), F.sum(vary).alias("v"))
    total = blocks.agg(F.sum("n").alias("all_n"), F.sum("v").alias("all_v"))
    return blocks.join(F.broadcast(total)).select("left_out", ((F.col("all_v") - F.col("v")) / (F.col("all_n") - F.col("n"))).alias("share"))
