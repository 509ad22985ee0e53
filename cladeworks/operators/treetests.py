"""Comparison of trees by resampled log-likelihoods: exact multinomial counts, drawn where the patterns are."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Patterns are dealt into so many blocks, whatever their number; replicates that a task draws at a time.
BLOCKS, TOGETHER = 256, 200


def resampled_lnl(rows: DataFrame, replicates: int, seed: int = 1, blocks: int = BLOCKS) -> DataFrame:
    """(replicate, tree, lnl, sites): log-likelihoods of trees over as many sites as there are, drawn anew with replacement.

    Rows (pattern, fpatt, lnf): a pattern's count and its ln f under each tree. The counts of a replicate are exactly multinomial: first
    the blocks' totals, which every task draws alike from one seed, then in each block its patterns', given its total. Tasks add
    up their blocks, so no row for each site, pattern or replicate is shuffled but one sum for each tree and replicate.
    """
    block = F.pmod(F.xxhash64("pattern"), F.lit(blocks)).cast("int")
    placed = rows.select(block.alias("block"), "pattern", "fpatt", "lnf")
    sums = {r.block: r.n for r in placed.groupBy("block").agg(F.sum("fpatt").alias("n")).collect()}
    names = sorted(k for k, n in sums.items() if n)
    total = sum(sums.values())
    shares = np.array([sums[k] for k in names], float) / max(total, 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["fpatt"] > 0].sort_values("pattern")
        if not len(pdf):
            return pd.DataFrame({"replicate": [], "tree": [], "lnl": [], "sites": []})
        block = int(pdf["block"].iloc[0])
        lnf, p = np.stack(pdf["lnf"].to_numpy()), pdf["fpatt"].to_numpy(float)
        p = p / p.sum()
        mine, out = names.index(block), []
        totals = np.random.default_rng([seed, 0])
        own = np.random.default_rng([seed, 1, block])
        for a in range(0, replicates, TOGETHER):
            n = totals.multinomial(total, shares, min(TOGETHER, replicates - a))[:, mine]
            counts = own.multinomial(n, p)
            made = counts @ lnf
            replicate, tree = np.indices(made.shape)
            out.append(pd.DataFrame({"replicate": replicate.ravel() + a, "tree": tree.ravel(), "lnl": made.ravel(), "sites": np.repeat(n, made.shape[1])}))
        return pd.concat(out)

    schema = "replicate int, tree int, lnl double, sites long"
    drawn = placed.groupBy("block").applyInPandas(run, schema)
    return drawn.groupBy("replicate", "tree").agg(F.sum("lnl").alias("lnl"), F.sum("sites").alias("sites"))


def tree_test(rows: DataFrame, replicates: int = 1000, seed: int = 1, blocks: int = BLOCKS) -> DataFrame:
    """(tree, lnl, behind, p_kh, p_sh, best_share) of rows (pattern, fpatt, lnf).

    ``behind`` is how far a tree's log-likelihood lies below the best one's. p_sh: the share of replicates, each tree's values centred on
    their mean, in which it lies as far behind that replicate's best; p_kh: as far behind the tree that is best on the data. best_share: the share of
    replicates in which a tree is best, ties to the first. The best tree itself has p values of one.
    """
    sums = rows.select("fpatt", F.posexplode("lnf").alias("tree", "v")).groupBy("tree").agg(F.sum(F.col("fpatt") * F.col("v")).alias("whole"))
    top = sums.agg(F.min(F.struct((-F.col("whole")).alias("minus"), "tree")).alias("top")).select(F.col("top.tree").alias("first"), (-F.col("top.minus")).alias("most"))
    drawn = resampled_lnl(rows, replicates, seed, blocks)
    means = drawn.groupBy("tree").agg(F.avg("lnl").alias("mean"))
    centred = drawn.join(means, "tree").join(sums, "tree").crossJoin(F.broadcast(top)).withColumn("centred", F.col("lnl") - F.col("mean"))
    by_replicate = centred.groupBy("replicate").agg(F.max("centred").alias("highest"), F.max(F.when(F.col("tree") == F.col("first"), F.col("centred"))).alias("leader"), F.min(F.struct((-F.col("lnl")).alias("minus"), "tree")).alias("winner"))
    both = centred.join(by_replicate, "replicate").withColumn("behind", F.col("most") - F.col("whole"))
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    sh, kh = F.col("highest") - F.col("centred") >= F.col("behind") - 1e-9, F.col("leader") - F.col("centred") >= F.col("behind") - 1e-9
    out = both.groupBy("tree").agg(F.first("whole").alias("lnl"), F.first("behind").alias("behind"), share(kh).alias("p_kh"), share(sh).alias("p_sh"), share(F.col("winner.tree") == F.col("tree")).alias("best_share"))
    return out
