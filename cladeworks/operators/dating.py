"""Dating on a tree: chains over node ages and rates side by side, in versions that a lost run resumes from."""

from __future__ import annotations

import json
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.functions.dating import Chain, Locus, Prior, State
from cladeworks.sources.newick import parse_newick, tree_rows
from cladeworks.sources.textfiles import calibrations

SAMPLE = "struct<iteration:long,lnl:double,ln_prior:double,ages:array<double>,means:array<double>,variances:array<double>>"
VERSION = f"dataset int, chain int, state string, samples array<{SAMPLE}>"


def calibrated_nodes(spark: SparkSession, tree: str) -> dict[int, tuple[str, list[float]]]:
    """node -> (kind, numbers) of the calibrations in a tree's text; as many rows as the tree has nodes."""
    rows = calibrations(tree_rows(spark.createDataFrame([(1, tree)], "tree_id int, newick string")))
    return {r.node_id: (r.kind, list(r.numbers)) for r in rows.where("kind is not null and not is_tip").select("node_id", "kind", "numbers").collect()}


def advanced(blocks: DataFrame, states: DataFrame | None, tree: str, calibrated: dict, prior: Prior, chains: int, steps: int, every: int, tune: bool, use_data: bool, seed: int) -> DataFrame:
    """(dataset, chain, state, samples): each chain gone ``steps`` iterations further, one task a chain of a data set.

    A task holds its data set's loci, of which each is a vector and a matrix as wide as the tree has branches; chains are sequential by
    nature, so data sets and chains are what runs side by side.
    """

    def run(key, pdf):
        rooted = parse_newick(tree)
        pdf = pdf.sort_values("locus")
        loci = [Locus(rooted, t, list(b), list(g), [list(row) for row in h], prior) for t, b, g, h in zip(pdf["tree"], pdf["b"], pdf["g"], pdf["h"], strict=True)]
        chain = Chain(tree, calibrated, loci, prior, use_data)
        text = pdf["state"].iloc[0]
        state = State(**json.loads(text)) if text else chain.start([seed, int(key[0]), int(key[1])])
        samples = chain.run(state, steps, every, tune)
        return pd.DataFrame({"dataset": [key[0]], "chain": [key[1]], "state": [json.dumps(asdict(state))], "samples": [samples]})

    rows = blocks.select("dataset", "locus", "tree", "b", "g", "h").withColumn("chain", F.explode(F.sequence(F.lit(0), F.lit(chains - 1))))
    if states is None:
        rows = rows.withColumn("state", F.lit(None).cast("string"))
    else:
        rows = rows.join(states.select("dataset", "chain", "state"), ["dataset", "chain"])
    return rows.groupBy("dataset", "chain").applyInPandas(run, VERSION)


def version_path(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/version={version:05d}"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a version was committed: Spark puts the mark there last."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def dating_samples(blocks: DataFrame, tree: str, folder: str, prior: Prior | None = None, chains: int = 2, burn_in: int = 2000, samples: int = 2000, every: int = 10, versions: int = 4, use_data: bool = True, seed: int = 1, stop_after: int | None = None) -> DataFrame:
    """(dataset, chain, iteration, lnl, ln_prior, ages, means, variances): chains over the ages of a rooted tree under its calibrations.

    ``blocks`` are rows (dataset, locus, tree, b, g, h) as ``branch_file`` reads or ``branch_curvature`` makes them: each locus' unrooted
    tree has the rooted one's tips and splits. The likelihood is quadratic in transformed branch lengths; calibrations, such as
    ``'B(0.06, 0.08)'`` or ``'>0.06<0.08'``, follow nodes of ``tree``, fixed ages (``'@0.07'``) stay. ``ages`` are those of inner nodes in order of
    appearance, ``means`` and ``variances`` those of loci.

    The first of ``versions`` holds the burn-in, the others as many samples each. A version is one table in ``folder``, with each
    chain's whole state (its random numbers' too), and a run goes on behind the last that was committed: what it gives doesn't
    depend on where it was stopped. ``stop_after`` ends it there. Without blocks there is no chain.
    """
    spark, prior = blocks.sparkSession, prior or Prior()
    calibrated = calibrated_nodes(spark, tree)
    if 0 not in calibrated:
        raise ValueError("the root needs a calibration")
    share = samples * every // max(versions - 1, 1)
    for version in range(versions if stop_after is None else min(versions, stop_after)):
        path = version_path(folder, version)
        if is_written(spark, path):
            continue
        before = spark.read.schema(VERSION).parquet(version_path(folder, version - 1)) if version else None
        steps = share if version else burn_in
        made = advanced(blocks, before, tree, calibrated, prior, chains, steps, every if version else 0, not version, use_data, seed)
        made.write.mode("overwrite").parquet(path)
    done = [path for path in (version_path(folder, v) for v in range(1, versions)) if is_written(spark, path)]
    if not done:
        done = [version_path(folder, 0)]
    found = spark.read.schema(VERSION).parquet(*done)
    return found.select("dataset", "chain", F.explode("samples").alias("s")).select("dataset", "chain", "s.*")


def age_summary(samples: DataFrame, tree: str) -> DataFrame:
    """(dataset, node_id, n, mean, sd, low, high): each inner node's age over all chains, with its central 95 %."""
    inner = [n.node_id for n in parse_newick(tree) if n.sons]
    rows = samples.select("dataset", F.posexplode("ages").alias("at", "age"))
    node = F.element_at(F.array(*map(F.lit, inner)), F.col("at") + 1)
    return rows.groupBy("dataset", node.alias("node_id")).agg(F.count("*").alias("n"), F.avg("age").alias("mean"), F.stddev("age").alias("sd"), F.percentile("age", 0.025).alias("low"), F.percentile("age", 0.975).alias("high"))


def dated_tree(summary: DataFrame, tree: str) -> DataFrame:
    """(dataset, newick): the tree with mean ages as branch lengths and ``[&95%HPD={low, high}]`` behind inner nodes, for viewers of dated trees."""
    nodes = parse_newick(tree)

    def text(found: dict[int, tuple[float, float, float]], k: int) -> str:
        n = nodes[k]
        age = found[k][0] if n.sons else 0.0
        inner = f"({', '.join(text(found, s) for s in n.sons)}) [&95%HPD={{{found[k][1]:.6g}, {found[k][2]:.6g}}}]" if n.sons else n.name
        return inner + (f": {found[n.father][0] - age:.6f}" if k else ";")

    @F.udf("string")
    def written(rows):
        return text({r["node_id"]: (r["mean"], r["low"], r["high"]) for r in rows}, 0)

    listed = summary.groupBy("dataset").agg(F.collect_list(F.struct("node_id", "mean", "low", "high")).alias("rows"))
    return listed.select("dataset", written("rows").alias("newick"))
