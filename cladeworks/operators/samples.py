"""Summaries of parameter samples, runs, site likelihoods and posteriors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladeworks.functions.frames import ranked, tasks_for, written


def long_samples(wide: DataFrame, parameters: list[str]) -> DataFrame:
    """(param, value) rows."""
    return wide.unpivot([], parameters, "param", "value") if not set(wide.columns) - set(parameters) else wide.select(*[F.col(p).cast("double") for p in parameters]).unpivot([], parameters, "param", "value")


def by_rank(values: DataFrame) -> DataFrame:
    """(param, value, rank from 0 within param, n), ranked over range partitions: no parameter, and no value that many rows share, meets in one task."""
    numbered = ranked(values.select("param", "value", F.monotonically_increasing_id().alias("_tie")), [F.col("param"), F.col("value"), F.col("_tie")], tasks=tasks_for(values)).drop("_tie")
    counts = values.groupBy("param").agg(F.count("*").alias("n"))
    before = W.orderBy("param").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))  # one row per parameter
    return numbered.join(F.broadcast(offsets), "param").select("param", "value", (F.col("rank") - 1 - F.col("skip")).alias("rank"), "n")


def summaries(values: DataFrame) -> DataFrame:
    """(param, n, mean, variance, median, least, most, q005, q025, q975, q995): quantiles are the values at place floor(n q)."""
    # equal values are counted where they are, and only different ones are sorted
    counts = written(values.groupBy("param", "value").agg(F.count("*").alias("times")), "counted")
    placed = ranked(counts, [F.col("param"), F.col("value")], F.col("times"), tasks_for(counts))
    plain = values.groupBy("param").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance"), F.min("value").alias("least"), F.max("value").alias("most"))
    plain = written(plain, "plain")  # one row per parameter
    before = W.orderBy("param").rowsBetween(W.unboundedPreceding, -1)
    totals = plain.select("param", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    end = F.col("running") - F.col("skip")
    n = F.col("n")
    at = lambda place: F.max(F.when((place < end) & (place >= end - F.col("times")), F.col("value")))
    # the median averages the two in the middle
    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    quantiles = placed.join(F.broadcast(totals), "param").groupBy("param").agg(middle.alias("median"), *[at(F.floor(n * q)).alias(c) for c, q in (("q005", 0.005), ("q025", 0.025), ("q975", 0.975), ("q995", 0.995))])
    return plain.join(quantiles, "param").select("param", "n", "mean", "variance", "median", "least", "most", "q005", "q025", "q975", "q995")


def hpd(values: DataFrame, mass: float = 0.95) -> DataFrame:
    """(param, low, high): the shortest interval that holds ``mass`` of the values; the lowest of equals."""
    placed = written(by_rank(values), "placed")
    low = placed.select("param", "rank", F.col("value").alias("low"), (F.col("rank") + F.floor(F.col("n") * mass)).alias("end"))
    high = placed.select("param", F.col("rank").alias("end"), F.col("value").alias("high"))
    spans = low.join(high, ["param", "end"])
    best = spans.groupBy("param").agg(F.min(F.struct((F.col("high") - F.col("low")).alias("width"), "low", "high")).alias("best"))
    return best.select("param", "best.low", "best.high")


def lag_one(chains: DataFrame, value: str) -> DataFrame:
    """(chain, n, rho): the correlation of each value with the one before it, around the chain's mean."""
    rows = centred(chains, value, 1)
    return rows.groupBy("chain", "n").agg((F.sum(F.col("d") * F.col("d1")) / F.sum(F.col("d") * F.col("d"))).alias("rho")).where("rho is not null")


def centred(chains: DataFrame, value: str, lags: int) -> DataFrame:
    """(chain, n, d, d1, d2, ...): each value less its chain's mean, and those before it. One sort: means come from the same window, not from a join."""
    each = chains.where("chain is not null").select("chain", "iteration", F.col(value).alias("x"))
    order = W.partitionBy("chain").orderBy("iteration")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = [F.lag("x", k).over(order).alias(f"x{k}") for k in range(1, lags + 1)]
    rows = each.repartition(tasks_for(each), "chain").select("chain", "x", F.count("*").over(whole).alias("n"), F.avg("x").over(whole).alias("mean"), *before)
    return rows.select("chain", "n", (F.col("x") - F.col("mean")).alias("d"), *[(F.col(f"x{k}") - F.col("mean")).alias(f"d{k}") for k in range(1, lags + 1)])


def best_runs(runs: DataFrame) -> DataFrame:
    """(index, run, lnl): the run of highest likelihood of each index; the first of equals."""
    best = runs.groupBy("index").agg(F.min(F.struct((-F.col("lnl")).alias("minus"), "run")).alias("best"))
    return best.select("index", "best.run", (-F.col("best.minus")).alias("lnl"))


def confusion(truth: DataFrame, inferred: DataFrame) -> DataFrame:
    """(true_positive, false_positive, false_negative) over sites, by full outer join."""
    both = truth.select("site", F.lit(1).alias("t")).join(inferred.select("site", F.lit(1).alias("i")), "site", "full")
    count = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0)).cast("long")
    t, i = F.col("t").isNotNull(), F.col("i").isNotNull()
    return both.agg(count(t & i).alias("true_positive"), count(~t & i).alias("false_positive"), count(t & ~i).alias("false_negative"))


def kh_test(site_lnl: DataFrame) -> DataFrame:
    """(tree_id, lnl, delta, se): differences from the best tree and their standard errors over sites.

    Rows (tree_id, site, lnf); sites of all trees.
    """
    totals = written(site_lnl.groupBy("tree_id").agg(F.sum("lnf").alias("lnl"), F.count("*").alias("n")), "totals")
    best = totals.agg(F.min(F.struct((-F.col("lnl")).alias("minus"), "tree_id")).alias("b")).select(F.col("b.tree_id").alias("best_id"))
    of_best = site_lnl.join(F.broadcast(best), F.col("tree_id") == F.col("best_id")).select("site", F.col("lnf").alias("best_lnf"))
    gaps = site_lnl.join(of_best, "site").withColumn("gap", F.col("lnf") - F.col("best_lnf"))
    sums = gaps.groupBy("tree_id").agg(F.sum("gap").alias("delta"), F.var_pop("gap").alias("v"), F.count("*").alias("n"))
    return totals.drop("n").join(sums, "tree_id").select("tree_id", "lnl", "delta", F.sqrt(F.col("v") * F.col("n")).alias("se"))


def mixture_lnl(rows: DataFrame) -> DataFrame:
    """(site, lnl): ln of sum over classes of weight times exp(lnf), safe from underflow; rows (site, weight, lnf)."""
    top = rows.groupBy("site").agg(F.max("lnf").alias("top"))
    return rows.join(top, "site").groupBy("site", "top").agg(F.sum(F.col("weight") * F.exp(F.col("lnf") - F.col("top"))).alias("s")).select("site", (F.col("top") + F.log("s")).alias("lnl"))


def class_posteriors(rows: DataFrame) -> DataFrame:
    """(site, class, posterior) for rows (site, class, weight, lnf): the empirical Bayes probabilities of classes."""
    total = mixture_lnl(rows)
    return rows.join(total, "site").select("site", "class", (F.col("weight") * F.exp(F.col("lnf") - F.col("lnl"))).alias("posterior"))


def selected_sites(posteriors: DataFrame, positive: Column) -> DataFrame:
    """(site, p, mark): sites whose classes with omega over 1 have over half; * over 0.95, ** over 0.99."""
    p = posteriors.groupBy("site").agg(F.sum(F.when(positive, F.col("posterior")).otherwise(0.0)).alias("p"))
    return p.where("p > 0.5").select("site", "p", F.when(F.col("p") > 0.99, "**").when(F.col("p") > 0.95, "*").otherwise("").alias("mark"))


def tree_lnl(patterns_lnf: DataFrame, *keys: str) -> DataFrame:
    """(*keys, lnl): the sum of pattern counts times ln f; patterns that don't occur add nothing."""
    return patterns_lnf.where("fpatt > 0").groupBy(*keys).agg(F.sum(F.col("fpatt") * F.col("lnf")).alias("lnl"))


def power_posterior(samples: DataFrame) -> DataFrame:
    """(model, ln_m): half the weighted sum of mean log-likelihoods over the points of a quadrature (model, point, weight, lnl)."""
    means = samples.groupBy("model", "point").agg(F.avg("lnl").alias("mean"), F.first("weight").alias("weight"))
    return means.groupBy("model").agg((F.sum(F.col("weight") * F.col("mean")) / 2).alias("ln_m"))


def quadratic_lnl(rows: DataFrame, gradient: list[float], hessian: list[list[float]]) -> DataFrame:
    """Add ``lnl``: z g + z H z / 2 for the vectors ``z``."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    bent = F.transform(F.lit(hessian), lambda row: dot(row, F.col("z")))
    return rows.withColumn("lnl", dot(F.col("z"), F.lit(gradient)) + dot(F.col("z"), bent) / 2)


def trait_contrasts(pairs: DataFrame) -> DataFrame:
    """(node_id, ln_density) of two sons' trait vectors x1 and x2 at distances v1 and v2."""
    m, v = F.size("x1"), F.col("v1") + F.col("v2")
    squares = F.aggregate(F.zip_with("x1", "x2", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    return pairs.select("node_id", (-0.5 * m * F.log(2 * F.lit(3.141592653589793) * v) - squares / (2 * v)).alias("ln_density"))


def best_class(posteriors: DataFrame) -> DataFrame:
    """(site, class, posterior): the most probable class of each site; the first of equals."""
    best = posteriors.groupBy("site").agg(F.min(F.struct((-F.round("posterior", 9)).alias("minus"), "class", "posterior")).alias("b"))
    return best.select("site", "b.class", "b.posterior")


def score_products(rows: DataFrame) -> DataFrame:
    """(i, j, value), j <= i: the sum over patterns of fpatt g g', which stands for the Hessian of a likelihood; rows (fpatt, gradient).

    Products are made and summed up within tasks before they are shuffled: as many rows as the matrix has.
    """
    pairs = F.flatten(F.transform("gradient", lambda x, i: F.transform(F.slice("gradient", F.lit(1), i + 1), lambda y, j: F.struct((i + 1).alias("i"), (j + 1).alias("j"), (x * y).alias("p")))))
    return rows.select("fpatt", F.explode(pairs).alias("c")).groupBy("c.i", "c.j").agg(F.sum(F.col("fpatt") * F.col("c.p")).alias("value"))


def autocorrelation_time(chains: DataFrame, value: str, lags: int = 50, least: float = 0.05) -> DataFrame:
    """(chain, n, tau): 1 plus twice the sum of the autocorrelations up to the first one below ``least``; n / tau samples are worth independent ones."""
    rows = centred(chains, value, lags)
    rho = [F.coalesce(F.sum(F.col("d") * F.col(f"d{k}")), F.lit(0.0)) / F.sum(F.col("d") * F.col("d")) for k in range(1, lags + 1)]
    found = rows.groupBy("chain", "n").agg(F.sum(F.col("d") * F.col("d")).alias("ss"), F.array(*rho).alias("rho")).where("ss > 0")
    stop = F.array_position(F.transform("rho", lambda r: F.round(r, 9) < least), True)
    kept = F.when(stop > 0, F.slice("rho", F.lit(1), (stop - 1).cast("int"))).otherwise(F.col("rho"))
    return found.select("chain", "n", (1 + 2 * F.aggregate(kept, F.lit(0.0), lambda acc, r: acc + r)).alias("tau"))
