"""Column collapse, filters and frequencies of alignments (taxon_id, site, state)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladeworks.functions.frames import ranked

BASES = "TCAG"


def canonical(state: Column | str) -> Column:
    c = F.col(state) if isinstance(state, str) else state
    return c.isin(*BASES)


def columns_of(cells: DataFrame, *keys: str) -> DataFrame:
    """(*keys, pattern): each column's states as one string, by taxon."""
    cells = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("taxon_id", "state"))).alias("cells"))
    return cells.select(*keys, F.array_join(F.transform("cells", lambda c: c["state"]), "").alias("pattern"))


def site_patterns(cells: DataFrame, partition: Column | None = None) -> DataFrame:
    """(pattern, fpatt): equal columns collapsed and counted, within partitions if given."""
    keys = ["pattern"] if partition is None else ["partition_id", "pattern"]
    columns = columns_of(cells, "site")
    if partition is not None:
        columns = columns.withColumn("partition_id", partition)
    return columns.groupBy(*keys).agg(F.count("*").alias("fpatt"))


def site_to_pattern(cells: DataFrame) -> DataFrame:
    """(site, pattern_id): ids follow the order of the patterns' strings."""
    columns = columns_of(cells, "site")
    ids = ranked(columns.select("pattern").distinct(), [F.col("pattern")])
    return columns.join(ids, "pattern").select("site", F.col("rank").alias("pattern_id"))


def canonical_pattern(pattern: Column) -> Column:
    """States renamed by first appearance, gaps kept; columns with other ambiguity stay as they are."""
    letters = F.array_join(F.array_distinct(F.split(F.regexp_replace(pattern, "[-?]", ""), "")), "")
    renamed = F.call_function("translate", pattern, letters, F.call_function("left", F.lit(BASES), F.length(letters)))
    return F.when(pattern.rlike("^[TCAG?-]*$"), renamed).otherwise(pattern)


def canonical_patterns(patterns: DataFrame) -> DataFrame:
    """The second collapse, right for models in which all states are alike."""
    return patterns.groupBy(canonical_pattern(F.col("pattern")).alias("pattern")).agg(F.sum("fpatt").alias("fpatt"))


def clean_sites(cells: DataFrame) -> DataFrame:
    """Cells of the sites at which every taxon has a canonical state."""
    dirty = cells.where(~canonical("state")).select("site").distinct()
    return cells.join(dirty, "site", "left_anti")


def constant_sites(cells: DataFrame) -> DataFrame:
    """(site, state) of sites with one state and no gap."""
    found = cells.groupBy("site").agg(F.min("state").alias("state"), F.max("state").alias("last"))
    return found.where((F.col("state") == F.col("last")) & canonical("state")).select("site", "state")


def informative_sites(cells: DataFrame) -> DataFrame:
    """Sites with two or more states that two or more taxa have; gaps don't count."""
    counts = cells.where(canonical("state")).groupBy("site", "state").count().where("count > 1")
    return counts.groupBy("site").agg(F.count("*").alias("n_states")).where("n_states > 1")


def duplicate_sequences(cells: DataFrame, dataset: Column) -> DataFrame:
    """(dataset_id, taxon_id, same_as): taxa whose sequence an earlier taxon of the dataset has."""
    seqs = cells.withColumn("dataset_id", dataset).groupBy("dataset_id", "taxon_id").agg(F.array_sort(F.collect_list(F.struct("site", "state"))).alias("cells"))
    seqs = seqs.select("dataset_id", "taxon_id", F.array_join(F.transform("cells", lambda c: c["state"]), "").alias("seq"))
    first = seqs.withColumn("same_as", F.min("taxon_id").over(W.partitionBy("dataset_id", "seq")))
    return first.where("same_as < taxon_id").select("dataset_id", "taxon_id", "same_as")


def state_frequencies(cells: DataFrame) -> DataFrame:
    """(taxon_id, state, n, freq) of canonical states."""
    counts = cells.where(canonical("state")).groupBy("taxon_id", "state").agg(F.count("*").alias("n"))
    totals = counts.groupBy("taxon_id").agg(F.sum("n").alias("total"))
    return counts.join(totals, "taxon_id").select("taxon_id", "state", "n", (F.col("n") / F.col("total")).alias("freq"))


def mean_frequencies(freqs: DataFrame, pooled: bool = False) -> DataFrame:
    """(state, freq): the mean of the taxa's proportions, or the proportion in all taxa together."""
    if pooled:
        total = freqs.agg(F.sum("n").alias("total"))
        return freqs.groupBy("state").agg(F.sum("n").alias("n")).join(F.broadcast(total)).select("state", (F.col("n") / F.col("total")).alias("freq"))
    taxa = freqs.agg(F.countDistinct("taxon_id").alias("taxa"))
    return freqs.groupBy("state").agg(F.sum("freq").alias("s")).join(F.broadcast(taxa)).select("state", (F.col("s") / F.col("taxa")).alias("freq"))


def homogeneity(freqs: DataFrame) -> DataFrame:
    """(x2, g) of the taxa's frequencies against their means."""
    means = mean_frequencies(freqs).withColumnRenamed("freq", "mean")
    both = freqs.join(means, "state")
    return both.agg(F.sum((F.col("freq") - F.col("mean")) ** 2 / F.col("mean")).alias("x2"), (2 * F.sum(F.col("freq") * F.log(F.col("freq") / F.col("mean")))).alias("g"))


def codons(cells: DataFrame) -> DataFrame:
    """(taxon_id, codon_site, codon): three sites each; a part of one at the end goes."""
    third = cells.groupBy("taxon_id", F.expr("(site - 1) div 3 + 1").alias("codon_site")).agg(F.array_sort(F.collect_list(F.struct("site", "state"))).alias("cells"))
    return third.where(F.size("cells") == 3).select("taxon_id", "codon_site", F.array_join(F.transform("cells", lambda c: c["state"]), "").alias("codon"))


def mask_stops(codon_table: DataFrame, codes: DataFrame) -> DataFrame:
    """Blank a whole codon column if any taxon has a stop there."""
    known = codon_table.join(F.broadcast(codes.select("codon", "aa")), "codon", "left")
    stops = known.where("aa = '*'").select("codon_site").distinct().withColumn("stop", F.lit(True))
    return codon_table.join(stops, "codon_site", "left").select("taxon_id", "codon_site", F.when(F.col("stop"), "---").otherwise(F.col("codon")).alias("codon"))


def codon_usage(codon_table: DataFrame) -> DataFrame:
    """(taxon_id, codon, n) of fully resolved codons."""
    return codon_table.where(F.col("codon").rlike("^[TCAG]{3}$")).groupBy("taxon_id", "codon").agg(F.count("*").alias("n"))


def position_frequencies(cells: DataFrame) -> DataFrame:
    """(position, state, freq) over all taxa, at codon positions 1 to 3."""
    counts = cells.where(canonical("state")).groupBy(((F.col("site") - 1) % 3 + 1).cast("int").alias("position"), "state").agg(F.count("*").alias("n"))
    totals = counts.groupBy("position").agg(F.sum("n").alias("total"))
    return counts.join(totals, "position").select("position", "state", (F.col("n") / F.col("total")).alias("freq"))


def f3x4(cells: DataFrame, codes: DataFrame) -> DataFrame:
    """(codon, freq): products of position frequencies over the sense codons, scaled to sum 1."""
    at = position_frequencies(cells)
    one = lambda k: at.where(F.col("position") == k).select(F.col("state").alias(f"s{k}"), F.col("freq").alias(f"f{k}"))
    sense = codes.where("aa <> '*'").select("codon", *[F.substring("codon", k, 1).alias(f"s{k}") for k in (1, 2, 3)])
    for k in (1, 2, 3):
        sense = sense.join(F.broadcast(one(k)), f"s{k}")  # four rows
    product = sense.select("codon", (F.col("f1") * F.col("f2") * F.col("f3")).alias("p"))
    total = product.agg(F.sum("p").alias("total"))
    return product.join(F.broadcast(total)).select("codon", (F.col("p") / F.col("total")).alias("freq"))


def fourfold_sites(codon_table: DataFrame, codes: DataFrame) -> DataFrame:
    """(codon_site, taxon_id, state): third positions where all taxa share the first two and these make the third free."""
    free = codes.groupBy(F.substring("codon", 1, 2).alias("box")).agg(F.countDistinct("aa").alias("n"), F.count("*").alias("size")).where("n = 1 and size = 4").select("box")
    box = F.substring("codon", 1, 2)
    same = codon_table.groupBy("codon_site").agg(F.min(box).alias("box"), F.max(box).alias("last")).where("box = last").join(F.broadcast(free), "box", "left_semi")
    return codon_table.join(same.select("codon_site"), "codon_site", "left_semi").select("codon_site", "taxon_id", F.substring("codon", 3, 1).alias("state"))


def window_counts(cells: DataFrame, length: int, step: int = 1) -> DataFrame:
    """(window_start, n_variable): variable sites in each full window of sites."""
    flags = cells.where(canonical("state")).groupBy("site").agg((F.min("state") != F.max("state")).cast("int").alias("variable"))
    last = cells.agg(F.max("site").alias("last"))
    starts = F.explode(F.sequence(F.greatest(F.col("site") - length + 1, F.lit(1)), F.col("site")))
    spread = flags.select(starts.alias("window_start"), "variable").where((F.col("window_start") - 1) % step == 0)
    sums = spread.groupBy("window_start").agg(F.sum("variable").alias("n_variable"))
    return sums.join(F.broadcast(last)).where(F.col("window_start") + length - 1 <= F.col("last")).select("window_start", "n_variable")


def nonempty_taxa(cells: DataFrame) -> DataFrame:
    """(taxon_id, n_known): taxa with a known state anywhere."""
    return cells.groupBy("taxon_id").agg(F.sum(canonical("state").cast("int")).alias("n_known")).where("n_known > 0")


AMBIGUITY = {"Y": "TC", "R": "AG", "M": "CA", "K": "TG", "W": "TA", "S": "CG", "B": "TCG", "D": "TAG", "H": "TCA", "V": "CAG"}


def frequencies_by_em(cells: DataFrame, rounds: int = 20, least_change: float = 1e-8) -> list[float]:
    """Frequencies of T, C, A and G where ambiguous states share out by the frequencies so far.

    The cells are counted by Spark; what is left for the rounds is a row per letter.
    """
    counts = {r.state: r.n for r in cells.groupBy("state").agg(F.count("*").alias("n")).where(F.col("state").isin(*BASES, *AMBIGUITY)).collect()}
    freqs = [0.25] * 4
    for _ in range(rounds):
        sums = [float(counts.get(b, 0)) for b in BASES]
        for letter, bases in AMBIGUITY.items():
            share = sum(freqs[BASES.index(b)] for b in bases)
            for b in bases:
                sums[BASES.index(b)] += counts.get(letter, 0) * freqs[BASES.index(b)] / share
        new = [x / max(sum(sums), 1) for x in sums]
        change, freqs = max(abs(a - b) for a, b in zip(new, freqs, strict=True)), new
        if change < least_change:
            break
    return freqs


def informative_patterns(patterns: DataFrame) -> DataFrame:
    """(pattern, fpatt) without those that parsimony learns nothing from: at least two states occur twice or more."""
    letters = F.filter(F.split("pattern", ""), lambda x: x.isin(*BASES))
    often = F.filter(F.array_distinct(letters), lambda x: F.size(F.filter(letters, lambda y: y == x)) > 1)
    return patterns.where(F.size(often) > 1).select("pattern", "fpatt")


def f1x4(cells: DataFrame, codes: DataFrame) -> DataFrame:
    """(codon, freq): as ``f3x4``, but with one set of base frequencies for all positions."""
    counts = cells.where(canonical("state")).groupBy("state").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    freqs = counts.join(F.broadcast(total)).select("state", (F.col("n") / F.col("all")).alias("freq"))
    sense = codes.where("aa <> '*'").select("codon", *[F.substring("codon", k, 1).alias(f"s{k}") for k in (1, 2, 3)])
    for k in (1, 2, 3):
        sense = sense.join(F.broadcast(freqs.select(F.col("state").alias(f"s{k}"), F.col("freq").alias(f"f{k}"))), f"s{k}")  # four rows
    product = sense.select("codon", (F.col("f1") * F.col("f2") * F.col("f3")).alias("p"))
    scale = product.agg(F.sum("p").alias("total"))
    return product.join(F.broadcast(scale)).select("codon", (F.col("p") / F.col("total")).alias("freq"))


def clean_data(cells: DataFrame, dataset: Column) -> DataFrame:
    """(dataset_id, clean, n_unclear): whether every cell of a data set is one known state."""
    unclear = F.sum((~canonical("state")).cast("int")).cast("long")
    return cells.groupBy(dataset.alias("dataset_id")).agg((unclear == 0).alias("clean"), unclear.alias("n_unclear"))


def concatenated(loci: DataFrame) -> DataFrame:
    """(locus, taxon_id, site, state): loci (locus, taxon_id, site, state) one behind the other."""
    sizes = loci.groupBy("locus").agg(F.max("site").alias("size"))
    before = W.orderBy("locus").rowsBetween(W.unboundedPreceding, -1)  # one row a locus
    offsets = sizes.select("locus", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("skip"))
    return loci.join(offsets, "locus").select("locus", "taxon_id", (F.col("site") + F.col("skip")).cast("long").alias("site"), "state")


def partitioned(cells: DataFrame, lengths: list[int]) -> DataFrame:
    """Add ``partition_id``: sites fall into stretches of these lengths, and what is left into a last one."""
    part, end = F.lit(len(lengths)), sum(lengths)
    for k in range(len(lengths) - 1, -1, -1):
        part = F.when(F.col("site") <= end, k).otherwise(part)
        end -= lengths[k]
    return cells.select("taxon_id", "site", part.alias("partition_id"), "state")


def partition_selected(cells: DataFrame, partition_id: int) -> DataFrame:
    """(taxon_id, site, state) of one partition, sites numbered as in the whole."""
    return cells.where(F.col("partition_id") == partition_id).select("taxon_id", "site", "state")
