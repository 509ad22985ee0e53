"""Results as lines of text: what the programs of the field read and write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeworks.functions.frames import written


def fixed(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", value)


def distance_lines(distances: DataFrame, names: DataFrame, digits: int = 4) -> DataFrame:
    """(taxon_id, line): the lower triangle of a matrix (i, j, distance) by taxa (taxon_id, name): a name and its distances to those before it."""
    cell = F.coalesce(fixed(F.col("distance"), digits), F.lit("-1"))
    rows = distances.groupBy(F.col("i").alias("taxon_id")).agg(F.array_sort(F.collect_list(F.struct("j", cell.alias("cell")))).alias("cells"))
    line = F.concat_ws("  ", "name", F.array_join(F.transform("cells", lambda c: c["cell"]), "  "))
    return names.join(rows, "taxon_id", "left").select("taxon_id", F.when(F.col("cells").isNull(), F.col("name")).otherwise(line).alias("line"))


def pattern_lines(patterns: DataFrame) -> DataFrame:
    """(line) of each pattern: its characters in groups of ten, and its count."""
    return patterns.select(F.concat_ws("  ", F.trim(F.regexp_replace("pattern", "(.{10})", "$1 ")), F.col("fpatt").cast("string")).alias("line"))


def lnf_lines(patterns_lnf: DataFrame) -> DataFrame:
    """(line) of each pattern (pattern_id, fpatt, lnf, pattern)."""
    return patterns_lnf.select(F.concat_ws("  ", F.col("pattern_id").cast("string"), F.col("fpatt").cast("string"), fixed(F.col("lnf"), 6), F.col("pattern")).alias("line"))


def fasta_lines(cells: DataFrame, width: int = 60) -> DataFrame:
    """(dataset_id, taxon_id, text): each sequence (dataset_id, taxon_id, taxon, site, state) as a FASTA record."""
    seqs = cells.groupBy("dataset_id", "taxon_id", "taxon").agg(F.array_sort(F.collect_list(F.struct("site", "state"))).alias("c"))
    seq = F.array_join(F.transform("c", lambda x: x["state"]), "")
    return seqs.select("dataset_id", "taxon_id", F.concat(F.lit(">"), "taxon", F.lit("\n"), F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")).alias("text"))


def newick_text(nodes: DataFrame, names: Column, digits: int = 6) -> DataFrame:
    """(node_id, newick): the subtree of every inner node (node_id, father_id, branch_length, is_tip) as text, sons in order of their ids.

    Level by level: in each round the nodes all of whose sons have their text get theirs, so a tree of depth d takes d joins.
    """
    shown = lambda text: F.concat(text, F.when(F.col("branch_length").isNotNull(), F.concat(F.lit(":"), fixed(F.col("branch_length"), digits))).otherwise(""))
    of_sons = nodes.where("father_id is not null").groupBy(F.col("father_id").alias("node_id")).agg(F.count("*").alias("n_sons"))
    ready = nodes.where("is_tip").select("node_id", "father_id", shown(names).alias("text"))
    out = None
    while True:
        whole = ready.where("father_id is not null").groupBy(F.col("father_id").alias("node_id")).agg(F.array_sort(F.collect_list(F.struct("node_id", "text"))).alias("sons"))
        inner = F.concat(F.lit("("), F.array_join(F.transform("sons", lambda s: s["text"]), ","), F.lit(")"))
        made = whole.join(of_sons, "node_id").where(F.size("sons") == F.col("n_sons")).select("node_id", inner.alias("newick"))
        made = made if out is None else made.join(out.select("node_id"), "node_id", "left_anti")
        made = written(made, "newick")
        if made.isEmpty():
            return out
        out = made if out is None else out.unionByName(made)
        ready = written(ready.unionByName(made.join(nodes, "node_id").select("node_id", "father_id", shown(F.col("newick")).alias("text"))), "ready")
