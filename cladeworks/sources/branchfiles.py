"""Files of branch lengths at their maximum with gradient and Hessian: written from rows, read from lines that may be split anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeworks.functions.frames import ranked
from cladeworks.sources.textfiles import fields


def shown(x: Column) -> Column:
    """Numbers of an array with ten digits, two spaces apart."""
    return F.array_join(F.transform(x, lambda v: F.format_string("%.10g", v)), "  ")


def branch_file_text(blocks: DataFrame) -> DataFrame:
    """(locus, text) of rows (locus, taxa, tree, b, g, h): the number of taxa, the tree, lengths, gradient, the word Hessian, its rows."""
    rows = F.array_join(F.transform("h", shown), "\n")
    text = F.concat_ws("\n\n", F.concat(F.lit(" "), F.col("taxa").cast("string")), F.col("tree"), shown(F.col("b")), shown(F.col("g")), F.lit("Hessian"), rows)
    return blocks.select("locus", F.concat(text, F.lit("\n")).alias("text"))


def branch_file(lines: DataFrame) -> DataFrame:
    """(file_id, locus, taxa, tree, b, g, h, complete): all blocks of files given as rows (file_id, line_no, line); loci count from 1 in each file.

    A block is known by its tree's line: how many there are up to a line, over all files, is its number, so lines may come in any
    split. Its other numbers are read in order, however they are broken into lines. Where numbers are missing, or the
    count of taxa isn't that of the tree, ``complete`` is false. Empty files give no rows.
    """
    some = lines.where("trim(line) <> ''").select("file_id", "line_no", F.trim("line").alias("line"))
    is_tree = F.col("line").contains("(").cast("int")
    placed = ranked(some, [F.col("file_id"), F.col("line_no")], is_tree).select("file_id", "line_no", "line", "rank", F.col("running").alias("block"))
    # the count of taxa stands in the line before a tree, which is the last one of the block before
    counts = placed.join(placed.where(is_tree == 1).select((F.col("rank") - 1).alias("rank"), F.col("file_id").alias("file"), F.col("block").alias("next")), "rank")
    counts = counts.where("file_id = file").select(F.col("next").alias("block"), F.col("line").try_cast("int").alias("taxa"))
    tree = F.get("rows", F.lit(0))["line"]
    parts = placed.where("block > 0").groupBy("file_id", "block").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("rows"))
    # what stands before a file's first tree has the number of another file's block
    parts = parts.where(tree.contains("(")).join(counts, "block", "left")
    tokens = F.flatten(F.transform(F.slice("rows", F.lit(2), F.size("rows")), lambda r: fields(r["line"])))
    told = parts.select("file_id", "block", "taxa", tree.alias("tree"), tokens.alias("tokens"), (F.length(tree) - F.length(F.replace(tree, F.lit(","), F.lit(""))) + 1).alias("tips"))
    m = F.greatest(2 * F.col("tips") - 3, F.lit(1))  # a tree has two tips at least
    numbers = F.transform(F.filter("tokens", lambda x: ~x.rlike("^[A-Za-z]{4,}")), lambda x: x.try_cast("double"))
    told = told.withColumn("x", numbers).withColumn("m", m)
    square = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda k: F.slice("x", (2 + k) * F.col("m") + 1, F.col("m")))
    complete = (F.col("taxa") == F.col("tips")) & (F.size("x") >= F.col("m") * (F.col("m") + 2)) & F.exists("tokens", lambda x: x == "Hessian") & ~F.exists(F.slice("x", F.lit(1), F.col("m") * (F.col("m") + 2)), lambda v: v.isNull())
    first = parts.groupBy(F.col("file_id").alias("f")).agg(F.min("block").alias("first"))
    out = told.join(first, F.col("file_id") == F.col("f"))
    return out.select("file_id", (F.col("block") - F.col("first") + 1).cast("int").alias("locus"), "taxa", "tree", F.slice("x", F.lit(1), F.col("m")).alias("b"), F.slice("x", F.col("m") + 1, F.col("m")).alias("g"), square.alias("h"), F.coalesce(complete, F.lit(False)).alias("complete"))


def transformed(blocks: DataFrame, kind: str, states: int = 4) -> DataFrame:
    """``blocks`` (b, g, h) by other branch parameters u: ``sqrt`` of lengths, their ``log``, or ``arcsin`` of the root of the share of changed sites.

    By the chain rule g becomes g b', and h becomes h b'_i b'_j with g b'' more on the diagonal, where b' and b'' are the
    derivatives of the length by u. b becomes u.
    """
    c = (states - 1) / states
    half = lambda u: (F.sin(u / 2), F.cos(u / 2))

    def arcsin(b: Column) -> Column:
        return 2 * F.asin(F.sqrt(c - c * F.exp(-b / c)))

    def slopes(b: Column) -> tuple[Column, Column]:
        if kind == "sqrt":
            return 2 * F.sqrt(b), F.lit(2.0)
        if kind == "log":
            return b, b
        s, k = half(arcsin(b))
        first = s * k / (1 - s * s / c)
        return first, (k * k - s * s) / 2 / (1 - s * s / c) + first * first / c

    if kind not in ("sqrt", "log", "arcsin"):
        raise ValueError(f"no transform {kind}")
    u = {"sqrt": lambda b: F.sqrt(b), "log": lambda b: F.log(b), "arcsin": arcsin}[kind]
    d1 = F.transform("b", lambda b: slopes(b)[0])
    d2 = F.transform("b", lambda b: slopes(b)[1])
    made = blocks.withColumn("_d1", d1).withColumn("_d2", d2)
    bent = F.transform("h", lambda row, i: F.transform(row, lambda v, j: v * F.get("_d1", i) * F.get("_d1", j) + F.when(i == j, F.get("g", i) * F.get("_d2", i)).otherwise(0.0)))
    made = made.withColumn("h", bent).withColumn("g", F.zip_with("g", "_d1", lambda x, y: x * y)).withColumn("b", F.transform("b", u))
    return made.drop("_d1", "_d2")


def approximate_lnl(blocks: DataFrame, lengths: DataFrame) -> DataFrame:
    """(locus, sample, lnl): how far below its maximum each locus is at branch parameters (locus, sample, x), by its gradient and Hessian."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    both = lengths.join(blocks.select("locus", "b", "g", "h"), "locus").withColumn("z", F.zip_with("x", "b", lambda x, b: x - b))
    bent = F.transform("h", lambda row: dot(row, F.col("z")))
    return both.select("locus", "sample", (dot(F.col("z"), F.col("g")) + dot(F.col("z"), bent) / 2).alias("lnl"))
