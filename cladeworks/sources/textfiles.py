"""Readers of line-based files: rows (file_id, line_no, line) in, tables out. All of them are Column expressions; what is no number is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def fields(line: Column) -> Column:
    """What white space separates."""
    return F.split(F.trim(line), r"\s+")


def sample_file(lines: DataFrame) -> DataFrame:
    """(file_id, iteration, param, value): a chain's samples; the first line of a file names the columns, its first column numbers the iterations."""
    head = lines.where("line_no = 0").select("file_id", fields(F.col("line")).alias("names"))
    rows = lines.where("line_no > 0 and trim(line) <> ''").select("file_id", fields(F.col("line")).alias("cells")).join(head, "file_id")
    cells = rows.select("file_id", F.get("cells", F.lit(0)).try_cast("long").alias("iteration"), F.posexplode("cells").alias("at", "cell"), "names")
    return cells.where("at > 0").select("file_id", "iteration", F.get("names", F.col("at")).alias("param"), F.col("cell").try_cast("double").alias("value"))


def pattern_file(lines: DataFrame) -> DataFrame:
    """(file_id, pattern, fpatt): site patterns with their counts, one a line."""
    cells = fields(F.col("line"))
    return lines.where("trim(line) <> ''").select("file_id", F.get(cells, F.lit(0)).alias("pattern"), F.get(cells, F.lit(1)).try_cast("long").alias("fpatt"))


def edge_list(lines: DataFrame) -> DataFrame:
    """(file_id, node_id, father_id, branch_length, is_tip): lines of father, son and, if known, length; the root is the father that is no son."""
    cells = fields(F.col("line"))
    edges = lines.where("trim(line) <> ''").select("file_id", F.get(cells, F.lit(0)).try_cast("long").alias("father_id"), F.get(cells, F.lit(1)).try_cast("long").alias("node_id"), F.get(cells, F.lit(2)).try_cast("double").alias("branch_length"))
    fathers = edges.select("file_id", F.col("father_id").alias("node_id")).distinct()
    sons = edges.join(fathers.withColumn("has_sons", F.lit(True)), ["file_id", "node_id"], "left")
    root = fathers.join(edges, ["file_id", "node_id"], "left_anti")
    return sons.select("file_id", "node_id", "father_id", "branch_length", F.col("has_sons").isNull().alias("is_tip")).unionByName(root.select("file_id", "node_id", F.lit(None).try_cast("long").alias("father_id"), F.lit(None).try_cast("double").alias("branch_length"), F.lit(False).alias("is_tip")))


def trait_file(lines: DataFrame) -> DataFrame:
    """(file_id, taxon, trait, value): a name and its measurements in each line; the first line has the numbers of both."""
    cells = fields(F.col("line"))
    rows = lines.where("line_no > 0 and trim(line) <> ''").select("file_id", F.get(cells, F.lit(0)).alias("taxon"), F.posexplode(cells).alias("trait", "cell"))
    return rows.where("trait > 0").select("file_id", "taxon", "trait", F.col("cell").try_cast("double").alias("value"))


def triangle_file(lines: DataFrame) -> DataFrame:
    """(file_id, i, j, value): a symmetric matrix from its lower triangle, line k with k values; both halves are returned."""
    rows = lines.where("line_no > 0 and trim(line) <> ''").select("file_id", (F.col("line_no") + 1).cast("int").alias("i"), F.posexplode(fields(F.col("line"))).alias("at", "cell"))
    cells = rows.select("file_id", "i", (F.col("at") + 1).alias("j"), F.col("cell").try_cast("double").alias("value"))
    return cells.unionByName(cells.select("file_id", F.col("j").alias("i"), F.col("i").alias("j"), "value"))


def matrix_numbers(lines: DataFrame, size: int) -> DataFrame:
    """(file_id, numbers): the lower triangle and the frequencies of a matrix of so many states, however they are broken into lines; notes behind them are left out."""
    rows = lines.where("trim(line) <> ''").groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("rows"))
    cells = F.flatten(F.transform("rows", lambda r: fields(r["line"])))
    return rows.select("file_id", F.transform(F.slice(cells, 1, size * (size + 1) // 2), lambda x: x.try_cast("double")).alias("numbers"))


def exchange_file(lines: DataFrame, size: int = 20) -> DataFrame:
    """(file_id, i, j, rate): exchange rates of a model's file, such as those of amino acids, in both halves. A file is small and read as one row."""
    cells = matrix_numbers(lines, size).select("file_id", F.posexplode(F.slice("numbers", 1, size * (size - 1) // 2)).alias("at", "rate"))
    i = F.floor((F.sqrt(8 * F.col("at") + 1) + 1) / 2).cast("int")
    half = cells.select("file_id", (i + 1).alias("i"), (F.col("at") - (i * (i - 1) / 2).cast("int") + 1).alias("j"), "rate")
    return half.unionByName(half.select("file_id", F.col("j").alias("i"), F.col("i").alias("j"), "rate"))


def frequency_file(lines: DataFrame, size: int = 20) -> DataFrame:
    """(file_id, i, freq): the frequencies behind the triangle, scaled to add up to one; none where the file ends before them."""
    numbers = matrix_numbers(lines, size).select("file_id", F.slice("numbers", size * (size - 1) // 2 + 1, size).alias("f")).where(F.size("f") == size)
    total = F.aggregate("f", F.lit(0.0), lambda acc, x: acc + x)
    return numbers.select("file_id", F.posexplode(F.transform("f", lambda x: x / total)).alias("at", "freq")).select("file_id", (F.col("at") + 1).alias("i"), "freq")


def calibrations(nodes: DataFrame, text: str = "annotation") -> DataFrame:
    """Add ``kind`` and ``numbers`` from a calibration's text.

    Fixed ages @a; bounds >a, <b, >a<b; and letters with numbers in brackets: L (lower bound), U (upper),
    B (both), G (gamma), SN and ST (skew normal and t), S2N (two skew normals). Other text gives nulls.
    """
    bare = F.regexp_replace(F.col(text), r"[\s'\[\]\"]", "")
    named = F.regexp_extract(bare, r"^(L|U|B|G|SN|ST|S2N)[({].*[)}]$", 1)
    bounded = F.when(bare.rlike(rf"^>{NUMBER}<{NUMBER}$"), "B").when(bare.rlike(rf"^<{NUMBER}>{NUMBER}$"), "B").when(bare.rlike(rf"^>{NUMBER}$"), "L").when(bare.rlike(rf"^<{NUMBER}$"), "U").when(bare.rlike(rf"^[@=]{NUMBER}$"), "fixed")
    kind = F.when(named != "", named).otherwise(bounded)
    found = F.transform(F.regexp_extract_all(F.regexp_replace(bare, "^S2N", ""), F.lit(f"({NUMBER})"), F.lit(1)), lambda x: x.try_cast("double"))
    ordered = F.when(bare.rlike(rf"^<{NUMBER}>{NUMBER}$"), F.reverse(found)).otherwise(found)
    return nodes.withColumn("kind", kind).withColumn("numbers", F.when(kind.isNotNull(), ordered))
