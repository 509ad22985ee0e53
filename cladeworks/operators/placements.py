"""Placement records and haplogroup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def softmax_weights(candidates: DataFrame, score: str, out: str) -> DataFrame:
    """Add ``out``: exp(score) over its sum in the placement, around the placement's largest."""
    whole = W.partitionBy("placement_id")
    power = F.exp(F.col(score) - F.max(score).over(whole))
    return candidates.withColumn(out, power).withColumn(out, F.col(out) / F.sum(out).over(whole))


def candidate_ranks(candidates: DataFrame, by: str = "like_weight_ratio") -> DataFrame:
    """Add ``candidate_rank``: by falling weight; ties by the candidate."""
    return candidates.withColumn("candidate_rank", F.row_number().over(W.partitionBy("placement_id").orderBy(F.col(by).desc(), "candidate")))


def flatten(candidates: DataFrame, names: DataFrame) -> DataFrame:
    """Every candidate with every name of its placement."""
    return candidates.join(names, "placement_id")


def parse_jplace(texts: DataFrame, *keys: str) -> DataFrame:
    """(*keys, placement_id, candidate_rank, field, value) from whole jplace documents (column ``value``); placements count from 1 in each document."""
    schema = "struct<fields: array<string>, placements: array<struct<p: array<array<double>>, nm: array<array<string>>, n: array<string>>>>"
    read = texts.select(*keys, F.from_json("value", schema).alias("j"))
    placed = read.select(*keys, "j.fields", F.posexplode("j.placements").alias("placement_id", "placement"))
    candidates = placed.select(*keys, "placement_id", "fields", F.posexplode("placement.p").alias("candidate_rank", "values"))
    cells = candidates.select(*keys, "placement_id", "candidate_rank", F.explode(F.arrays_zip("fields", "values")).alias("cell"))
    return cells.select(*keys, (F.col("placement_id") + 1).alias("placement_id"), (F.col("candidate_rank") + 1).alias("candidate_rank"), F.col("cell.fields").alias("field"), F.col("cell.values").alias("value"))


def jplace_names(texts: DataFrame, *keys: str) -> DataFrame:
    """(*keys, placement_id, name_rank, name, multiplicity)."""
    read = texts.select(*keys, F.from_json("value", "struct<placements: array<struct<nm: array<array<string>>, n: array<string>>>>").alias("j"))
    placed = read.select(*keys, F.posexplode("j.placements").alias("placement_id", "p"))
    named = F.coalesce("p.nm", F.transform("p.n", lambda n: F.array(n, F.lit("1"))))
    return placed.select(*keys, "placement_id", F.posexplode(named).alias("name_rank", "nm")).select(*keys, (F.col("placement_id") + 1).alias("placement_id"), (F.col("name_rank") + 1).alias("name_rank"), F.get("nm", F.lit(0)).alias("name"), F.get("nm", F.lit(1)).cast("double").cast("int").alias("multiplicity"))


def pivot_regions(long: DataFrame, regions: list[str]) -> DataFrame:
    """(group, RHO_<region>, RHO_<region>_SE, ...) from (group, region, rho, rho_se)."""
    cells = []
    for r in regions:
        for column, suffix in (("rho", ""), ("rho_se", "_SE")):
            cells.append(F.max(F.when(F.col("region") == r, F.col(column))).alias(f"RHO_{r}{suffix}"))
    return long.groupBy("group").agg(*cells)


def unpivot_regions(wide: DataFrame, regions: list[str]) -> DataFrame:
    """(group, region, rho, rho_se) from the wide form."""
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("region"), F.col(f"RHO_{r}").alias("rho"), F.col(f"RHO_{r}_SE").alias("rho_se")) for r in regions]))
    return wide.select("group", cells.alias("c")).select("group", "c.*").where("rho is not null")


def rho(distances: DataFrame) -> DataFrame:
    """(group, region, rho, rho_se): the mean number of changes to the root type, and its error for a star tree.

    By the published definition; the distances (group, region, changes) are one row per sequence.
    """
    return distances.groupBy("group", "region").agg(F.avg("changes").alias("rho"), (F.sqrt(F.sum("changes")) / F.count("*")).alias("rho_se"))


def missing_regions(done: DataFrame, groups: DataFrame, regions: list[str]) -> DataFrame:
    """(group, region) still to be computed, for resuming from a partial table."""
    wanted = groups.select("group", F.explode(F.array(*[F.lit(r) for r in regions])).alias("region"))
    return wanted.join(done.select("group", "region"), ["group", "region"], "left_anti")
