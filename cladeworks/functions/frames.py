"""Helpers for frames too large for one window partition: written tables, global ranks, running sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` in the folder of ``spark.checkpoint.dir`` and read it back.

    Only a session on one machine may leave it unset: the folder must be one that all executors share.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = f"{(folder or 'file:///tmp/checkpoints/cladeworks').rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a task sorts, where their number is known beforehand.
ROWS_A_TASK = 1 << 20


def tasks_for(df: DataFrame) -> int:
    """As many tasks as there are, or more, so that none sorts more than ROWS_A_TASK rows. Counts ``df``, which should be a table or a selection of one."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))


def ranked(df: DataFrame, order: list[Column], total_of: Column | None = None, tasks: int | None = None) -> DataFrame:
    """Add ``rank`` (from 1, over all rows, in ``order``) and, if asked for, ``running`` (the sum of ``total_of`` so far).

    Rows are range-partitioned and sorted where they are; only one row per partition is summed up
    across partitions. ``order`` must tell all rows apart for a unique result. ``tasks``: how many partitions; as Spark is set, if not given.
    """
    value = F.lit(0) if total_of is None else total_of
    dealt = [tasks, *order] if tasks else order
    sorted_rows = df.withColumn("_value", value).repartitionByRange(*dealt).sortWithinPartitions(*order)
    placed = written(sorted_rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("_value").alias("_sum"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = W.partitionBy("_part").orderBy("_at")
    # monotonically_increasing_id counts from 0 in each partition's lower 33 bits
    rank = F.col("_rows") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    if tasks and total_of is not None:
        placed = placed.repartition(tasks, "_part")
    out = placed.join(F.broadcast(offsets), "_part").withColumn("rank", rank)  # one row per partition
    if total_of is not None:
        out = out.withColumn("running", F.col("_base") + F.sum("_value").over(within.rowsBetween(W.unboundedPreceding, 0)))
    return out.drop("_part", "_at", "_value", "_rows", "_base")


def rounded(column: Column | str, digits: int = 6) -> Column:
    """For results that two engines must agree on; never a negative zero."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits) + F.lit(0.0)
