"""Operator 5: two-pass external shuffle into shards, with DataFrame functions only."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladeworks.llm.bitmaps import Bitmap
from cladeworks.llm.common import materialize, read_table, text_or_empty


def draws(key: Column, shards: int, seed: int) -> list[Column]:
    return [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("draw"), F.lit(s).alias("shard")) for s in range(shards)]


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: repeats of one (id, text) are numbered from 0, others are 0.

    Repeats are numbered within the parts in which they were read, and the parts' counts are added
    up, so that no task meets all repeats of a row.
    """
    repeats = materialize(rows.groupBy("same").count().where("count > 1").select("same"), "repeats")
    some = Bitmap(repeats, "same").has(F.col("same"))
    again = materialize(rows.where(some).join(repeats, "same").withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "again")
    before = W.partitionBy("same").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = again.groupBy("same", "part").agg(F.count("*").alias("n")).select("same", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = again.withColumn("at", F.row_number().over(W.partitionBy("same", "part").orderBy("place")))
    counted = within.join(parts, ["same", "part"]).select(*rows.columns, (F.col("before") + F.col("at") - 1).cast("long").alias("copy"))
    single = rows.where(~some).unionByName(rows.where(some).join(repeats, "same", "left_anti").select(*rows.columns))
    return single.withColumn("copy", F.lit(0).cast("long")).unionByName(counted)


def external_shuffle(docs: DataFrame, shards: int = 40, seed: int = 11, bucket_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Place every row in a shard and a gapless slot: (id, text, law, shard, slot, grown_shard, *carry).

    Law ``key``: the shard is the one whose seeded hash of the id is the largest, so one more shard
    takes rows only into itself. Pass 1 scatters the records by seeded hashes of id, text and the number of
    the repeat into buckets of about ``bucket_bytes`` of text, as many as each shard needs; pass 2 orders
    each bucket by content, shuffles it (Fisher-Yates, seeded) and writes it. Buckets follow each other
    within their shard. The number of partitions is the number of buckets, so slots don't depend on settings of the session.
    A null id is a key of its own; null and empty texts count 16 bytes; ties of the draws go to the higher
    shard; very long texts are moved whole; repeated rows keep a slot each; an empty table gives an empty
    one. ``carry`` names columns to take along, whatever their names.
    """
    text = text_or_empty("text")
    options = draws(F.col("id"), shards + 1, seed)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), F.struct(F.lit(0), *[docs[c] for c in carry]).alias("rest"))
    rows = rows.withColumn("same", F.xxhash64("id", "text")).withColumn("best", F.array_max(F.array(*options[:-1]))).withColumn("grown", F.greatest(F.col("best"), options[-1])["shard"]).withColumn("shard", F.col("best.shard")).drop("best")
    bytes_of = {r.shard: r.n for r in rows.groupBy("shard").agg(F.sum(F.octet_length(text) + 16).alias("n")).collect()}
    buckets = [max(1, ceil(bytes_of.get(s, 0) / bucket_bytes)) for s in range(shards)]
    scattered = numbered(rows).select(
        "shard", F.pmod(F.xxhash64(F.lit(seed + 1), "same", "copy"), F.get(F.lit(buckets), F.col("shard"))).cast("int").alias("bucket"),
        F.struct("id", "same", "copy", "grown", "text", "rest").alias("row"),
    )
    shuffled = (
        scattered.repartition(sum(buckets), "shard", "bucket")
        .groupBy("shard", "bucket")
        .agg(F.array_sort(F.collect_list("row")).alias("rows"))
        .sortWithinPartitions("shard", "bucket")  # the generator below goes on from row to row
        .select("shard", "bucket", F.size("rows").cast("long").alias("n"), F.shuffle("rows", seed).alias("rows"))
    )
    written = materialize(shuffled.select("shard", "bucket", "n", F.posexplode("rows").alias("at", "row")), "buckets")
    earlier = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = written.groupBy("shard", "bucket").agg(F.max("n").alias("n"))
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return (
        written.join(offsets, ["shard", "bucket"])
        .select(F.col("row.id").alias(id_col), F.col("row.text").alias(text_col), F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("at")).alias("slot"), F.col("row.grown").alias("grown_shard"), *[F.col("row.rest")[c].alias(c) for c in carry])
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Write one folder per shard, in slot order."""
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the records as they lie in their shards."""
    text = text_or_empty("text")
    return external_shuffle(read_table(spark, sf_dir, "documents")).select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "law", "shard", "slot", "grown_shard")
