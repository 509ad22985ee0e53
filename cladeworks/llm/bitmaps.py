"""Fixed-size sketches in a plan: their size is a parameter, whatever the data."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A bitmap of 2^20 bits takes 128 KB at most.
BITS = 20


#: The largest that is sized by the number of keys: 1 MB.
MOST_BITS = 23


def bits_for(table: DataFrame) -> int:
    """Bits for eight to sixteen times as many places as a written table has rows, up to MOST_BITS: beyond a million rows ever more others pass."""
    return min(MOST_BITS, max(10, (8 * table.count()).bit_length()))


def literal_array(values: list[int], kind: str) -> Column:
    """An array literal; folded once when the plan is made. Its values are written out wherever a plan is described."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def held_array(spark: SparkSession, values: list[int], kind: str) -> Column:
    """An array as the value of a subquery over one row: descriptions of a plan, which the driver keeps, hold only its name.

    It may not stand inside a lambda: there a column of that name is to stand for it.
    """
    at = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, {"tinyint": pa.int8(), "bigint": pa.int64()}[kind]))
    return spark.createDataFrame(pa.Table.from_arrays([at], ["held"])).scalar()


class Bitmap:
    """Which hashes occur: no false negatives; a full bitmap lets all pass, and what follows stays exact.

    ``held``: as a ``held_array``, so ``has`` may not stand inside a lambda.
    """

    def __init__(self, df: DataFrame, hash_col: str, bits: int = BITS, held: bool = False):
        self.mask = (1 << bits) - 1
        at = F.col(hash_col).bitwiseAND(F.lit(self.mask))
        word, bit = F.shiftright(at, 6), F.expr("shiftleft(1L, cast(at & 63 as int))")
        rows = df.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
        words = [0] * (1 << (bits - 6))
        for r in rows:
            words[r.word] = r.bits
        self.words = held_array(df.sparkSession, words, "bigint") if held else literal_array(words, "bigint")

    def has(self, hashed: Column) -> Column:
        at = hashed.bitwiseAND(F.lit(self.mask))
        word = F.get(self.words, F.shiftright(at, 6).cast("int"))
        return F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1


def bucket_classes(df: DataFrame, hash_col: str, bits: int) -> list[int]:
    """For each of 2^bits buckets of a hash, over all rows: four times the logarithm of how many fall into it.

    A line of text for 256 buckets each comes to the driver, so it never holds 2^bits rows.
    """
    bucket = F.col(hash_col).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    counts = df.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    pair = F.concat_ws(":", "bucket", F.least(F.lit(127), F.floor(4 * F.log2(F.col("n") + 1))).cast("string"))
    out = [0] * (1 << bits)
    for r in counts.groupBy(F.shiftright("bucket", 8).alias("row")).agg(F.array_join(F.collect_list(pair), ",").alias("pairs")).collect():
        for entry in r.pairs.split(","):
            at, _, value = entry.partition(":")
            out[int(at)] = int(value)
    return out
