"""Shared helpers of the training-data operators: reading, cutting lineage, worker caches."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as the contracts define them: runs of anything but ASCII white space.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``. Only a session on one machine (tests) may leave it unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file:///tmp/checkpoints/cladeworks"
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation), gives the next join
    true sizes, and leaves no claim on partitioning, so that adaptive skew splitting stays possible.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.materialized_at = path
    return out


def drop_materialized(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once nothing reads them any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.materialized_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished queries stay on disk until the driver collects its garbage: let it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def give_back_memory() -> None:
    """Return what a task has freed to the system: its worker lives on beside the next stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
