"""Operator 1: token counts by heap-and-linked-list byte-pair merging; no identifiers are emitted."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from cladeworks.llm.bpe import counter
from cladeworks.llm.common import read_table


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    One narrow stage, no shuffle. Null and empty texts count nothing; repeated rows give repeated
    rows; an empty table gives an empty one; other columns are ignored, so their names cannot clash.
    ``tokenizer`` is the path of a byte-level BPE file that every executor has.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        count = counter(tokenizer).count
        for batch in batches:
            texts = batch.column(1).fill_null("") if batch.num_rows else batch.column(1)
            tokens = pa.array([count(t) for t in texts.to_pylist()], pa.int64())
            sizes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, tokens, pc.greater(tokens, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    slim = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    out = slim.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
