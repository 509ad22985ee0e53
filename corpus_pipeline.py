"""The training-corpus pipeline: five stages over ``documents``, each one of the numbered operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the
shared folder and rereads it as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.common import drop_materialized, materialize, read_table
from cladeworks.llm.decontamination import contaminated
from cladeworks.llm.langid import UNKNOWN, identify_languages, train_language_model
from cladeworks.llm.line_dedup import drop_repeated_lines, repeated_lines
from cladeworks.llm.packing import pack
from cladeworks.llm.simhash import one_of_each_group, similar_documents

#: Documents in whose text the language is less probable than this, on the mean over all bytes, are rejected. Prose that is mostly
#: numbers, addresses or a licence scores from 0.3 on, other prose from 0.45 on; a guess among four languages would score 0.25.
LEAST_SCORE = 0.25


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: null, empty and letterless texts and those of no clear language go.

    Without a labelled row there is no language to know, and all documents stay.
    """
    model = train_language_model(docs)
    if model is None:
        return docs
    # renamed, so that no column clashes with those of the result
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    found = identify_languages(plain, model, id_col=f"c{docs.columns.index('doc_id')}", text_col=f"c{docs.columns.index('text')}", keep=tuple(plain.columns), memo_words=120_000)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(plain.columns).toDF(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: lines that are similar to earlier ones go, and documents that consist of such lines only."""
    kept = drop_repeated_lines(docs, repeated_lines(docs))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9 at a Jaccard index of 0.8 over five-word shingles: of each group the document with the smallest id stays, once."""
    return one_of_each_group(docs, similar_documents(docs)).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold benchmark passages go."""
    # rows are told apart by id and text: an id may be null, or shared by a text without a passage
    key = F.xxhash64(docs["doc_id"], docs["text"])
    found = contaminated(docs.select(key.alias("key"), docs["text"].alias("text")), read_table(spark, sf_dir, "benchmark"), id_col="key").select("key").distinct()
    rows = docs.select(key.alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return rows.join(found, "key", "left_anti").select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token sequences of the documents that are left."""
    import public_tokenizers

    # workers that come from earlier stages keep to a small memo, and none of it when a task is over
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), memo_entries=200_000, keep_encoder=False)


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can't express a trained network; the test runs the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_materialized(*before)  # nothing reads the stage before any more
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
