"""Operator 2: substring deduplication by relative Lempel-Ziv parsing against all earlier text."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.common import drop_materialized, materialize, read_table
from cladeworks.llm.factors import Windows, blocks, covered, phrases
from cladeworks.llm.textkernels import Words

TOGETHER = 1 << 20
SMALLEST = -(1 << 63)
PHRASES = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "ref_id", "ref_at")]))


def in_parts(batch: pa.RecordBatch, column: int):
    """(first row, texts as bytes) of parts of about TOGETHER bytes."""
    at, some, size = 0, [], 0
    for k in range(batch.num_rows):
        some.append((batch.column(column)[k].as_py() or "").encode())
        size += len(some[-1])
        if size >= TOGETHER or k == batch.num_rows - 1:
            yield at, some
            at, some, size = k + 1, [], 0


def index_blocks(rows: DataFrame, width: int) -> DataFrame:
    """(id, tie, at, n, anchor, content): every row's text as indexed blocks of n windows from word ``at``."""

    def run(batches):
        for batch in batches:
            for first, texts in in_parts(batch, 2):
                text, at, n, anchor, content = blocks(texts, width)
                of = pa.array(text + first)
                columns = [batch.column(0).take(of), batch.column(1).take(of), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor), pa.array(content)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "tie", "at", "n", "anchor", "content"])

    return rows.mapInArrow(run, "id long, tie long, at int, n int, anchor long, content long")


def window_hashes(rows: DataFrame, width: int) -> DataFrame:
    """(anchor, window, id, tie, at) of all windows in the blocks that each row (id, tie, text, blocks) names."""

    def run(batches):
        for batch in batches:
            for first, texts in in_parts(batch, 2):
                found, named = Windows(texts, width), batch.column(3)
                out = [[], [], [], []]
                for k in range(len(texts)):
                    n_windows = found.first[k + 1] - found.first[k] - width + 1
                    for block in named[first + k].as_py():
                        at = np.arange(block["at"], min(block["at"] + block["n"], n_windows))
                        for x, y in zip(out, (np.full(len(at), block["anchor"]), found.hashes[found.first[k] + at].view(np.int64), np.full(len(at), first + k), at), strict=True):
                            x.append(y)
                anchor, window, row, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
                of = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(window), batch.column(0).take(of), batch.column(1).take(of), pa.array(at.astype(np.int32))], ["anchor", "window", "id", "tie", "at"])

    return rows.mapInArrow(run, "anchor long, window long, id long, tie long, at int")


def later(place: str = "first") -> Column:
    """Whether (id, tie, at) comes after the place."""
    return F.struct("id", "tie", "at") > F.col(place)


def duplicate_spans(rows: DataFrame, width: int = 20) -> DataFrame:
    """(id, tie, start, end, first): word spans covered by windows met earlier, and the place (id, tie, at) where the first of them was met, of rows (id, tie, text).

    Every text is cut into blocks; the blocks of all texts are the reference. Blocks whose anchor
    occurs once can't hold a repeated window. Blocks equal to an earlier one are copied as a whole:
    these are the insides of long factors. Where blocks of one anchor differ, a factor begins or ends;
    there, and only there, single windows are looked up, in the first block of each content.
    """
    all_blocks = materialize(index_blocks(rows, width), "blocks")
    anchors = materialize(all_blocks.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    repeated = materialize(all_blocks.join(anchors, "anchor"), "repeated")
    drop_materialized(all_blocks, anchors)
    contents = repeated.groupBy("anchor", "content").agg(F.min(F.struct("id", "tie", "at")).alias("first"), F.max("n").alias("n"), F.count("*").alias("copies"))
    contents = materialize(contents, "contents")
    copied = repeated.drop("n").join(contents.where("copies > 1"), ["anchor", "content"]).where(later()).select("id", "tie", F.col("at").alias("start"), (F.col("at") + F.col("n") + (width - 1)).alias("end"), "first")

    mixed = materialize(contents.groupBy("anchor").count().where("count > 1").select("anchor"), "mixed")
    edges = contents.join(mixed, "anchor").select("first.*", "n", "anchor")
    edges = edges.groupBy("id", "tie").agg(F.collect_list(F.struct("at", "n", "anchor")).alias("blocks"))
    windows = materialize(window_hashes(rows.join(edges, ["id", "tie"]).select("id", "tie", "text", "blocks"), width), "windows")
    known = windows.groupBy("anchor", "window").agg(F.min(F.struct("id", "tie", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    known = materialize(known, "known")
    single = windows.join(known, ["anchor", "window"]).where(later()).select("id", "tie", F.col("at").alias("start"), (F.col("at") + width).alias("end"), "first")
    out = materialize(copied.unionAll(single), "spans")
    drop_materialized(repeated, contents, mixed, windows, known)
    return out


def drop_repeats(docs: DataFrame, width: int = 20, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, n_factors, kept_sha256[, factors, kept]) per row of ``docs``.

    Words are runs of anything but ASCII white space. Removed is each word in a window of ``width``
    words that also starts earlier (smaller id, or same text and earlier start), as judged on the
    input. factors are the phrases of a greedy parse of these words, each copied from one earlier place:
    (start, length, ref_id, ref_at), in words; n_factors is their number. Windows count as equal if their
    64-bit hashes are. Null ids come first; rows of one id follow their text's hash, and repeated rows
    count as one place, so they are judged alike. Null, empty and short texts lose nothing; very long
    texts are parsed whole; an empty table gives an empty one; other columns are ignored.
    """
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(SMALLEST)).alias("id"), F.xxhash64(docs[text_col]).alias("tie"), docs[text_col].cast("string").alias("text"))
    spans = duplicate_spans(rows, width).groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end", F.col("first.id").alias("ref_id"), F.col("first.tie").alias("ref_tie"), F.col("first.at").alias("ref_at"))).alias("spans"))
    joined = rows.join(spans, ["id", "tie"], "left").select("id", "tie", "text", "spans")

    def run(batches):
        for batch in batches:
            for first, texts in in_parts(batch, 2):
                words, named = Words(texts), batch.column(3)
                data, out = words.data.tobytes(), []
                for k in range(len(texts)):
                    a, b = words.first[k], words.first[k + 1]
                    spans = [(s["start"], s["end"], (s["ref_id"], s["ref_tie"]), s["ref_at"]) for s in named[first + k].as_py() or ()]
                    gone = covered(b - a, [s[:2] for s in spans])
                    edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
                    kept = b" ".join(data[words.start[a + s] : words.end[a + e - 1]] for s, e in edges.reshape(-1, 2))
                    parsed = [{"start": x, "length": y - x, "ref_id": ref[0] if ref[0] != SMALLEST else None, "ref_at": at} for x, y, ref, at in phrases(spans)]
                    out.append((int(b - a), int(gone.sum()), len(parsed), sha256(kept).hexdigest(), *((parsed, kept.decode()) if with_text else (None, None))))
                n_words, n_removed, n_factors, digest, parsed, kept = zip(*out, strict=True)
                columns = [batch.column(0).slice(first, len(texts)), *(pa.array(x, pa.int64()) for x in (n_words, n_removed, n_factors)), pa.array(digest), pa.array(parsed, PHRASES), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "n_factors", "kept_sha256", "factors", "kept"])

    out = joined.mapInArrow(run, "id long, n_words long, n_removed long, n_factors long, kept_sha256 string, factors array<struct<start: long, length: long, ref_id: long, ref_at: long>>, kept string")
    out = out.select(F.when(F.col("id") != SMALLEST, F.col("id")).alias(id_col), "n_words", "n_removed", "n_factors", "kept_sha256", "factors", "kept")
    return out if with_text else out.drop("factors", "kept")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(read_table(spark, sf_dir, "documents"))
