"""Operator 6: harmonic packing of token sequences, each worker for itself."""

from __future__ import annotations

import os
from array import array
from collections import defaultdict
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from cladeworks.llm.bpe import MEMO_ENTRIES, Memo, irregular
from cladeworks.llm.common import give_back_memory, read_table

#: Texts handled together, in characters: bounds the chunks that are waiting for their identifiers.
TOGETHER = 1 << 20


class IdEncoder:
    """Texts to identifiers as little-endian 32-bit bytes, with the library doing every chunk once."""

    def __init__(self, path: str, entries: int = MEMO_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.memo = Memo(lambda chunk: None if irregular(chunk) else self.whole([" " + chunk])[0], entries)
        self.pieces = Memo(lambda piece: self.whole([" " + piece])[0], entries)
        self.marks = {mark: self.whole([mark])[0] for mark in ".,"}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, chunks: set[str]) -> None:
        """Identifiers of new chunks. Letters are a piece of their own, whether a mark follows or not."""
        memo, pieces, marks = self.memo, self.pieces, self.marks
        word_of = {}
        for c in chunks:
            if len(c) <= 64 and not irregular(c):
                word_of[c] = c if c.isalpha() else c[:-1] if c[-1] in marks and c[:-1].isalpha() else None
        whole = [c for c, word in word_of.items() if word is None]
        words = list({w for w in word_of.values() if w and w not in pieces and w not in pieces.old})
        for part, held in ((words, pieces), (whole, memo)):
            for at in range(0, len(part), 4096):
                some = part[at : at + 4096]
                for text, ids in zip(some, self.whole([" " + c for c in some]), strict=True):
                    held.put(text, ids)
        for c, word in word_of.items():
            if word:
                memo.put(c, pieces[word] if len(word) == len(c) else pieces[word] + marks[c[-1]])

    def encode(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        split = [t.split(" ") for t in texts]
        self.learn({c for chunks in split for c in chunks[1:] if c not in memo and c not in memo.old})
        out, heads = [], self.whole([chunks[0] for chunks in split])
        for text, head, (first, *rest) in zip(texts, heads, split, strict=True):
            if not rest or irregular(first) or any(s in text for s in self.specials):
                out += self.whole([text])
                continue
            try:
                out.append(head + b"".join(map(memo.__getitem__, rest)))
            except TypeError:  # a chunk that can't stand alone
                out += self.whole([text])
        return out


@lru_cache(maxsize=2)
def encoder(path: str, entries: int) -> IdEncoder:
    return IdEncoder(path, entries)


class HarmonicPacker:
    """Bins of one worker. A piece of a length in (capacity/(k+1), capacity/k] goes to class k, whose bins take k pieces.

    Cutting is free: whole capacities are cut off first, then halves, quarters, eighths and sixteenths,
    which fill their classes' bins exactly; only the rest is packed with a loss. Bins that are not full
    at the end are emptied into one run, which is cut at capacity. Open bins hold a few capacities in all.
    """

    def __init__(self, capacity: int, worker: int):
        self.capacity, self.next = capacity, worker << 40
        self.open: dict[int, list] = defaultdict(list)
        self.cuts = [c for k in range(1, 5) if (c := capacity >> k) and capacity % (1 << k) == 0]

    def new_sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, doc, ids: bytes) -> list[tuple]:
        total, at, out = len(ids) // 4, 0, []
        while total - at >= self.capacity:
            out.append((doc, at, ids[4 * at : 4 * (at + self.capacity)], total, self.new_sequence(), 0))
            at += self.capacity
        for cut in self.cuts:
            if total - at >= cut:
                out += self.put(doc, at, ids[4 * at : 4 * (at + cut)], total)
                at += cut
        if at < total:
            out += self.put(doc, at, ids[4 * at :], total)
        return out

    def put(self, doc, start: int, ids: bytes, total: int) -> list[tuple]:
        k = self.capacity * 4 // len(ids)
        held = self.open[k]
        held.append((doc, start, ids, total))
        if len(held) < k:
            return []
        del self.open[k]
        sequence, at, out = self.new_sequence(), 0, []
        for d, s, i, t in held:
            out.append((d, s, i, t, sequence, at))
            at += len(i) // 4
        return out

    def close(self) -> list[tuple]:
        out, at, sequence = [], self.capacity, -1
        for k in sorted(self.open):
            for doc, start, ids, total in self.open[k]:
                while ids:
                    if at == self.capacity:
                        sequence, at = self.new_sequence(), 0
                    part, ids = ids[: 4 * (self.capacity - at)], ids[4 * (self.capacity - at) :]
                    out.append((doc, start, part, total, sequence, at))
                    start, at = start + len(part) // 4, at + len(part) // 4
        self.open.clear()
        return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, with_ids: bool = False, memo_entries: int = MEMO_ENTRIES, id_col: str = "doc_id", text_col: str = "text", keep_encoder: bool = True) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    One narrow stage without a shuffle; every task packs its own rows, so a lost task is packed again
    alone. Null and empty texts are the end id alone; repeated rows are packed each; an empty table
    gives an empty one; very long texts are cut as they are, and ties of length change nothing; other
    columns are ignored. ``memo_entries`` bounds what a worker remembers of chunks: fewer cost time.
    Without ``keep_encoder`` each task has an encoder of its own and frees it, so that workers hold nothing beside the stages
    that follow; that costs each task a load of the vocabulary. A task leaves at most one sequence of its run of
    left-over pieces short of capacity, besides the loss of the classes under a sixteenth.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def table(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        doc, start, ids, total, sequence, offset = zip(*rows, strict=True) if rows else ((),) * 6
        columns = [pa.array(doc, id_type), *(pa.array(x, pa.int64()) for x in (start, [len(i) // 4 for i in ids], [crc32(i) for i in ids], total, sequence, offset))]
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            import numpy as np

            columns.append(pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        packer, id_type = HarmonicPacker(capacity, TaskContext.get().partitionId()), None
        encode = (encoder if keep_encoder else IdEncoder)(tokenizer, memo_entries).encode
        for batch in batches:
            id_type = batch.column(0).type
            docs_of, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(docs_of):
                some, size = [], 0
                while at + len(some) < len(docs_of) and size < TOGETHER:
                    some.append(texts[at + len(some)].as_py() or "")
                    size += len(some[-1])
                rows = [r for d, ids in zip(docs_of[at : at + len(some)], encode(some), strict=True) for r in packer.add(d, ids + end)]
                at += len(some)
                yield table(rows, id_type)
        if id_type is not None:
            yield table(packer.close(), id_type)
        if not keep_encoder:
            del encode
            give_back_memory()

    slim = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
