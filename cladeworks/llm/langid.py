"""Operator 4: language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.common import ASCII_SPACE, give_back_memory, read_table
from cladeworks.llm.gru import ByteTagger, windows

UNKNOWN = "und"
#: Words whose scores a task keeps; a full memo is emptied. Longer words are scored anew each time.
MEMO_WORDS, MEMO_CHARS = 250_000, 64
TOGETHER = 1 << 20
#: Marks that are read apart from a word at whose ends they stand.
MARKS = ".,;:!?\"'()*&%$#|"


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_words(docs: DataFrame, docs_per_language: int, words_per_doc: int, word_chars: int = 64, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """(label, words): about ``docs_per_language`` rows a language at most, and of each so many distinct words, both by hash order; of a word its first ``word_chars`` characters.

    Bounds on the rows' hashes, one a language, reach the driver and go back as literals, so that no text is shuffled.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), docs[label_col].cast("string").alias("label")).where(~held_out() & F.col("label").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))

    def within(bounds: dict[str, int]):
        known = F.create_map(*[F.lit(x) for label, bound in sorted(bounds.items()) for x in (label, bound)])
        return F.col("h") <= F.element_at(known, F.col("label"))

    # hashes are even: a bound on them leaves a few times as many rows of each language, however many there are
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows.select("label", F.array("text").alias("words")).limit(0)
    bounds = {label: min(2**64 - 1, 2**64 * 4 * docs_per_language // n) - 2**63 for label, n in sizes.items()}
    hashes: dict[str, set[int]] = {}
    for r in rows.where(within(bounds)).select("label", "h").distinct().collect():
        hashes.setdefault(r.label, set()).add(r.h)
    last = {label: sorted(some)[:docs_per_language][-1] for label, some in hashes.items()}
    words = F.transform(F.array_distinct(F.split("text", ASCII_SPACE)), lambda w: F.struct(F.xxhash64(w).alias("h"), F.substring(w, 1, word_chars).alias("w")))
    some = rows.where(within(last)).select("label", F.slice(F.array_sort(words), 1, words_per_doc)["w"].alias("words"))
    return some.distinct()  # equal rows share a hash


def train_language_model(docs: DataFrame, docs_per_language: int = 300, words_per_doc: int = 80, epochs: int = 3, **columns) -> bytes | None:
    """The pickled network, or None without labelled rows. The sample that reaches the driver is bounded by the two numbers."""
    rows = training_words(docs, docs_per_language, words_per_doc, **columns).collect()
    rows.sort(key=lambda r: (r.label, r.words))
    classes = sorted({r.label for r in rows})
    pairs = [(w.encode(), classes.index(r.label)) for r in rows for w in r.words if w]
    if not pairs:
        return None
    model = ByteTagger(classes)
    model.train([w for w, _ in pairs], [k for _, k in pairs], epochs=epochs, batch=256, rate=0.01)
    return pickle.dumps(model)


class Predictor:
    """Scores of words, kept from text to text: mean log-probabilities of the core, summed probabilities and labels of all bytes, and bytes."""

    def __init__(self, model: bytes, memo_words: int = MEMO_WORDS):
        self.model: ByteTagger = pickle.loads(model)
        self.memo_words = memo_words
        self.n = len(self.model.classes)
        self.blank = self.model.scores([b" "])[0]
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.zeros((1024, 3 * self.n + 1), np.float32)

    def marks(self, texts: list[str]) -> np.ndarray:
        """Of the marks at one end of each word: they count as positions, but have no part in the choice of the language."""
        kinds = {text: k for k, text in enumerate(dict.fromkeys(texts))}
        found = np.zeros((len(kinds), 3 * self.n + 1), np.float32)
        for text, k in kinds.items():
            if text:
                found[k] = self.model.scores(windows(text.encode(), b"")).sum(0)
        found[:, : self.n] = 0
        return found[[kinds[text] for text in texts]]

    def learn(self, words: list[str]) -> None:
        """Rows of scores for words not met before; a word with marks at its ends adds theirs to its core's, which is read once."""
        at, marked, cores = self.at, [], []
        for w in words:
            core = w if w.isalnum() else w.strip(MARKS)
            if len(core) != len(w):
                marked.append((w, core))
            cores.append(core)
        fresh = [c for c in dict.fromkeys(cores) if c not in at]
        first = len(at)
        self.scores = grown_to(self.scores, first + len(fresh) + len(marked))
        if fresh:
            self.scores[first : first + len(fresh)] = self.model.word_scores([c.encode() for c in fresh])
            at.update(zip(fresh, range(first, first + len(fresh)), strict=True))
        if marked:
            first, heads = len(at), [w.index(core) if core else len(w) for w, core in marked]
            ends = self.marks([w[:h] for (w, _), h in zip(marked, heads, strict=True)]) + self.marks([w[h + len(core) :] for (w, core), h in zip(marked, heads, strict=True)])
            self.scores[first : first + len(marked)] = self.scores[[at[core] for _, core in marked]] + ends
            at.update((w, first + k) for k, (w, _) in enumerate(marked))

    def predict(self, texts: list[str]) -> list[tuple[str, float, int, float]]:
        """(language, mean probability, labelled positions, the share of positions that the language labels)."""
        n, out = self.n, []
        split = [t.split() for t in texts]
        if len(self.at) > self.memo_words:
            self.forget()
        at = self.at
        fresh = [w for w in set().union(*split) if w not in at]
        if fresh:
            self.learn(fresh)
        for text, words in zip(texts, split, strict=True):
            size = len(text.encode())
            if not any(map(str.isalpha, text)):
                out.append((UNKNOWN, 0.0, size, 0.0))
                continue
            total = self.scores[[at[w] for w in words]].sum(0, dtype=np.float64)
            total[n:] += self.blank[n:] * max(size - total[-1], 0)  # white space beyond the one space before each word
            best = int(total[:n].argmax())
            out.append((self.model.classes[best], float(min(total[n + best] / total[-1], 1.0)), size, float(min(total[2 * n + best] / total[-1], 1.0))))
        if any(len(w) > MEMO_CHARS for w in fresh):
            self.forget()
        return out


def grown_to(rows: np.ndarray, size: int) -> np.ndarray:
    if size <= len(rows):
        return rows
    out = np.zeros((max(size, 2 * len(rows)), rows.shape[1]), rows.dtype)
    out[: len(rows)] = rows
    return out


def identify_languages(docs: DataFrame, model: bytes | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), memo_words: int = MEMO_WORDS) -> DataFrame:
    """(*keep, id, held_out, lang_pred, score, n_positions, position_share) per row, from the text alone.

    The network reads word by word, both ways, each behind one space and in windows of 24 bytes, and
    marks at a word's ends apart from it. So every byte of the whole text is labelled, white space
    included, and n_positions is its size. The language is the one with the largest sum of the words' mean
    log-probabilities (ties: the first by name); score is its mean probability over all positions. Null,
    empty and letterless texts, and all texts where no model could be trained, are ``und`` with score 0.
    A null id counts as the empty string for ``held_out``. Very long texts and words are read whole. Repeated
    rows are predicted alike; an empty table gives an empty one. Other columns are ignored unless kept;
    a kept column that has the name of a result appears beside it. ``memo_words`` bounds what a task remembers of words: fewer cost time.
    """
    sent = [*keep, *([] if id_col in keep else [id_col]), *([] if text_col in keep else [text_col])]
    at_text = sent.index(text_col)
    returned = [k for k, c in enumerate(sent) if c != text_col or c in keep]

    def run(batches):
        predict = Predictor(model, memo_words).predict if model else lambda some: [(UNKNOWN, 0.0, 0, 0.0)] * len(some)
        for batch in batches:
            column, at = batch.column(at_text), 0
            while at < batch.num_rows:
                some, size = [], 0
                while at + len(some) < batch.num_rows and size < TOGETHER:
                    some.append(column[at + len(some)].as_py() or "")
                    size += len(some[-1])
                lang, score, n, share = zip(*predict(some), strict=True)
                columns = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(share, pa.float64())]
                own = batch.slice(at, len(some))  # small batches go back
                yield pa.RecordBatch.from_arrays([*(own.column(k) for k in returned), *columns], [*(f"c{k}" for k in returned), "lang_pred", "score", "n_positions", "position_share"])
                at += len(some)
        del predict
        give_back_memory()

    fields = "".join(f"c{k} {docs.schema[sent[k]].dataType.simpleString()}, " for k in returned)
    slim = docs.select(*[(docs[c].cast("string") if c == text_col else docs[c]).alias(f"c{k}") for k, c in enumerate(sent)])
    out = slim.mapInArrow(run, f"{fields}lang_pred string, score double, n_positions long, position_share double")
    return out.select(*[F.col(f"c{k}").alias(sent[k]) for k in returned], held_out(f"c{sent.index(id_col)}").alias("held_out"), "lang_pred", "score", "n_positions", "position_share")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify_languages(docs, train_language_model(docs))
