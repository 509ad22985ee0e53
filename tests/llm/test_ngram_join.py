"""The n-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
from helpers import awkward_rows, frame, sentence, words_of

from cladeworks.llm import ngram_join


def plain_sets(text, width):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words_of(text)]
    return {" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def plain_links(rows, width=5, percent=80):
    """{doc_id: (size, component)}; rows of one id have one text here."""
    sets = {i: plain_sets(t, width) for i, t in rows}
    group = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {i: low if g == high else g for i, g in group.items()}
    return {i: (len(s), group[i]) for i, s in sets.items()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words = words or ["x"]
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], [words[k], "more"], ["else" + str(rng.randrange(50))]])
    return words


def copies(seed):
    """Groups of copies with zero to eight edits of texts of many sizes, chains of edits, shared passages, short texts."""
    rng = random.Random(seed)
    rows, passage = [], sentence(rng, 60)
    for size in (3, 5, 6, 9, 10, 14, 25, 60, 100, 150, 300):
        base = sentence(rng, size).split()
        rows += [" ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 5, 8]))) for _ in range(14)]
        chain = base
        for _ in range(6):
            chain = edited(rng, chain or ["x"], 1 + size // 60)
            rows.append(" ".join(chain).upper())
    for extra in (2, 5, 7, 8, 10, 15, 20):
        rows += [f"{sentence(rng, extra)} {passage} {sentence(rng, extra)}" for _ in range(6)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def check(spark, rows, **options):
    got = ngram_join.ngram_links(frame(spark, rows), **options).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    assert {r.doc_id: (r.n, r.component) for r in got} == plain_links(rows, **options)


def test_parities():
    """Never more than the tokens that only one set has, and near that for sets of different sizes."""
    rng = random.Random(7)
    for size in (1, 5, 100, 3000):
        x = {rng.getrandbits(64) for _ in range(size)}
        y = {t for t in x if rng.random() < 0.9} | {rng.getrandbits(64) for _ in range(size // 2)}
        made = [ngram_join.parities(np.array(sorted(s), np.uint64)) for s in (x, y)]
        assert ngram_join.apart_at_least(*made) == ngram_join.apart_at_least(*made[::-1]) <= len(x ^ y)
        assert ngram_join.apart_at_least(*made) >= 0.6 * len(x ^ y) and ngram_join.apart_at_least(made[0], made[0]) == 0


def test_edited_copies(spark):
    check(spark, copies(1))


def test_blocks_of_columns_and_rows(spark, monkeypatch):
    """Tiny batches, blocks and classes, and no bitmap."""
    for name, value in (("BLOCK", 3), ("MOST", 8), ("LEAST", 8), ("MOST_KEYS", 0), ("MOST_PARITY", 64)):
        monkeypatch.setattr(ngram_join, name, value)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        check(spark, copies(2))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_other_bounds(spark):
    check(spark, copies(3)[:120], width=1, percent=50)


def test_awkward_query(spark, tmp_path):
    rows = awkward_rows()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = ngram_join.op11_ngram_join(spark, str(tmp_path)).collect()
    want = plain_links(rows)
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got)
    lost = ngram_join.ngram_links(frame(spark, [(None, "one two three"), (7, "one two three"), (None, "alone"), (None, None)])).collect()
    assert sorted([(r.doc_id, r.n, r.component) for r in lost], key=str) == sorted([(None, 1, 7), (7, 1, 7), (None, 1, None), (None, 0, None)], key=str)


def test_on_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = ngram_join.op11_ngram_join(spark, sf_dir)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == plain_links(rows)
