"""The registered queries themselves, over small tables with the awkward cases, and over empty ones."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from helpers import awkward_rows, sentence, words_of
from test_copies import brute_contaminated, brute_lines, brute_print
from test_texts import brute_repeats

from cladeworks.llm.queries import queries

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
LANGS = ("en", "xx")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """(folder, documents, benchmark items): one row an id, but for one that is there twice."""
    rng = random.Random(21)
    rows = list(dict(awkward_rows()).items())
    rows += [(9000 + k, sentence(rng, 60)) for k in range(30)] + [(9100 + k, re.sub("[a-j]", lambda m: "klmnopqrst"[ord(m[0]) - 97], sentence(rng, 60))) for k in range(30)]
    rows.append(rows[0])
    items = [(1, " ".join(rows[3][1].split()[3:23])), (2, sentence(rng, 30)), (3, " ".join(rows[3][1].split()[3:23])), (4, None)]
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, None if t is None or i % 7 == 0 else LANGS[9100 <= i < 9200], "web", len(t or ""), "clash") for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    vectors = [(k, [rng.gauss(0, 1) for _ in range(64)]) for k in range(8)]
    vectors += [(100, vectors[0][1]), (101, [x + rng.gauss(0, 0.02) for x in vectors[1][1]]), (102, None), (103, [])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(1, 0, "user", "Hello."), (1, 1, None, None)], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder, rows, items


@pytest.fixture(scope="module")
def empty_tables(spark, tmp_path_factory, tables):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "embeddings", "conversations"):
        spark.read.parquet(f"{tables[0]}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", list(queries()))
def test_empty_tables(spark, empty_tables, name):
    assert queries()[name](spark, empty_tables).count() == 0


def test_op1(spark, tables):
    library = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    n = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in tables[1]}
    got = queries()["op1_token_counts"](spark, tables[0]).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((i, len((t or "").encode()), n[i], n[i] > 512) for i, t in tables[1])


def test_op2(spark, tables):
    want = brute_repeats(tables[1], 20)
    got = queries()["op2_substring_dedup"](spark, tables[0]).collect()
    assert len(got) == len(tables[1]) and all((r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id][:3] for r in got)


def test_op3(spark, tables):
    kinds = {"assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6), "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24)}
    by_id = dict(tables[1])
    for r in queries()["op3_secrets"](spark, tables[0]).collect():
        found = [(m.start(), k, m.end(), kind) for k, (kind, (p, group, least)) in enumerate(kinds.items()) for m in re.finditer(p, by_id[r.doc_id] or "") if len(m[group]) >= least]
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
        assert hashlib.sha256(text.encode()).hexdigest() == r.base_sha256
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == kind for s in found) for kind in kinds]


def test_op4(spark, tables):
    got = queries()["op4_language_id"](spark, tables[0]).collect()
    assert len(got) == len(tables[1])
    for r in got:
        t = dict(tables[1])[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, t or ""))) and r.n_positions == len((t or "").encode())
        if r.doc_id >= 9000:
            assert r.lang_pred == LANGS[r.doc_id >= 9100] and r.score > 0.6


def test_op5(spark, tables):
    by_id, slots = dict(tables[1]), defaultdict(list)
    got = queries()["op5_sharding"](spark, tables[0]).collect()
    assert len(got) == len(tables[1])
    for r in got:
        t = (by_id[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(t) + 16, zlib.crc32(t), "key") and r.grown_shard in (r["shard"], 40)
        slots[r["shard"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op6(spark, tables):
    library = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in tables[1]}
    rows, filled = queries()["op6_packing"](spark, tables[0]).collect(), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
        filled[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(ids[i]) for i, _ in tables[1])
    for pieces in filled.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024


def test_op7(spark, tables):
    gone = brute_lines(tables[1])
    got = queries()["op7_line_dedup"](spark, tables[0]).collect()
    assert sorted(r.doc_id for r in got) == sorted({i for i, _ in tables[1]})
    assert {(r.doc_id, k) for r in got for k in r.lines} == gone and all(r.n_removed == len(r.lines) for r in got)
    held = defaultdict(set)
    for i, t in tables[1]:
        for line in (t or "").lower().split("\n"):
            held[line].add(i) if words_of(line) else None
    component = {r.doc_id: r.class_id for r in got}
    assert all(len({component[i] for i in ids}) == 1 for ids in held.values()) and all(component[i] <= i for i in component)


def test_op8(spark, tables):
    got = {r.vec_id: (r.n_others, r.component_id) for r in queries()["op8_media"](spark, tables[0]).collect()}
    assert got == {k: (0, k) for k in range(8)} | {1: (1, 1), 100: (0, 0), 101: (1, 1), 102: (0, 102), 103: (0, 103)}


def test_op9(spark, tables):
    prints = {i: brute_print(t) for i, t in tables[1]}
    group = {i: i for i in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    got = queries()["op9_simhash"](spark, tables[0]).collect()
    assert len(got) == len(tables[1])
    assert all((r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", group[r.doc_id]) for r in got)


def test_op10(spark, tables):
    want = brute_contaminated(tables[1], tables[2])
    got = {(r.doc_id, r.item_id): r.matched for r in queries()["op10_decontamination"](spark, tables[0]).collect()}
    assert got == want and {item for _, item in got} == {1, 3}


def test_pipeline_edges(spark, tables, empty_tables):
    """Clashing columns, nulls and repeated rows; empty tables; and documents without any label."""
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = cp.materialize(stage(spark, docs, tables[0]), "edges")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    kept = docs.collect()
    assert len({r.doc_id for r in kept}) == len(kept) and {r.score for r in kept} == {"clash"}
    assert {9000 + k for k in range(30)} <= {r.doc_id for r in kept} and all(r.n_chars == len(r.text) for r in kept)
    assert cp.run(spark, empty_tables).count() == 0
    bare = spark.read.parquet(f"{tables[0]}/documents.parquet")
    unlabelled = bare.drop("lang").selectExpr("*", "cast(null as string) as lang").select(bare.columns)
    assert cp.language_stage(spark, unlabelled, tables[0]).count() == bare.count()
