"""Spelling variants against plain edit checks."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import CLASHING

from cladeworks.llm import spelling

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_vocabulary(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def plain_forms(vocab):
    """All near words by looking up every word with one letter out, then checked."""
    holes = defaultdict(set)
    for w in vocab:
        for k in range(len(w)):
            holes[w[:k] + w[k + 1 :]].add(w)
    out = {}
    for w, n in vocab.items():
        others = {x for k in range(len(w)) for x in holes[w[:k] + w[k + 1 :]] if near(w, x)} | {x for x in holes[w] if near(w, x)} | {w[:k] + w[k + 1 :] for k in range(len(w)) if w[:k] + w[k + 1 :] in vocab}
        others.discard(w)
        best = min(others, key=lambda x: (-vocab[x], x), default=None)
        out[w] = (best if best and vocab[best] >= 10 * n else None, len(others))
    rows = {}
    for w, (form, count) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (w, form, root, vocab[w], count, vocab[form] if form else None)
    return rows


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    stem = ["".join(rng.choice("abcdéÈß÷") for _ in range(rng.randint(7, 12))) for _ in range(60)]
    texts = [" ".join(rng.choice(stem) if rng.random() < 0.7 else rng.choice(stem).upper() for _ in range(60)) for _ in range(200)]
    chain = ["abcdefg"] * 600 + ["abcdefgh"] * 44 + ["abcdefghi"] * 3 + ["xbcdefg"] * 600
    out = list(enumerate(texts)) + [(1000 + k, w) for k, w in enumerate(chain)]
    out += [(2000, None), (2001, ""), (None, "nullword nullword"), (2002, "x" * 300 + " " + "x" * 301), (2003, "x" * 300 + " " + "x" * 301), (2004, "日本 Straßen12StraßenŸStraßen Kstraßen")]
    return out + [out[0], out[1]]


@pytest.mark.parametrize(("bucket", "sample", "leaf"), [(40_000, 100_000, 12), (20, 60, 2)])
def test_query(spark, tmp_path, monkeypatch, rows, bucket, sample, leaf):
    """The second time with planes above small buckets and with buckets in several parts."""
    for name, value in (("BUCKET", bucket), ("SAMPLE", sample), ("LEAF", leaf)):
        monkeypatch.setattr(spelling, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"'y' as {c}" for c in [*CLASHING, "word", "bucket"] if c != "n"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.word: tuple(r) for r in spelling.op12_spelling(spark, str(tmp_path)).collect()}
    want = plain_forms(plain_vocabulary(rows))
    assert got == want
    assert want["abcdefghi"][1:3] == ("abcdefgh", "abcdefg") and max(map(len, want)) >= 300


def test_on_table(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = spelling.op12_spelling(spark, sf_dir)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r.word: tuple(r) for r in found.collect()} == plain_forms(plain_vocabulary(table))


def test_anagrams_in_parts():
    """Words that no plane parts, and trees over them."""
    rng = random.Random(2)
    words = sorted({"".join(rng.sample("abcdefg", 7)) for _ in range(900)})
    longer = sorted({w[:k] + rng.choice("abz") + w[k:] for w in words[:300] for k in (0, 3, 7)})
    x, y = spelling.Tree(words), spelling.Tree(longer)
    assert len(x.ends) == 1 and len(y.ends) > 1
    i, j = spelling.near_words(y, x)
    assert {(longer[a], words[b]) for a, b in zip(i, j, strict=True)} == {(a, b) for a in longer for b in words if near(a, b)}
    assert not spelling.near_words(x, x)[0].size
    swapped = spelling.Tree([w[:3] + "z" + w[4:] for w in words] + words)
    i, j = spelling.near_words(swapped, swapped)
    assert all(near(bytes(swapped.codes[a]).decode(), bytes(swapped.codes[b]).decode()) for a, b in zip(i, j, strict=True)) and len(i) >= len(words)
    assert len(np.unique(np.stack([i, j]), axis=1).T) == len(i)
