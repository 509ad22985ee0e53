"""Line dedup, SimHash, decontamination, image copies and the pipeline against plain versions."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from helpers import awkward_rows, frame, sentence, words_of
from pyspark.sql import functions as F
from test_ngram_join import copies, plain_links

from cladeworks.llm.components import connected_components
from cladeworks.llm.decontamination import MASKS, always_hit, contaminated, whole_masks
from cladeworks.llm.imagekernels import agree, resized
from cladeworks.llm.line_dedup import document_classes, drop_repeated_lines, repeated_lines
from cladeworks.llm.media import image_copies, vector_images
from cladeworks.llm.simhash import near_duplicates, similar_documents

xxhash = pytest.importorskip("xxhash")


def brute_lines(rows, threshold=0.8):
    """(doc_id, line) with an earlier similar line; rows of one id have one text here."""
    lines = []
    for i, t in sorted(set(rows), key=lambda r: r[0]):
        for k, line in enumerate(t.split("\n") if t is not None else ()):
            if w := words_of(line.lower()):
                lines.append((i, k, set(w)))
    out = set()
    for b, (i, k, s) in enumerate(lines):
        if any(len(s & o) >= threshold * len(s | o) - 1e-9 for _, _, o in lines[:b]):
            out.add((i, k))
    return out


def line_rows(seed):
    rng = random.Random(seed)
    base = [sentence(rng, n) for n in [*range(1, 8), 10, 15, 20, 25, 30, 40, 50, 60]]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            w = rng.choice(base).split() if rng.random() < 0.7 else sentence(rng, rng.randint(1, 50)).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                w[rng.choice([0, -1, rng.randrange(len(w))])] = rng.choice(["new", "word", "Other"])
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    return rows


def test_line_dedup(spark):
    rows = line_rows(1) + [(1000 + i, t) for i, t in awkward_rows()]
    got = repeated_lines(frame(spark, rows))
    want = brute_lines(rows)
    assert {(r.doc_id, r.line) for r in got.collect()} == want and want
    docs = frame(spark, rows)
    left = drop_repeated_lines(docs, got)
    assert left.columns == docs.columns
    for r in left.collect():
        text = dict(rows)[r.doc_id]
        kept = None if text is None else [x for k, x in enumerate(text.split("\n")) if (r.doc_id, k) not in want]
        assert r.text == (None if kept is None else "\n".join(kept)) and kept != []


def test_line_classes(spark):
    """One row for every document; every link counts, also those of a line that an earlier one settles."""
    rows = line_rows(3) + [(1000 + i, t) for i, t in awkward_rows()]
    held = defaultdict(set)
    for i, t in rows:
        held[i] |= {line for line in (t or "").lower().split("\n") if words_of(line)}
    sets = {line: set(words_of(line)) for lines in held.values() for line in lines}
    near = {a: {b for b in sets if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9} for a in sets}
    ids = {i for i, _ in rows}
    group = {i: i for i in ids}
    for a in sorted(ids):
        around = held[a].union(*(near[w] for w in held[a])) if held[a] else set()
        for b in sorted(ids):
            if held[b] & around and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    removed = defaultdict(list)
    for i, k in sorted(brute_lines(rows)):
        removed[i].append(k)
    got = document_classes(frame(spark, list(dict(rows).items()))).collect()
    assert {r.doc_id: (r.n_removed, r.lines, r.class_id, r.n_links) for r in got} == {i: (len(removed[i]), removed[i], group[i], sum(len(near[w]) for w in held[i])) for i in ids}
    assert len(got) == len(ids) and max(len(x) for x in near.values()) > 1
    assert document_classes(frame(spark, [])).count() == 0


def test_numbered_lines(spark):
    """Short lines that share their words but for a number meet nowhere: no pair of them is compared."""
    from cladeworks.llm import line_dedup

    rows = [(i, f"Page {i}\nsee note {i} below\nfigure {i} of two") for i in range(3000)] + [(9000, "page 7\nPage 8 \nbelow see note 9\nsee note 9 below again")]
    docs = frame(spark, rows)
    seen = []
    plain = line_dedup.candidates
    line_dedup.candidates = lambda met: (seen.append(met.count()), plain(met))[1]
    try:
        got = {(r.doc_id, r.line) for r in repeated_lines(docs).collect()}
    finally:
        line_dedup.candidates = plain
    assert got == {(9000, k) for k in range(4)} and sum(seen) < 20_000


def test_line_plans_are_short(spark):
    """Descriptions of plans, which the driver keeps, don't write out the classes of 2^18 buckets or the bits of a bitmap."""
    from pyspark.sql import functions as F

    from cladeworks.llm.bitmaps import Bitmap
    from cladeworks.llm.line_dedup import distinct_lines, places, rarity_classes

    docs = frame(spark, awkward_rows())
    base = docs.select(*places(docs, "doc_id", "text"), "text")
    firsts = distinct_lines(base, rarity_classes(base), 0.8)
    kept = firsts.where(Bitmap(firsts, "sig", 16, held=True).has(F.col("sig")))
    assert kept.count() == firsts.count() > 10
    assert len(kept._jdf.queryExecution().toString()) < 100_000


def test_line_dedup_edges(spark):
    assert repeated_lines(frame(spark, [])).count() == 0
    text = "a b c d e f g"
    rows = [(None, text), (1, text), (2, "short line"), (3, "Line short"), (4, " "), (5, " "), (6, "twice here"), (6, "twice here"), (7, "one\nmore"), (7, "more\nthan")]
    assert sorted((r.doc_id, r.line) for r in repeated_lines(frame(spark, rows)).collect()) in ([(1, 0), (3, 0), (7, 0)], [(1, 0), (3, 0), (7, 1)])
    got = document_classes(frame(spark, rows)).collect()
    assert len(got) == 9 and [(r.n_removed, r.lines) for r in got if r.doc_id == 6] == [(0, [])]


def test_line_stars(spark, size=60):
    """Many near copies of a line: what is implied by their centre and what is compared make up all links."""
    rng = random.Random(size)
    base, rows = sentence(rng, size).split(), []
    for i in range(150):
        w = list(base)
        for k in rng.sample(range(size), rng.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            w[k] = f"new{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, t) for i, t in line_rows(4)]
    texts = {line for _, t in rows for line in t.lower().split("\n") if words_of(line)}
    sets = {t: set(words_of(t)) for t in texts}
    n_links = {a: sum(a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9 for b in texts) for a in texts}
    gone = brute_lines(rows)
    for r in document_classes(frame(spark, rows)).collect():
        lines = dict(rows)[r.doc_id].lower().split("\n")
        assert r.lines == [k for k in range(len(lines)) if (r.doc_id, k) in gone]
        assert r.n_links == sum(n_links[t] for t in set(lines) & texts)


def test_far_lines_of_a_star_meet_in_their_edits(spark, monkeypatch):
    """Lines of one star are compared where they share an edit, not in the words that all of them have; every link is counted."""
    from cladeworks.llm import line_dedup

    rng = random.Random(18)
    base, rows = sentence(rng, 60).split(), []
    for i in range(200):
        w = list(base)
        for k in rng.sample(range(60), 1 if i < 60 else 3):
            w[k] = f"new{rng.randrange(400)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join(base)) for i in range(3)]
    sets = {t: set(words_of(t)) for t in {t for _, t in rows}}
    n_links = {a: sum(a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9 for b in sets) for a in sets}
    seen, plain = [], line_dedup.candidates
    monkeypatch.setattr(line_dedup, "candidates", lambda met: (seen.append(met.count()), plain(met))[1])
    got = {r.doc_id: r.n_links for r in document_classes(frame(spark, rows)).collect()}
    assert got == {i: n_links[t] for i, t in rows}
    assert seen[-1] == 0  # of the last of them, which joins what is not settled by stars


def brute_print(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = words_of(t)
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    rng = random.Random(5)
    long = sentence(rng, 900).split()
    rows = awkward_rows() + [(3000 + k, " ".join([*long[: 100 * k], "edit", *long[100 * k + 1 :]])) for k in range(8)]
    got = near_duplicates(frame(spark, rows)).collect()
    prints = {i: brute_print(t) for i, t in rows}
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert len(got) == len(rows)
    for r in got:
        assert r.print % (1 << 64) == prints[r.doc_id]
        assert r.component == root(r.doc_id)
    assert near_duplicates(frame(spark, [])).count() == 0
    assert near_duplicates(frame(spark, [(None, "a b c"), (None, "x y")])).count() == 2


def test_near_duplicate_stage(spark):
    """Documents of a Jaccard index of 0.8 go although their fingerprints lie more than two bits apart."""
    import corpus_pipeline as cp

    rng = random.Random(12)
    rows = awkward_rows()
    for k in range(8):
        w = sentence(rng, 120).split()
        rows.append((7000 + 10 * k, " ".join(w)))
        for j in range(1, 5):
            w[(10 * j * (k + 1)) % 120] = f"new{j}"
            rows.append((7000 + 10 * k + j, " ".join(w)))
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := words_of((t or "").lower())) else set() for i, t in rows}
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and near(a, b) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    docs = frame(spark, rows, clashing=False)
    assert {r.doc_id for r in cp.near_duplicate_stage(spark, docs, "").collect()} == {i for i, g in group.items() if i == g}
    assert any(near(7000 + 10 * k, 7001 + 10 * k) and (brute_print(dict(rows)[7000 + 10 * k]) ^ brute_print(dict(rows)[7001 + 10 * k])).bit_count() > 2 for k in range(8))
    assert cp.near_duplicate_stage(spark, docs.limit(0), "").count() == 0


def test_near_duplicate_stage_looks_up_fingerprints(spark, monkeypatch):
    """SimHash proposes pairs in the pipeline's stage: long texts with a word changed meet by their Golay keys, and go."""
    import corpus_pipeline as cp
    from cladeworks.llm import simhash

    rng, rows = random.Random(14), []
    for k in range(6):
        w = sentence(rng, 3000).split()
        rows.append((10 * k, " ".join(w)))
        w[1500] = "changed"
        rows.append((10 * k + 1, " ".join(w)))
    seen, plain = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda *a: (seen.append(plain(*a).count()), plain(*a))[1])
    assert {r.doc_id for r in cp.near_duplicate_stage(spark, frame(spark, rows, clashing=False), "").collect()} == {10 * k for k in range(6)}
    assert len(seen) == 1 and seen[0] >= 3


def test_long_unlike_sets_are_not_read_again(spark, monkeypatch):
    """Texts that share half of their words meet, but their marks tell them apart: no whole set is moved."""
    from cladeworks.llm import simhash

    rng = random.Random(15)
    common = sentence(rng, 1500)
    rows = [(k, f"{common} {sentence(rng, 1500)}") for k in range(12)]
    made, plain = defaultdict(int), simhash.materialize

    def counted(df, name):
        out = plain(df, name)
        made[name] += out.count()
        return out

    monkeypatch.setattr(simhash, "materialize", counted)
    assert {r.doc_id: r.component for r in similar_documents(frame(spark, rows)).collect()} == {k: k for k in range(12)}
    assert made["met"] > 0 and made["pairs"] == 0 == made["sets"]


def test_common_shingles_make_no_pairs(spark, monkeypatch):
    """Texts that share a passage and are else unlike don't meet in each of its shingles: pairs don't grow with the square of their number."""
    from cladeworks.llm import simhash

    rng = random.Random(16)
    passage = sentence(rng, 6)
    rows = [(k, f"{sentence(rng, 10)} {passage} {sentence(rng, 10)}") for k in range(120)]
    made, plain = defaultdict(int), simhash.materialize

    def counted(df, name):
        out = plain(df, name)
        made[name] += out.count()
        return out

    monkeypatch.setattr(simhash, "materialize", counted)
    assert {r.doc_id: r.component for r in similar_documents(frame(spark, rows)).collect()} == {k: k for k in range(120)}
    assert made["candidates"] < 1000  # with single shingles as keys about 7,000


def test_neighbour_keys():
    """Keys of two neighbours, a single token by itself, no key of an empty set; at most so many."""
    from cladeworks.llm.simhash import neighbour_keys

    sets = [[], [3], [1, 2, 5, 9], [2, 5], [4]]
    first = np.cumsum([0, *map(len, sets)])
    keys, at = neighbour_keys(np.array(sum(sets, []), np.uint64), first, None)
    assert np.diff(at).tolist() == [0, 1, 3, 1, 1] and keys[2] == keys[4] and keys[0] == 3 and keys[5] == 4
    keys, at = neighbour_keys(np.array(sum(sets, []), np.uint64), first, 2)
    assert np.diff(at).tolist() == [0, 1, 2, 1, 1] and len(keys) == 5


def test_marks_of_sets():
    """Never more than what is in only one of two sets; sets of which a byte can't hold a count rule out nothing."""
    from cladeworks.llm.simhash import counted_marks, least_apart

    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 63, 64, 65, 300, 1023, 1024, 5000):
        for m in (n, n + n // 9, n // 2):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            y = np.unique(np.concatenate([x[: m // 2], rng.integers(0, 1 << 63, m - m // 2, dtype=np.uint64)]))
            marks = counted_marks(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])).to_pylist()
            assert least_apart(*marks) <= len(np.setxor1d(x, y)) and least_apart(marks[0], marks[0]) == 0
            assert least_apart(*marks) >= abs(len(x) - len(y))
    same = np.arange(1000, dtype=np.uint64) << np.uint64(20)
    assert counted_marks(same, np.array([0, 1000])).to_pylist() == [b""] and least_apart(b"", b"\1" * 64) == 0


def test_golay_keys_meet():
    from cladeworks.llm.simhash import keys

    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.choice([1, 2])):
            b ^= 1 << bit
        held, looked = keys(np.array([a, b], np.uint64))
        assert set(held[0]) & set(looked[1].ravel()) and set(held[1]) & set(looked[0].ravel())


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 40)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(80)] + [(5, 5), (1, 0)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for node, least in got.items():
        seen, todo = {node}, [node]
        while todo:
            todo += [x for x in near[todo.pop()] if x not in seen and not seen.add(x)]
        assert least == min(seen)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_contaminated(rows, items, window=20, share=0.8):
    tokens = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for i, t in rows:
        d = tokens(t)
        for k, x in items:
            c = tokens(x)
            w = min(window, len(c))
            if not w:
                continue
            best = max((sum(d[p + o] == c[q + o] for o in range(w)) for p in range(len(d) - w + 1) for q in range(len(c) - w + 1)), default=0)
            if best >= -(-w * share // 1):
                out[i, k] = max(best, out.get((i, k), 0))
    return out


def test_decontamination(spark):
    rng = random.Random(8)
    items = [(k, sentence(rng, n)) for k, n in enumerate([16, 17, 20, 25, 40, 60])] + [(90, None), (91, ""), (92, "two words")]
    rows = awkward_rows()[:-4]
    for k, (_, t) in enumerate(items[:6]):
        for cuts in range(5):
            w = t.split()
            for _ in range(cuts):
                w[rng.randrange(len(w))] = "swapped"
            rows.append((5000 + 10 * k + cuts, f"{sentence(rng, 9)} {' '.join(w).upper()}, {sentence(rng, 8)}"))
    rows.append((6000, " ".join(items[5][1].split()[20:45])))
    got = {(r.doc_id, r.item_id): r.matched for r in contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_contaminated(rows, items) and len(got) > 20
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(frame(spark, rows), none).count() == 0


def test_decontamination_widths(spark):
    """Items of every width up to 21, each twice, with every number of substitutions up to one too many."""
    rng = random.Random(9)
    items = [(100 * copy + n, t) for n in range(1, 22) for t in [" ".join(f"w{n}x{rng.randrange(10**6)}" for _ in range(n))] for copy in (0, 1)]
    rows = []
    for n, t in items[::2]:
        for cuts in range(n - -(-4 * n // 5) + 2):
            for k in range(6):
                w = t.split()
                for o in rng.sample(range(n), min(cuts, n)):
                    w[o] = "swapped"
                rows.append((10_000 * n + 100 * cuts + k, " ".join(["lead"] * rng.randrange(4) + w + ["rest"] * rng.randrange(4))))
    got = {(r.doc_id, r.item_id): r.matched for r in contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_contaminated(rows, items) and {k % 100 for _, k in got} == set(range(1, 22))


def test_decontamination_masks():
    for width in range(1, 21):
        gone = width - -(-4 * width // 5)
        fixed = [{at + o for o, c in enumerate(m) if c == "1"} for at, m in whole_masks(width, gone)]
        assert all(max(p) < width for p in fixed)
        assert always_hit(width, gone, MASKS) or all(any(not p & set(x) for p in fixed) for x in combinations(range(width), gone))


def test_decontamination_empty(spark):
    items, rows = [(1, "a b c d e f g h i j k l m n o p q r")], awkward_rows()
    assert contaminated(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert contaminated(frame(spark, rows), spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")).count() == 0


def test_image_copies(spark):
    rng = np.random.default_rng(5)
    base = [resized(rng.random((1, 14, 14)).astype(np.float32) * 255, 160, 160)[0] for _ in range(12)]
    row = lambda i, g: (i, *g.shape, bytearray(np.rint(np.clip(g, 0, 255)).astype(np.uint8).tobytes()))
    rows = [row(i, g) for i, g in enumerate(base)]
    for i in range(6):
        edited = base[i] * 0.8 + 20 + rng.normal(0, 2, (160, 160))
        edited[60:90, 60:90] = 0
        rows += [row(100 + i, base[i][12:150, 20:155]), row(200 + i, edited), row(300 + i, np.rot90(base[i])), row(400 + i, resized(base[i][None], 107, 107)[0]), row(500 + i, base[i])]
    rows += [(999, 10, 10, None), (998, 5, 5, bytearray(25)), (997, 100, 100, bytearray(10000)), (996, 3, 3, bytearray(2)), (None, 100, 100, bytearray(10000))]
    images = spark.createDataFrame(rows, "id long, height int, width int, pixels binary")
    got = {r.id: (r.n_others, r.component) for r in image_copies(images).collect()}
    assert len(got) == len(rows)
    for i in range(6):
        assert all(got[100 * k + i][1] == i for k in range(1, 6))
    assert all(got[i] == (0, i) for i in range(6, 12))
    assert got[999] == (0, 999) and got[996] == (0, 996)
    assert image_copies(images.limit(0)).count() == 0
    vectors = spark.createDataFrame([(1, [0.1, 0.2, 0.3, 0.4]), (2, None), (3, []), (4, [1.0, None, 2.0, 3.0, 9.0])], "vec_id long, embedding array<float>")
    assert {r.vec_id: r.pixels is None for r in vector_images(vectors).collect()} == {1: False, 2: True, 3: True, 4: False}
    # every value counts, and a null is a zero in its place
    several = spark.createDataFrame([(1, [0.0] * 79 + [1.0]), (2, [0.0] * 78 + [1.0, 0.0]), (3, [1.0, None, 2.0]), (4, [1.0, 0.0, 2.0])], "vec_id long, embedding array<double>")
    drawn = {r.vec_id: bytes(r.pixels) for r in vector_images(several).collect()}
    assert drawn[1] != drawn[2] and drawn[3] == drawn[4]


def test_image_copies_under_edits(spark):
    """Drawn vectors and edited copies of them: the groups that brute-force pairing of all images gives, and nearly all copies."""
    from cladeworks.llm.imagekernels import features

    rng = np.random.default_rng(7)
    vectors = spark.createDataFrame([(i, rng.normal(0, 1, 64).tolist()) for i in range(25)], "vec_id long, embedding array<double>")
    rows = [tuple(r) for r in vector_images(vectors).collect()]
    for i, h, w, pixels in rows[:20]:
        g = np.frombuffer(pixels, np.uint8).reshape(h, w).astype(float)
        edits = [g + rng.normal(0, 8, g.shape), g * 0.9 + 10 + rng.normal(0, 2, g.shape), np.rot90(g), g[9:, 5:], resized(g[None].astype(np.float32), 64, 64)[0]]
        rows += [(100 * (k + 1) + i, *x.shape, bytearray(np.rint(np.clip(x, 0, 255)).astype(np.uint8).tobytes())) for k, x in enumerate(edits)]
    got = {r.id: r for r in image_copies(spark.createDataFrame(rows, "id long, height int, width int, pixels binary")).collect()}
    assert len(got) == len(rows) and all(got[i].component == i for i in range(25))
    assert sum(got[100 * k + i].component == i for k in range(1, 6) for i in range(20)) >= 95

    found = {i: features(np.frombuffer(p, np.uint8).reshape(1, h, w).astype(np.float32), 24, 3)[0] for i, h, w, p in rows}
    group = {i: i for i in found}
    linked = 0
    for a in sorted(found):
        for b in sorted(found):
            if a < b and agree(found[a], found[b], 32, 4, 12.0):
                linked += 1
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert linked >= 100 and sum(got[i].component == group[i] for i in found) >= 0.98 * len(found)


def test_image_groups_settle_without_a_pass_over_all_links(spark, monkeypatch):
    """Rounds hook components to others, so only links that no round followed are left to the search for components."""
    from cladeworks.llm import media

    passed = []
    monkeypatch.setattr(media, "connected_components", lambda edges: passed.append(edges.count()) or connected_components(edges))
    rng = np.random.default_rng(11)
    vectors = spark.createDataFrame([(i, rng.normal(0, 1, 64).tolist()) for i in range(3)], "vec_id long, embedding array<double>")
    rows = []
    for i, h, w, pixels in map(tuple, vector_images(vectors).collect()):
        g = np.frombuffer(pixels, np.uint8).reshape(h, w).astype(float)
        near = [g, *(np.clip(g * 0.95 + 5 + rng.normal(0, 2, g.shape), 0, 255) for _ in range(9))]
        rows += [(10 * i + k, h, w, bytearray(np.rint(x).astype(np.uint8).tobytes())) for k, x in enumerate(near)]
    got = {r.id: (r.n_others, r.component) for r in image_copies(spark.createDataFrame(rows, "id long, height int, width int, pixels binary")).collect()}
    assert got == {10 * i + k: (9, 10 * i) for i in range(3) for k in range(10)}
    assert sum(passed) <= 3


def test_component_hooks_are_followed_to_their_ends(spark):
    from cladeworks.llm.media import followed, relabelled

    hooks = spark.createDataFrame([(k + 1, k) for k in range(9)] + [(20, 15), (30, 20)], "component long, root long")
    ends = {r.component: r.root for r in followed(hooks).collect()}
    assert ends == {**{k + 1: 0 for k in range(9)}, 20: 15, 30: 15}
    labels = relabelled(None, spark.createDataFrame([(7, 5), (9, 5)], "component long, root long"))
    moved = relabelled(labels, spark.createDataFrame([(5, 2)], "component long, root long"))
    assert {r.id: r.component for r in moved.collect()} == {7: 2, 9: 2, 5: 2}


def test_packing_stage_leaves_no_encoder_in_workers(spark, sf_dir):
    """Workers live on beside later stages and runs: what a task of the stage remembers goes with it."""
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert cp.packing_stage(spark, docs.repartition(4), sf_dir).count() > 0

    def held(batches):
        import gc

        import pyarrow as pa

        from cladeworks.llm.packing import MEMO_ENTRIES, IdEncoder

        for _ in batches:
            own = [x for x in gc.get_objects() if type(x) is IdEncoder and x.memo.most < MEMO_ENTRIES // 2]
            yield pa.RecordBatch.from_arrays([pa.array([len(own)], pa.int64())], ["n"])

    assert {r.n for r in spark.range(400).repartition(16).mapInArrow(held, "n long").collect()} == {0}


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    for k, (name, stage) in enumerate(cp.STAGES):
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        after = cp.materialize(stage(spark, docs, sf_dir), f"stage{k}")
        if k < 4:
            assert after.columns == docs.columns
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        if name == "line dedup":
            gone = brute_lines(before)
            want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in before if any((i, n) not in gone for n in range(len(t.split("\n"))))}
            assert {r.doc_id: r.text for r in after.collect()} == want
        if name == "SimHash near-dedup":
            assert ids == {i for i, (_, g) in plain_links(before).items() if i == g}
        if name == "benchmark decontamination":
            assert ids == {i for i, _ in before} - {i for i, _ in {k: 0 for k in brute_contaminated_fast(before, benchmark)}}
        docs = after
    assert {r.doc_id for r in docs.collect()} <= {i for i, _ in before}
    assert cp.run(spark, sf_dir).count() > 0


def test_similar_documents(spark):
    """The pipeline's near duplicates, by the bounded and by the whole prefix."""
    rows = [(i, t) for i, t in copies(5) if t]
    want = {i: g for i, (_, g) in plain_links(rows).items()}
    for sketch in (20, None):
        assert {r.doc_id: r.component for r in similar_documents(frame(spark, rows), sketch=sketch).collect()} == want


def test_decontamination_of_odd_ids(spark, tmp_path):
    """A text with a passage goes with a null id too, and one without stays though it shares an id with one that goes."""
    import corpus_pipeline as cp

    passage = " ".join(f"word{k}" for k in range(25))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"begin {passage} end"), (1, f"other {passage}"), (1, "a clean text"), (None, "clean without id"), (2, None), (2, None)]
    kept = cp.decontamination_stage(spark, frame(spark, rows), str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, "a clean text"), (None, "clean without id"), (2, None), (2, None)], key=str)


def brute_contaminated_fast(rows, items, window=20, share=0.8):
    """As brute_contaminated, with aligned windows counted by array."""
    tokens = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    hashed = lambda t: np.array([hash(w) for w in tokens(t)], np.int64)
    out, made = set(), [(k, hashed(x)) for k, x in items]
    for i, t in rows:
        d = hashed(t)
        for k, c in made:
            w = min(window, len(c))
            if len(d) < w:
                continue
            for q in range(len(c) - w + 1):
                if (sum((d[o : len(d) - w + 1 + o] == c[q + o]).astype(int) for o in range(w)) >= -(-w * share // 1)).any():
                    out.add((i, k))
                    break
    return out


def test_image_keys_are_made_once_and_only_shared_ones_written(spark, monkeypatch):
    """Rounds read the keys that images share; before, each made all keys again, and a full bitmap let all of them pass."""
    from cladeworks.llm import media

    made, written = [], {}
    keyed, materialize = media.keyed, media.materialize
    monkeypatch.setattr(media, "keyed", lambda *args: made.append(keyed(*args)) or made[-1])

    def counted(df, name):
        out = materialize(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(media, "materialize", counted)
    rng = np.random.default_rng(13)
    vectors = spark.createDataFrame([(i, rng.normal(0, 1, 64).tolist()) for i in range(12)], "vec_id long, embedding array<double>")
    rows = [tuple(r) for r in vector_images(vectors).collect()]
    i, h, w, pixels = rows[0]
    rows.append((50, h, w, bytearray(np.clip(np.frombuffer(pixels, np.uint8) * 0.95 + 5, 0, 255).astype(np.uint8).tobytes())))
    got = {r.id: (r.n_others, r.component) for r in image_copies(spark.createDataFrame(rows, "id long, height int, width int, pixels binary")).collect()}
    assert got == {i: (1, 0) if i in (0, 50) else (0, i) for i in [*range(12), 50]}
    assert len(made) == 1
    (shared,) = written["keys"]
    assert 0 < shared < made[0].count() / 3


def test_recurring_keys_over_batches(spark):
    from cladeworks.llm.media import recurring

    rng = np.random.default_rng(2)
    rows = [(int(k), i) for i, k in enumerate(rng.integers(0, 300, 400))] + [(1000, 1000 + i) for i in range(30)]
    keys = spark.createDataFrame(rows, "key long, id long")
    counts = {k: sum(x == k for x, _ in rows) for k, _ in rows}
    for size in (1, 2, 7, 10000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert sorted(map(tuple, recurring(keys).collect())) == sorted(r for r in rows if counts[r[0]] > 1)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert recurring(keys.limit(0)).count() == 0


def test_pairs_that_may_be_copies_are_not_discarded_early(spark):
    """What ``likely`` lets pass holds every pair that agrees, and hardly any of unlike images."""
    from cladeworks.llm.imagekernels import features, waves
    from cladeworks.llm.media import likely, verified

    rng = np.random.default_rng(3)
    grey = waves(rng.normal(0, 1, (40, 64)).astype(np.float32), 96).astype(np.float32)
    stack = np.concatenate([grey, *(np.clip(grey[:20] + rng.normal(0, noise, grey[:20].shape), 0, 255) for noise in (8, 16, 24, 32))])
    found = features(stack.astype(np.float32), 24, 3)
    corners = spark.createDataFrame([(i, bytearray(f.tobytes())) for i, f in enumerate(found)], "id long, corners binary")
    every = [(a, b) for a in range(len(found)) for b in range(a + 1, len(found))]
    pairs = spark.createDataFrame(every, "a long, b long")
    good = {p for p in every if agree(found[p[0]], found[p[1]], 32, 4, 12.0)}
    assert len(good) > 30
    maybe = {tuple(r) for some in likely(pairs, corners, 32, 4) for r in some.collect()}
    assert good <= maybe and len(maybe - good) < len(every) / 20
    assert {tuple(r) for r in verified(pairs, corners, 32, 4, 12.0).collect()} == good


def test_copies_that_share_a_single_key_are_linked(spark, monkeypatch):
    """Rounds leave out pairs with one key that few images have; the comparison in full still links them, in however many goes."""
    from cladeworks.llm import media

    keyed, likely, goes = media.keyed, media.likely, []

    def one_key(corners, *args):
        keys = keyed(corners, *args)
        shared = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
        return keys.join(shared.groupBy("first", "last").agg(F.min("key").alias("key")).select("key"), "key")

    rng = np.random.default_rng(17)
    vectors = spark.createDataFrame([(i, rng.normal(0, 1, 64).tolist()) for i in range(5)], "vec_id long, embedding array<double>")
    rows = [tuple(r) for r in vector_images(vectors).collect()]
    for i, h, w, pixels in rows[:3]:
        rows.append((10 + i, h, w, bytearray(np.clip(np.frombuffer(pixels, np.uint8) * 0.9 + 10, 0, 255).astype(np.uint8).tobytes())))
    images = spark.createDataFrame(rows, "id long, height int, width int, pixels binary")
    monkeypatch.setattr(media, "keyed", one_key)
    monkeypatch.setattr(media, "likely", lambda *args: goes.append(likely(*args)) or goes[-1])
    for most in (media.PAIRS, 1):
        monkeypatch.setattr(media, "PAIRS", most)
        got = {r.id: (r.n_others, r.component) for r in image_copies(images).collect()}
        assert got == {i: (int(i % 10 < 3), i % 10) for i in [*range(5), 10, 11, 12]}
    assert [len(x) for x in goes] == [1, 3]
