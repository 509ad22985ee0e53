"""Operator 12: spelling variants by k-d trees over letter-count vectors."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.common import drop_materialized, give_back_memory, materialize, read_table

#: Words have at least this many code points and occurrences; a word's form is at least this many times as frequent.
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: One draw in so many deletes a code point.
TYPO = 31
#: Words that the split planes are fitted on, and that a bucket should hold; a bucket of twice as many is dealt out in parts.
SAMPLE, BUCKET = 100_000, 40_000
#: Words of a leaf of the trees inside a bucket, node pairs and word pairs that are compared at a time.
LEAF, NODE_PAIRS, WORD_PAIRS = 12, 1 << 17, 1 << 20
#: Distinct words that a task counts before it passes them on.
HELD = 200_000
#: Letters a-z and U+00C0 to U+00FF have a dimension each.
LETTERS = 26 + 64
#: Bits of a letter's count in the marks that leaves are compared by; a count above is taken as this.
MARKED = 3

RUNS = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LENGTH)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters with the contract's deletions, counted within tasks."""

    def told(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for k, i in enumerate(ids):
                # a character beyond U+00FF is in no run, and neither is the ? that stands for it
                raw = (texts[k].as_py() or "").encode("latin-1", "replace").lower()
                begin = zlib.crc32(f"{'' if i is None else i}:".encode())
                for run_bytes, n in Counter(RUNS.findall(raw)).items():
                    word = run_bytes.decode("latin-1")
                    h = zlib.crc32(run_bytes if run_bytes.isascii() else word.encode(), begin)
                    if h % TYPO == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LENGTH:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield told(held)
                    held = Counter()
        if held:
            yield told(held)
        give_back_memory()

    return docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return occurrences(docs, id_col, text_col).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def codes_of(words: list[str]) -> np.ndarray:
    """A row of code points for each word; all have the same length."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts, those over 250 as 250: distances only get smaller by that."""
    places = np.where(codes >= 0xC0, codes.astype(np.int64) - 0xC0 + 26, codes.astype(np.int64) - 97)
    n = len(codes)
    out = np.empty((n, LETTERS), np.int16)
    for a in range(0, n, 1 << 16):
        some = places[a : a + (1 << 16)]
        flat = (np.arange(len(some))[:, None] * LETTERS + some).ravel()
        out[a : a + len(some)] = np.minimum(np.bincount(flat, minlength=len(some) * LETTERS).reshape(len(some), LETTERS), 250)
    return out


def cut(points: np.ndarray) -> tuple[int, int] | None:
    """(letter, count up to which a point goes left) of the most varied letter, as near the middle as can be; None where all are equal."""
    sums = points.sum(0, dtype=np.int64)
    spread = np.einsum("ij,ij->j", points, points, dtype=np.int64) - sums * sums / len(points)
    letter = int(spread.argmax())
    counts = np.bincount(points[:, letter])
    if counts.max() == len(points):
        return None
    below = np.cumsum(counts)[:-1]
    below = np.where(below == 0, -len(points), below)
    return letter, int(np.abs(below - len(points) / 2).argmin())


class Planes:
    """The split planes above the buckets, for each length that the sample has; other lengths are a bucket each.

    Their number is bounded by the sample. A plane is (letter, bound, left, right), a leaf the number of its bucket.
    """

    def __init__(self, sample: list[str], share: float):
        self.roots, self.nodes, self.buckets = {}, [], 0
        by_length: dict[int, list[str]] = {}
        for word in sorted(sample):
            by_length.setdefault(len(word), []).append(word)
        most = max(8, BUCKET * share)
        for length, words in sorted(by_length.items()):
            self.roots[length] = self._grow(vectors(codes_of(words)), most)

    def _grow(self, points: np.ndarray, most: float) -> int:
        if len(points) <= most or (plane := cut(points)) is None:
            self.buckets += 1
            return -self.buckets
        letter, bound = plane
        left = points[:, letter] <= bound
        at = len(self.nodes)
        self.nodes.append(None)
        self.nodes[at] = (letter, bound, self._grow(points[left], most), self._grow(points[~left], most))
        return at

    def reached(self, length: int, points: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
        """(bucket, indices of points): all buckets of words of ``length`` whose box lies within ``radius``; 0 gives each point's own.

        A replaced letter adds one and takes one, a deleted one only takes one.
        """
        if length not in self.roots:
            return [(-length, np.arange(len(points)))]
        up, out = int(radius == 2), []
        stack = [(self.roots[length], np.arange(len(points)), {})]
        while stack:
            at, some, box = stack.pop()
            if at < 0:
                out.append((-at, some))
                continue
            letter, bound, left, right = self.nodes[at]
            low, high = box.get(letter, (0, 250))
            for child, edges in ((left, (low, bound)), (right, (bound + 1, high))):
                near = box | {letter: edges}
                keys = list(near)
                values = points[np.ix_(some, keys)]
                lows, highs = np.array([near[k] for k in keys]).T
                more, less = np.maximum(0, lows - values).sum(1), np.maximum(0, values - highs).sum(1)
                kept = some[(more <= up) & (less <= (radius > 0))]
                if kept.size:
                    stack.append((child, kept, near))
        return out


def own_buckets(vocab: DataFrame, planes: Planes) -> DataFrame:
    """(word, n, bucket): each word in the box that it lies in."""

    def run(batches):
        for batch in batches:
            words, bucket = batch.column(0).to_pylist(), np.zeros(batch.num_rows, np.int64)
            for length, at in of_lengths(words).items():
                for b, some in planes.reached(length, vectors(codes_of([words[k] for k in at])), 0):
                    bucket[at[some]] = b
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bucket)], ["word", "n", "bucket"])

    return vocab.select("word", "n").mapInArrow(run, "word string, n long, bucket long")


def of_lengths(words: list[str]) -> dict[int, np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return {int(length): np.flatnonzero(lengths == length) for length in np.unique(lengths)}


#: What a word is in a bucket: held there; looked up there; looked up there as a word that is one longer.
HOLD, SAME, LONGER = 0, 1, 2


def routed(placed: DataFrame, planes: Planes, parts: dict[int, int]) -> DataFrame:
    """(bucket, part, side, word, n): where each word is held, and where it is looked up.

    Of two words of one length in different buckets or parts, the one in the smaller is looked up with the other, so each pair meets
    once. ``parts``: buckets that are dealt out in more than one part.
    """

    def run(batches):
        for batch in batches:
            words, own = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            rows, buckets, part, sides = [], [], [], []

            def put(at, bucket, p, side):
                rows.append(at)
                buckets.append(np.full(len(at), bucket, np.int64))
                part.append(np.broadcast_to(np.asarray(p, np.int32), (len(at),)))
                sides.append(np.full(len(at), side, np.int8))

            for length, at in of_lengths(words).items():
                points = vectors(codes_of([words[k] for k in at]))
                for side, target, radius in ((SAME, length, 2), (LONGER, length - 1, 1)):
                    if side == LONGER and target < LEAST_LENGTH:
                        continue
                    for bucket, some in planes.reached(target, points, radius):
                        some = at[some]
                        for p in range(parts.get(bucket, 1)):
                            put(some if side == LONGER else some[own[some] < bucket], bucket, p, side)
                for bucket in np.unique(own[at]):
                    some, n = at[own[at] == bucket], parts.get(int(bucket), 1)
                    mine = np.array([zlib.crc32(words[k].encode()) % n for k in some]) if n > 1 else np.zeros(len(some), np.int64)
                    put(some, bucket, mine, HOLD)
                    for p in range(1, n):
                        put(some[mine < p], bucket, p, SAME)
            at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            for a in range(0, len(at), 10_000):
                some = slice(a, a + 10_000)
                taken = pa.array(at[some])
                if a == 0:
                    buckets, part, sides = (np.concatenate(x) for x in (buckets, part, sides))
                yield pa.RecordBatch.from_arrays([pa.array(buckets[some]), pa.array(part[some], pa.int32()), pa.array(sides[some], pa.int32()), batch.column(0).take(taken), batch.column(1).take(taken)], ["bucket", "part", "side", "word", "n"])

    return placed.select("word", "n", "bucket").mapInArrow(run, "bucket long, part int, side int, word string, n long")


class Tree:
    """A k-d tree over letter counts: cut at the most varied letter down to LEAF words, with each node's tight box."""

    def __init__(self, words: list[str]):
        self.codes = codes_of(words)
        points = vectors(self.codes)
        self.order = np.arange(len(words))
        ends, kids, low, high = [], [], [], []
        stack = [(0, len(words), -1, 0)]
        while stack:
            a, b, father, place = stack.pop()
            at = len(ends)
            if father >= 0:
                kids[father][place] = at
            some = points[self.order[a:b]]
            ends.append((a, b))
            kids.append([-1, -1])
            low.append(some.min(0))
            high.append(some.max(0))
            if b - a > LEAF and (plane := cut(some)) is not None:
                left = some[:, plane[0]] <= plane[1]
                rows = self.order[a:b]
                self.order[a:b] = np.concatenate([rows[left], rows[~left]])
                middle = a + int(left.sum())
                stack += [(middle, b, at, 1), (a, middle, at, 0)]
        self.ends, self.kids, self.low, self.high = np.array(ends), np.array(kids), np.array(low, np.int16), np.array(high, np.int16)
        bits = np.minimum(points, MARKED)
        unary = np.concatenate([bits > k for k in range(MARKED)], axis=1)
        unary = np.pad(unary, ((0, 0), (0, -unary.shape[1] % 64)))
        marks = np.packbits(unary, axis=1).view(np.uint64)
        self.marks = np.ascontiguousarray(marks[self.order].T)


def near_leaves(x: Tree, y: Tree, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves whose boxes are within ``radius``: both trees are walked down at once, box by box. Of one tree, each pair once."""
    out, stack, same = [], [(np.zeros(1, np.int64), np.zeros(1, np.int64))], x is y
    while stack:
        a, b = stack.pop()
        if len(a) > NODE_PAIRS:
            half = len(a) // 2
            stack += [(a[:half], b[:half]), (a[half:], b[half:])]
            continue
        apart = np.maximum(0, np.maximum(x.low[a] - y.high[b], y.low[b] - x.high[a])).sum(1)
        a, b = a[apart <= radius], b[apart <= radius]
        end_a, end_b = x.kids[a, 0] < 0, y.kids[b, 0] < 0
        if (done := end_a & end_b).any():
            out.append((a[done], b[done]))
        a, b, end_a, end_b = a[~done], b[~done], end_a[~done], end_b[~done]
        below = []
        for i in (0, 1):
            for j in (0, 1):
                kept = ~((end_a & (i == 1)) | (end_b & (j == 1)))
                p, q = np.where(end_a, a, x.kids[a, i])[kept], np.where(end_b, b, y.kids[b, j])[kept]
                below.append((p[p <= q], q[p <= q]) if same else (p, q))
        p, q = (np.concatenate(z) for z in zip(*below, strict=True))
        if len(p):
            stack.append((p, q))
    return out


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by one replaced letter (same width), or by one that only the wider x has."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(1) == 1
    width = y.shape[1]
    before, behind = x[:, :width] != y, x[:, 1:] != y
    first = np.where(before.any(1), before.argmax(1), width)
    last = np.where(behind.any(1), width - 1 - behind[:, ::-1].argmax(1), -1)
    return last < first


def near_words(x: Tree, y: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Indices of words of x and y that are one edit apart; x is as long as y, or one longer. Of one tree, each pair once."""
    radius, found = 2 if x.codes.shape[1] == y.codes.shape[1] else 1, []
    for a, b in near_leaves(x, y, radius):
        sizes = (x.ends[a, 1] - x.ends[a, 0]) * (y.ends[b, 1] - y.ends[b, 0])
        sums = np.cumsum(sizes)
        begin = 0
        while begin < len(a):
            stop = max(begin + 1, int(np.searchsorted(sums, (sums[begin - 1] if begin else 0) + WORD_PAIRS)))
            p, q, n = a[begin:stop], b[begin:stop], sizes[begin:stop]
            begin = stop
            which = np.repeat(np.arange(len(p)), n)
            within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            wide = (y.ends[q, 1] - y.ends[q, 0])[which]
            i, j = x.ends[p, 0][which] + within // wide, y.ends[q, 0][which] + within % wide
            if x is y:
                i, j = i[i < j], j[i < j]
            apart = np.zeros(len(i), np.uint8)
            for u, v in zip(x.marks, y.marks, strict=True):
                apart += np.bitwise_count(u[i] ^ v[j])
            i, j = x.order[i[apart <= radius]], y.order[j[apart <= radius]]
            good = one_edit(x.codes[i], y.codes[j])
            found.append((i[good], j[good]))
    return tuple(np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def near_pairs(rows: DataFrame, tasks: int) -> DataFrame:
    """(a, n_a, b, n_b): words that differ by exactly one inserted, deleted or replaced code point, each pair once."""

    def run(batches):
        state = {"key": None, "held": None, "now": None, "words": [], "n": []}

        def pairs(x, n_x, words_x, y, n_y, words_y):
            i, j = near_words(x, y)
            for a in range(0, len(i), 50_000):
                p, q = pa.array(i[a : a + 50_000]), pa.array(j[a : a + 50_000])
                yield pa.RecordBatch.from_arrays([words_x.take(p), n_x.take(p), words_y.take(q), n_y.take(q)], ["a", "n_a", "b", "n_b"])

        def close():
            """The words gathered so far are looked up among those held, or become those."""
            if not state["words"]:
                return
            words, n = pa.concat_arrays(state["words"]), pa.concat_arrays(state["n"])
            state["words"], state["n"] = [], []
            side = state["now"][2]
            if side != HOLD and state["held"] is None:
                return
            tree = Tree(words.to_pylist())
            if side == HOLD:
                state["held"] = (tree, n, words)
                yield from pairs(tree, n, words, tree, n, words)
            else:
                yield from pairs(tree, n, words, *state["held"])

        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            starts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1])] if keys else []
            for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
                full = keys[a][2] != HOLD and sum(map(len, state["words"])) >= BUCKET
                if keys[a] != state["now"] or full:
                    yield from close()
                    if state["now"] is None or keys[a][:2] != state["now"][:2]:
                        state["held"] = None
                    state["now"] = keys[a]
                state["words"].append(batch.column(3).slice(a, b - a))
                state["n"].append(batch.column(4).slice(a, b - a))
        yield from close()
        state.clear()
        give_back_memory()

    dealt = rows.repartition(tasks, "bucket", "part").sortWithinPartitions("bucket", "part", "side")
    return dealt.select("bucket", "part", "side", "word", "n").mapInArrow(run, "a string, n_a long, b string, n_b long")


def spelling_forms(vocab: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a written table (word, n) of distinct words over a-z and U+00C0 to U+00FF.

    For each pair of lengths (equal, or one apart) words are looked up in k-d trees over their letter counts: one edit moves them by two at
    most. The planes above the buckets are fitted on a sample of SAMPLE words, every word is held and looked up; large
    buckets, such as anagrams that no plane parts, are dealt out in parts. Inside a bucket two trees are walked down together, and words of
    near leaves are checked letter by letter.

    A word's form is its near word of the largest n, ties by code points, if that is TIMES its own n or more; the root is where forms lead
    to, found by doubling the steps. Words of any length count; an empty table gives an empty one. Nulls can't occur.
    """
    total = vocab.count()
    rate = max(1, -(-total // SAMPLE))
    sample = [r.word for r in vocab.where(F.pmod(F.xxhash64("word"), F.lit(rate)) == 0).select("word").collect()]
    planes = Planes(sample, len(sample) / max(total, 1))
    placed = materialize(own_buckets(vocab, planes), "placed")
    sizes = {r.bucket: -(-r["n"] // (2 * BUCKET)) for r in placed.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 2 * BUCKET).collect()}
    tasks = max(int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(20_000, 2 * (planes.buckets + sum(sizes.values()))))
    pairs = near_pairs(routed(placed, planes, sizes), tasks)
    side = lambda x, y: F.struct(F.col(x).alias("word"), F.col(y).alias("other"), F.col(f"n_{y}").alias("m"))
    near = pairs.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("s")).select("s.word", F.lit(None).cast("long").alias("n"), "s.other", "s.m")
    own = placed.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("m"))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("m")).alias("less"), "other")))
    found = near.unionAll(own).groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    large = -F.col("best.less") >= TIMES * F.col("n")
    told = materialize(found.select("word", "n", "n_near", F.when(large, F.col("best.other")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n")), "told")

    steps = materialize(told.where("form is not null").select("word", F.col("form").alias("root")), "steps")
    while True:  # n grows tenfold with each step, so a few rounds do
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = materialize(steps.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "steps")
        drop_materialized(steps)
        steps = moved
        if not moved.where("moved").limit(1).count():
            break
    out = materialize(told.join(steps.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "forms")
    drop_materialized(placed, told, steps)
    return out


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts have no words; a null doc_id draws as an empty one; repeated rows count each; very long texts count whole."""
    vocab = materialize(vocabulary(read_table(spark, sf_dir, "documents")), "vocabulary")
    found = spelling_forms(vocab)
    drop_materialized(vocab)
    return found
