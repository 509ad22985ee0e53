"""Operator 9: SimHash near-duplicates by Golay-code fuzzy hashing of fingerprint segments."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.bitmaps import Bitmap, bits_for
from cladeworks.llm.common import drop_materialized, materialize, read_table
from cladeworks.llm.components import connected_components
from cladeworks.llm.textkernels import U, fingerprints, majority_bits, shingle_sets

#: Bytes of text whose shingles are hashed together, and the most texts.
TOGETHER, MOST_TEXTS = 1 << 20, 4096
#: The fewest counters in the marks of a token set.
MARKS = 64
#: The most keys that a set is looked up by, unless all are asked for. A key stands for two tokens that are neighbours in the set's
#: order. Of two sets with a Jaccard index of 0.8 no two neighbours among the smallest 49 tokens of the union are in both
#: with probability 1e-14 or less (a root of x^2 = 0.2 x + 0.16, 0.512, to the power of 49, times 1.6).
SKETCH = 48
#: An odd number that keys are mixed by.
MIX = 0x9E3779B97F4A7C15
# Fixed value: a generator polynomial of the binary (23, 12) Golay code.
GENERATOR = 0xC75
#: (first bit, bits) of the segments; each is a 23-bit word with zeros above.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(syndrome of each byte at each of 3 places, the error of up to 3 bits of each syndrome, its five 4-bit errors).

    The code is perfect: every word is within 3 of one codeword. A word at distance 3 has five more
    codewords at distance 4, any other word none (its five are 0).
    """
    unit = [1 << k for k in range(11)]
    for _ in range(12):
        x = unit[-1] << 1
        unit.append(x ^ GENERATOR if x >> 11 else x)
    syndrome = lambda bits: int(np.bitwise_xor.reduce([unit[b] for b in bits])) if bits else 0
    table = np.array([[syndrome([8 * place + k for k in range(8) if byte >> k & 1 and 8 * place + k < 23]) for byte in range(256)] for place in range(3)], np.uint32)
    near, far, held = np.zeros(2048, np.uint32), np.zeros((2048, 5), np.uint32), np.zeros(2048, int)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            near[syndrome(bits)] = sum(1 << b for b in bits)
    for bits in combinations(range(23), 4):
        s = syndrome(bits)
        far[s, held[s]] = sum(1 << b for b in bits)
        held[s] += 1
    return table, near, far


def decode(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest codeword, indices of all codewords within 4; repeats where there are fewer than six)."""
    table, near, far = golay()
    w = words.astype(np.uint32)
    s = table[0][w & 255] ^ table[1][(w >> 8) & 255] ^ table[2][(w >> 16) & 255]
    nearest = (w ^ near[s]) >> 11
    more = np.where(far[s] > 0, (w[:, None] ^ far[s]) >> 11, nearest[:, None])
    return nearest, np.concatenate([nearest[:, None], more], axis=1)


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n x 3 keys under which fingerprints are held, n x 3 x 6 keys under which they are looked up).

    Of up to two differing bits, the three segments leave one without any and the next one with at
    most one, or the other way round the circle: with segment i equal and segment i + 1 off by at most
    one bit, one side's nearest codeword is within 3 + 1 of the other's word, so it is among those looked up.
    """
    parts = [(prints >> U(at)) & U((1 << bits) - 1) for at, bits in SEGMENTS]
    held, looked = [], []
    for i in range(3):
        nearest, within = decode(parts[(i + 1) % 3])
        exact = (parts[i] << U(14)) | U(i << 12)
        held.append(exact | nearest.astype(U))
        looked.append(exact[:, None] | within.astype(U))
    return np.stack(held, 1).astype(np.int64), np.stack(looked, 1).astype(np.int64)


def simhash_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print): the 64-bit SimHash of every row's whole text, as a signed long. Null and empty texts: 0."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, prints, some, size = batch.column(1), [], [], 0
            for k in range(batch.num_rows):
                some.append((texts[k].as_py() or "").encode())
                size += len(some[-1])
                if size >= TOGETHER or k == batch.num_rows - 1:
                    prints.append(fingerprints(some))
                    some, size = [], 0
            found = np.concatenate(prints).view(np.int64) if prints else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["id", "print"])

    slim = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {kind}, print long")


def links(prints: DataFrame, most: int = 2) -> DataFrame:
    """(a, b): nodes of distinct fingerprints (node, print) that differ in at most two bits, each pair once."""

    def run(batches, side):
        for batch in batches:
            if batch.num_rows:
                found = keys(batch.column(1).to_numpy().view(U))[side]
                flat = found.reshape(len(found), -1)
                new = np.ones(flat.shape, bool)
                if side:  # fewer than six codewords: the nearest one stands for the others
                    new = (found != found[:, :, :1]) | (np.arange(6) == 0)
                    new = new.reshape(flat.shape)
                row = np.nonzero(new)[0]
                yield pa.RecordBatch.from_arrays([pa.array(flat[new]), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))], ["key", "node", "print"])

    kind = prints.schema["node"].dataType.simpleString()
    schema = f"key long, node {kind}, print long"
    slim = prints.select("node", "print")
    held = slim.mapInArrow(lambda it: run(it, 0), schema).alias("h")
    looked = slim.mapInArrow(lambda it: run(it, 1), schema).alias("l")
    close = F.bit_count(F.col("h.print").bitwiseXOR(F.col("l.print"))) <= most
    return looked.join(held, (F.col("h.key") == F.col("l.key")) & (F.col("l.print") < F.col("h.print")) & close).select(F.col("l.node").alias("a"), F.col("h.node").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print, component): rows whose fingerprints are linked, directly or through others, by two or fewer bits.

    Texts stay where they are: only fingerprints are shuffled, and equal ones are merged before they
    are joined. The component is the smallest id reachable. Null and empty texts have fingerprint 0 and
    are linked like any other; bits set in exactly half of the shingles are 0; a null id takes part and
    has itself no smaller id than others; repeated rows are kept; very long texts count whole; an empty
    table gives an empty one; other columns are ignored.
    """
    prints = materialize(simhash_fingerprints(docs, id_col, text_col), "prints")
    distinct = materialize(prints.groupBy("print").agg(F.min("id").alias("node")).select("node", "print"), "distinct")
    parts = connected_components(links(distinct.where("node is not null")))
    named = materialize(distinct.join(parts, "node", "left").select("print", F.coalesce("component", "node").alias("component")), "components")
    return prints.join(named, "print").select(F.col("id").alias(id_col), "print", "component")


def counted_marks(tokens: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each set first[d]:first[d + 1] of tokens, a byte for each bucket of their hashes: how many fall into it.

    There are a power of two of them, a quarter to half of the set's size and MARKS at least. Sets in which a
    byte doesn't hold the number have none.
    """
    n = np.diff(first)
    size = np.maximum(MARKS, 1 << (np.frexp(np.maximum(n, 1))[1] - 2).clip(0)).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    own = np.repeat(np.arange(len(n)), n)
    counts = np.bincount(at[own] + (tokens & (size[own] - 1).astype(U)).astype(np.int64), minlength=at[-1])
    data = np.minimum(counts, 255).astype(np.uint8)
    return pa.array([b"" if c.size and c.max() == 255 else c.tobytes() for c in np.split(data, at[1:-1])], pa.binary())


def least_apart(x: bytes, y: bytes) -> int:
    """So many tokens at least are in only one of two sets with these marks."""
    if not x or not y:
        return 0
    a, b = (np.frombuffer(m, np.uint8).astype(np.int32) for m in (x, y))
    size = min(len(a), len(b))
    return int(np.abs(a.reshape(-1, size).sum(0) - b.reshape(-1, size).sum(0)).sum())


def neighbour_keys(tokens: np.ndarray, first: np.ndarray, most: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first): for each set first[d]:first[d + 1] of sorted tokens, a key for each two neighbours, at most so many; a single token is its own.

    Two sets share the key of two neighbours in their union that are in both; if at least four fifths of the union are, there are such.
    One token that many sets share makes none of them meet.
    """
    n = np.diff(first)
    need = np.where(n > 1, n - 1, n)
    need = need if most is None else np.minimum(need, most)
    keys = tokens * U(MIX) ^ np.roll(tokens, -1)
    single = np.asarray(first[:-1])[n == 1]
    keys[single] = tokens[single]
    kept = np.arange(len(tokens)) - np.repeat(first[:-1], n) < np.repeat(need, n)
    return keys[kept], np.concatenate([[0], np.cumsum(need)])


def token_sets(keyed: DataFrame, width: int, similarity: float | None = None, sketch: int | None = SKETCH) -> DataFrame:
    """(id, key, sig, n, print, marks, tokens) of rows (id, key, text): sig stands for the set of n word shingles, print is its SimHash.

    marks: ``counted_marks``, by which many sets that aren't similar are told apart without a look at them.

    tokens: the set in order of hashes, or with a ``similarity`` the keys of neighbours in it (``neighbour_keys``), the first
    ``sketch`` of them (None: all). Whole sets come without print and marks.
    """
    kind = keyed.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            some, size, begin = [], 0, 0
            for k, text in enumerate(batch.column(2)):
                some.append((text.as_py() or "").encode())
                size += len(some[-1])
                if size >= TOGETHER or len(some) == MOST_TEXTS or k == batch.num_rows - 1:
                    sums, tokens, first = shingle_sets(some, width)
                    n = np.diff(first)
                    prints, marks = pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.binary())
                    if similarity is not None:
                        prints, marks = pa.array(majority_bits(tokens, first).view(np.int64)), counted_marks(tokens, first)
                        tokens, first = neighbour_keys(tokens, first, sketch)
                    lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(tokens.view(np.int64)))
                    own = batch.slice(begin, len(some))
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(sums.view(np.int64)), pa.array(n.astype(np.int32)), prints, marks, lists], ["id", "key", "sig", "n", "print", "marks", "tokens"])
                    some, size, begin = [], 0, k + 1

    return keyed.select("id", "key", "text").mapInArrow(run, f"id {kind}, key long, sig long, n int, print long, marks binary, tokens array<long>")


def maybe_similar(found: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets whose sizes and marks don't rule out that they are similar."""
    sigs = found.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    some = reps.where(Bitmap(sigs, "sig", bits_for(sigs), held=True).has(F.col("sig")))
    side = lambda c: some.select(F.col("sig").alias(c), F.col("n").alias(f"n_{c}"), F.col("marks").alias(f"marks_{c}"))

    def run(batches):
        for batch in batches:
            a, b, n, m, x, y = (batch.column(k) for k in range(6))
            most = (n.to_numpy() + m.to_numpy()) * ((1 - similarity) / (1 + similarity)) + 1e-9
            close = [least_apart(x[k].as_py(), y[k].as_py()) <= most[k] for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(close, pa.bool_()))

    both = found.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity - 1e-9)
    return both.select("a", "b", "n_a", "n_b", "marks_a", "marks_b").mapInArrow(run, "a long, b long")


def fingerprint_pairs(reps: DataFrame) -> DataFrame:
    """(a, b): sets whose fingerprints are linked by ``links``, directly or through others: each one with the smallest of them."""
    distinct = materialize(reps.groupBy("print").agg(F.min("sig").alias("node")).select("node", "print"), "distinct")
    parts = connected_components(links(distinct))
    heads = materialize(distinct.join(parts, "node", "left").select("print", F.coalesce("component", "node").alias("head")), "heads")
    drop_materialized(distinct)
    return reps.select("sig", "print").join(heads, "print").where("sig <> head").select(F.least("sig", "head").alias("a"), F.greatest("sig", "head").alias("b"))


def similar_documents(docs: DataFrame, similarity: float = 0.8, width: int = 5, sketch: int | None = SKETCH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, part, component): rows linked, directly or through others, by a Jaccard index of ``similarity`` or more.

    A row's tokens are its word shingles (``width`` words, A-Z lower-cased; fewer words: the whole
    sequence). Rows with equal sets are merged. SimHash comes first: fingerprints of the sets within two bits
    meet in their Golay keys (``links``), and each set is held against the first of its group. Similar sets whose
    fingerprints lie further apart, which are most of those near the bound, are sought among what is still in
    different groups: these meet in keys of two neighbours in a set's order of hashes (the first
    ``sketch`` at most; with 48, sets of up to 49 tokens at 0.8 or more meet for certain and larger ones up to a
    chance of 1e-14; None takes all, by which all meet for certain). Each key has a leader, the smallest
    sig: comparing all with the leaders comes before comparing all whose groups still differ, since others
    can't change the groups. Every link is verified on the whole sets. The component is the smallest id reachable, part a name of the
    group, key a hash of id and text. Null and empty texts are alike; null ids take part and have
    themselves no smaller id than others; repeated rows are kept; very long texts count whole; an empty
    table gives an empty one; other columns are ignored.
    """
    keyed = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[id_col], docs[text_col]).alias("key"), docs[text_col].cast("string").alias("text"))
    rows = materialize(token_sets(keyed, width, similarity, sketch), "prefixes")
    reps = materialize(rows.groupBy("sig").agg(F.min("id").alias("first"), F.min("key").alias("key"), *[F.min(c).alias(c) for c in ("n", "print", "marks")]), "reps")

    def pairs(x: DataFrame, y: DataFrame, differ) -> DataFrame:
        n, m = F.col("x.n"), F.col("y.n")
        rest = F.least("x.at", "y.at") + F.least(n - F.col("x.at"), m - F.col("y.at")) >= (n + m) * (similarity / (1 + similarity)) - 1e-9
        close = (F.least(n, m) >= F.greatest(n, m) * similarity - 1e-9) & rest
        both = x.alias("x").join(y.alias("y"), (F.col("x.token") == F.col("y.token")) & differ & close)
        return both.select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")).distinct()

    def verified(met: DataFrame) -> DataFrame:
        met = materialize(met, "candidates")
        if met.isEmpty():
            return met
        found = materialize(maybe_similar(met, reps, similarity), "pairs")
        needed = materialize(found.select(F.explode(F.array("a", "b")).alias("sig")).distinct().join(reps, "sig").select("sig", "key"), "needed")
        some = token_sets(keyed.where(Bitmap(needed, "key", bits_for(needed), held=True).has(F.col("key"))), width)
        sets = materialize(some.join(needed, ["sig", "key"]).select("sig", "tokens").dropDuplicates(["sig"]), "sets")
        side = lambda c: sets.select(F.col("sig").alias(c), F.col("tokens").alias(f"tokens_{c}"))
        common = F.size(F.array_intersect("tokens_a", "tokens_b"))
        union = F.size("tokens_a") + F.size("tokens_b") - common
        out = materialize(found.join(side("a"), "a").join(side("b"), "b").where(common >= union * similarity - 1e-9).select("a", "b"), "links")
        drop_materialized(met, found, needed, sets)
        return out

    def placed(links_so_far: DataFrame) -> DataFrame:
        """The postings of tokens that sets of different groups share."""
        groups = materialize(connected_components(links_so_far).withColumnRenamed("node", "sig"), "groups")
        every = postings.join(groups, "sig", "left").withColumn("group", F.coalesce("component", "sig"))
        mixed = every.groupBy("token").agg(F.min("group").alias("least"), F.max("group").alias("last")).where("least < last").select("token")
        out = materialize(every.join(mixed, "token").select("token", "sig", "leader", "group", "n", "at"), "mixed")
        drop_materialized(groups)
        return out

    near = verified(fingerprint_pairs(reps))
    index = rows.select("sig", "n", F.posexplode("tokens").alias("at", "token"))
    shared = materialize(index.groupBy("token").agg(F.min("sig").alias("leader"), F.max("sig").alias("last")).where("leader < last").select("token", "leader"), "shared")
    postings = materialize(index.join(shared, "token").select("token", "sig", "leader", "n", "at").distinct(), "met")
    first = placed(near)
    led = verified(pairs(first, first.where("sig = leader"), F.col("x.group") != F.col("y.group")))
    second = placed(near.unionAll(led))
    more = verified(pairs(second, second, F.col("x.group") < F.col("y.group")))

    parts = materialize(connected_components(near.unionAll(led).unionAll(more)).withColumnRenamed("node", "sig"), "parts")
    named = reps.join(parts, "sig", "left").select("sig", "first", F.coalesce("component", "sig").alias("part"))
    least = named.groupBy("part").agg(F.min("first").alias("component"))
    named = materialize(named.join(least, "part").select("sig", "part", "component"), "components")
    out = materialize(rows.join(named, "sig").select(F.col("id").alias(id_col), "key", "part", "component"), "groups")
    drop_materialized(rows, reps, shared, postings, near, first, led, second, more, parts, named)
    return out


def one_of_each_group(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of ``similar_documents``: the one with the smallest id (null last, then by hash); of repeated rows any one."""
    place = F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), "key")
    first = groups.groupBy("part").agg(F.min(place).alias("first"))
    told = groups.select("part", "key", place.alias("place")).join(first, "part").groupBy("key").agg(F.first(F.col("place") > F.col("first")).alias("gone"), F.count("*").alias("copies"))
    told = materialize(told.where("gone or copies > 1"), "told")
    # the document's own columns travel in a struct, so that none of their names can clash
    rows = docs.select(F.xxhash64(docs[id_col], docs[text_col]).alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    single = rows.join(told, "key", "left_anti").select("row")
    copied = rows.join(told.where("not gone"), "key", "left_semi").dropDuplicates(["key"]).select("row")
    return single.unionByName(copied).select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
