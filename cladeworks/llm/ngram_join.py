"""Operator 11: exact Jaccard join of word n-gram sets as a blocked sparse matrix product."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.bitmaps import Bitmap
from cladeworks.llm.common import drop_materialized, give_back_memory, materialize, read_table
from cladeworks.llm.components import connected_components
from cladeworks.llm.simhash import token_sets
from cladeworks.llm.textkernels import U, shingle_sets

#: Words of an n-gram; two documents link at this percentage of shared n-grams, or more.
WIDTH, PERCENT = 5, 80
#: Bytes of text whose n-grams are hashed together, and the most texts.
TOGETHER, MOST_TEXTS = 1 << 20, 4096
#: N-grams fall into buckets whose counts give the order of the matrix's columns: one for about LOAD n-grams, within 2^LEAST and 2^MOST.
LOAD, LEAST, MOST = 64, 16, 24
#: Buckets that travel in a row, the most tasks that count, and n-grams that are counted at once.
SLOT, COUNTERS, AT_ONCE = 4096, 4096, 1 << 22
#: Bits for each n-gram in the parities by which rows are compared before they are read whole, and the most of them.
PARITY, MOST_PARITY = 4, 1 << 16
#: The most partners of a row that are multiplied with it in one block.
BLOCK = 256
#: Up to so many keys a bitmap of at most four bits a key picks the texts that are hashed again; beyond, a join does.
MOST_KEYS = 1 << 20


def chunks(batch: pa.RecordBatch, column: int):
    """(first row, texts as bytes) of pieces of a batch."""
    some, size, begin = [], 0, 0
    for k, text in enumerate(batch.column(column)):
        some.append((text.as_py() or "").encode())
        size += len(some[-1])
        if size >= TOGETHER or len(some) == MOST_TEXTS or k == batch.num_rows - 1:
            yield begin, some
            some, size, begin = [], 0, k + 1


def rarity_classes(docs: DataFrame, width: int) -> np.ndarray:
    """For each bucket of n-gram hashes eight times the logarithm of its count, over all rows (a column ``text``).

    Tasks count up to 255 into a byte a bucket, and sums of those reach the driver as a byte each, 16 MB at most; how many there are
    follows from the size of the texts. Any classes give right results; these put what many documents share last.
    """
    letters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(MOST, max(LEAST, (letters // (6 * LOAD)).bit_length()))
    slot = min(SLOT, 1 << bits)

    def count(batches):
        held, waiting, n = np.zeros(1 << bits, np.uint8), [], 0

        def counted():
            return np.minimum(held + np.bincount(np.concatenate(waiting), minlength=len(held)), 255).astype(np.uint8)

        for batch in batches:
            for _, texts in chunks(batch, 0):
                _, tokens, _ = shingle_sets(texts, width)
                waiting.append((tokens & U(len(held) - 1)).astype(np.int32))
                n += len(tokens)
                if n >= AT_ONCE:
                    held, waiting, n = counted(), [], 0
        held = counted() if waiting else held
        rows = held.reshape(-1, slot)
        full = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([rows[k].tobytes() for k in full], pa.binary())], ["slot", "counts"])
        give_back_memory()

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.uint8).astype(np.int64) for x in table["counts"])
        classes = np.minimum(255, 8 * np.log2(total + 1)).astype(np.uint8)
        return pa.table({"slot": table["slot"][:1], "classes": pa.array([classes.tobytes()])})

    sums = docs.select("text").coalesce(COUNTERS).mapInArrow(count, "slot int, counts binary").groupBy("slot").applyInArrow(add, "slot int, classes binary")
    out = np.zeros(1 << bits, np.uint8)
    for r in sums.collect():
        out[r.slot * slot : (r.slot + 1) * slot] = np.frombuffer(r.classes, np.uint8)
    return out


def parities(tokens: np.ndarray) -> bytes:
    """Bits that tell how many tokens fall on each, odd or even; as many as the set is large, so that folded ones of two sets can be compared."""
    bits = min(MOST_PARITY, 1 << max(6, (PARITY * len(tokens) - 1).bit_length()))
    return np.packbits((np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def apart_at_least(x: bytes, y: bytes) -> int:
    """How many tokens are in only one of two sets, at least: where folded parities differ, one is."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) > len(b):
        a, b = b, a
    return int(np.bitwise_count(np.bitwise_xor.reduce(b.reshape(-1, len(a))) ^ a).sum())


def least_overlap(total, percent: int):
    """The overlap that sets of ``total`` n-grams together need: overlap / (total - overlap) >= percent / 100."""
    return -(-percent * total // (100 + percent))


def prefixes(keyed: DataFrame, classes: np.ndarray, width: int, percent: int) -> DataFrame:
    """(id, key, sig, n, marks, heads) of rows (id, key, text): a row of the matrix with its parities and so many of its rarest columns that two linked rows share one."""
    kind = keyed.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for begin, texts in chunks(batch, 2):
                sums, tokens, first = shingle_sets(texts, width)
                n = np.diff(first)
                text_of = np.repeat(np.arange(len(n)), n)
                marks = [parities(tokens[a:b]) for a, b in zip(first, first[1:], strict=False)]
                # tokens come in order of hashes; a stable sort by class keeps that within a class
                order = np.argsort(text_of * 256 + classes[(tokens & U(len(classes) - 1)).astype(np.int64)], kind="stable")
                tokens = tokens[order]
                need = np.where(n > 0, n + (-percent * n) // 100 + 1, 0)
                tokens = tokens[np.arange(len(tokens)) - np.repeat(first[:-1], n) < np.repeat(need, n)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(need)]).astype(np.int32)), pa.array(tokens.view(np.int64)))
                own = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(sums.view(np.int64)), pa.array(n.astype(np.int32)), pa.array(marks, pa.binary()), lists], ["id", "key", "sig", "n", "marks", "heads"])
        give_back_memory()

    return keyed.select("id", "key", "text").mapInArrow(run, f"id {kind}, key long, sig long, n int, marks binary, heads array<long>")


def shared_columns(rows: DataFrame) -> DataFrame:
    """(token, sig, n, at, lead, lead_n, lead_at): the entries of columns that hold two rows or more, each with its column's leader.

    The leader is the row with the fewest rarer columns of its own, so that it is the one nearest to the others. Columns are read
    in sorted blocks, one entry after another.
    """

    def run(batches):
        held = None  # the first entry of the column that is open, and whether it was told
        for batch in batches:
            if not batch.num_rows:
                continue
            token, sig, n, at = (batch.column(k).to_numpy() for k in range(4))
            if held is not None and held[0][0] == token[0]:
                if not held[1]:
                    token, sig, n, at = (np.concatenate([[x], y]) for x, y in zip(held[0], (token, sig, n, at), strict=True))
                leader = held[0]
            else:
                leader = None
            new = np.concatenate([[True], token[1:] != token[:-1]])
            begin = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1
            size = np.diff([*begin, len(token)])
            lead = [x[begin][run_of] for x in (sig, n, at)]
            told = size > 1
            if leader is not None:
                for x, value in zip(lead, leader[1:], strict=True):
                    x[run_of == 0] = value
                told[0] = True
            held = ((token[-1], lead[0][-1], lead[1][-1], lead[2][-1]), bool(told[-1]))
            keep = told[run_of]
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, sig, n, at, *lead)], ["token", "sig", "n", "at", "lead", "lead_n", "lead_at"])

    entries = rows.select(F.posexplode("heads").alias("at", "token"), "sig", "n").select("token", "sig", "n", "at")
    block = entries.repartition("token").sortWithinPartitions("token", "at", "n", "sig")
    return block.mapInArrow(run, "token long, sig long, n int, at int, lead long, lead_n int, lead_at int")


def possible(n: Column, at: Column, m: Column, to: Column, percent: int) -> Column:
    """Whether rows of n and m entries can link, if their first shared entries are at these places."""
    return F.least(n - at, m - to) * (100 + percent) >= (n + m) * percent


def overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): of pairs (hub, other) those whose rows (sig, n, tokens) overlap enough.

    A block is a hub's row times the rows of up to BLOCK partners: sorted entries looked up at once, counts summed by row. Blocks are
    dealt out over all tasks, a hub with many partners too, and stream through them.
    """

    def run(batches):
        hub, size = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds, others, sizes = (batch.column(k).to_numpy() for k in (2, 3, 4))
            lists = batch.column(5)
            flat, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            heads = np.flatnonzero(kinds == 0)
            bounds = [*([0] if not len(heads) or heads[0] else []), *heads, len(kinds)]
            a, b = [], []
            names = batch.column(0).to_numpy()
            for begin, stop in zip(bounds, bounds[1:], strict=False):
                if kinds[begin] == 0:
                    hub, size = flat[ends[begin] : ends[begin + 1]].copy(), int(sizes[begin])
                    begin += 1
                if begin == stop:
                    continue
                values = flat[ends[begin] : ends[stop]]
                hit = hub[np.minimum(np.searchsorted(hub, values), len(hub) - 1)] == values
                sums = np.concatenate([[0], np.cumsum(hit)])
                common = np.diff(sums[ends[begin : stop + 1] - ends[begin]])
                good = common >= least_overlap(sizes[begin:stop].astype(np.int64) + size, percent)
                a.append(names[begin:stop][good])
                b.append(others[begin:stop][good])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    hubs = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = sets.select(F.col("sig").alias("other"), F.col("n"), F.array_sort("tokens").alias("tokens"))
    partners = pairs.join(hubs, "hub").join(rows, "other").select("hub", F.pmod(F.xxhash64("other"), "blocks").cast("int").alias("block"), F.lit(1).alias("kind"), "other", "n", "tokens")
    own = hubs.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(rows, F.col("hub") == F.col("other"))
    both = partners.unionAll(own.select("hub", "block", F.lit(0).alias("kind"), "other", "n", "tokens"))
    return both.repartition("hub", "block").sortWithinPartitions("hub", "block", "kind").mapInArrow(run, "a long, b long")


def whole_rows(keyed: DataFrame, pairs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(sig, n, tokens): the whole rows of those in ``pairs``, hashed again from one text each; texts that aren't needed stay unread by the hashing."""
    named = pairs.select(F.explode(F.array("hub", "other")).alias("sig")).distinct()
    needed = materialize(named.join(rows, "sig").select("sig", "key"), "needed")
    count = needed.count()
    if count <= MOST_KEYS:
        some = keyed.where(Bitmap(needed, "key", max(10, (4 * count).bit_length())).has(F.col("key")))
    else:
        some = keyed.join(needed.select("key").distinct(), "key", "left_semi")
    sets = token_sets(some, width).join(needed, ["sig", "key"]).select("sig", "n", "tokens").dropDuplicates(["sig"])
    sets = materialize(sets, "sets")
    drop_materialized(needed)
    return sets


def unlike_dropped(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (hub, other) whose parities allow a link."""

    def run(batches):
        for batch in batches:
            n, m, x, y = (batch.column(k) for k in range(2, 6))
            total = (n.to_numpy().astype(np.int64) + m.to_numpy()) * (100 - percent) // (100 + percent)
            keep = np.array([apart_at_least(a.as_py(), b.as_py()) for a, b in zip(x, y, strict=True)], np.int64) <= total
            yield batch.select([0, 1]).filter(pa.array(keep))

    side = lambda c: rows.select(F.col("sig").alias(c), F.col("n").alias(f"n_{c}"), F.col("marks").alias(f"marks_{c}"))
    both = pairs.join(side("hub"), "hub").join(side("other"), "other")
    return both.select("hub", "other", "n_hub", "n_other", "marks_hub", "marks_other").mapInArrow(run, "hub long, other long")


def linked(keyed: DataFrame, pairs: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): those of the pairs (hub, other) that link."""
    pairs = materialize(unlike_dropped(pairs, rows, percent), "pairs")
    sets = whole_rows(keyed, pairs, rows, width)
    out = materialize(overlaps(pairs, sets, percent), "links")
    drop_materialized(pairs, sets)
    return out


def pairs_with_leaders(shared: DataFrame, percent: int) -> DataFrame:
    """(hub, other): rows with the leader of a column that both are in, where sizes and places allow a link."""
    can = possible(F.col("n"), F.col("at"), F.col("lead_n"), F.col("lead_at"), percent)
    return shared.where((F.col("sig") != F.col("lead")) & can).select(F.col("lead").alias("hub"), F.col("sig").alias("other")).distinct()


def pairs_across(placed: DataFrame, percent: int) -> DataFrame:
    """(hub, other): rows of different groups in a column, where sizes and places allow a link.

    Of two linked rows the smaller one has the shared column among the first that it would share with a row of its own
    size (``early``). Columns whose early entries are all of one group are read for the entries of other groups only, and an
    entry must be able to link with the smallest early row there.
    """
    early = placed.where((F.col("n") - F.col("at")) * (100 + percent) >= F.col("n") * (2 * percent))
    about = early.groupBy("token").agg(F.min("group").alias("least"), F.max("group").alias("most"), F.min("n").alias("small"), F.max(F.col("n") - F.col("at")).alias("rest"))
    outside = (F.col("least") != F.col("most")) | (F.col("group") != F.col("least"))
    near = (F.least(F.col("n") - F.col("at"), F.col("rest")) * (100 + percent) >= (F.col("n") + F.col("small")) * percent) & (F.col("small") <= F.col("n"))
    x = placed.join(about, "token").where(outside & near).select(placed.columns).alias("x")
    y = early.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    smaller = (m < n) | ((m == n) & (F.col("y.sig") < F.col("x.sig")))
    fresh = (F.col("x.sig") != F.col("x.lead")) & (F.col("y.sig") != F.col("y.lead"))
    can = (F.col("x.group") != F.col("y.group")) & smaller & fresh & possible(n, F.col("x.at"), m, F.col("y.at"), percent)
    both = x.join(y, (F.col("x.token") == F.col("y.token")) & can)
    return both.select(F.col("y.sig").alias("hub"), F.col("x.sig").alias("other")).distinct()


def ngram_links(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, component): rows whose sets of word n-grams overlap by ``percent`` or more of their union, directly or through others.

    The incidence matrix has a row for each distinct set and a column for each n-gram hash. Blocks of columns, rarest first and only as
    many of each row as its size demands, give the pairs that can link; sizes, places and parities of the rows' columns discard most. Those left are
    multiplied in blocks of rows, over all columns, and their overlap is compared with the bound of their sizes. Pairs with the leader of
    each column come first; what is then in one group isn't compared again, since that can't change the groups, so copies never meet
    pair by pair. Links between different groups are all found.

    A-Z are lower-cased, words are runs without ASCII white space. Fewer words than ``width``: the whole sequence is the one n-gram. No
    words, or a null text: an empty set, linked with nothing, n 0. Equal sets are linked; repeated rows are kept; a null id takes part and
    has itself no smaller id than others; the component is the smallest id reachable; very long texts count whole; an empty
    table gives an empty one; other columns are ignored.
    """
    keyed = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[id_col], docs[text_col]).alias("key"), docs[text_col].cast("string").alias("text"))
    classes = rarity_classes(keyed, width)
    every = materialize(prefixes(keyed, classes, width, percent), "prefixes")
    rows = materialize(every.where("n > 0").groupBy("sig").agg(F.min("id").alias("first"), F.min("key").alias("key"), F.min("n").alias("n"), F.first("marks").alias("marks"), F.first("heads").alias("heads")), "rows")
    shared = materialize(shared_columns(rows), "shared")


    led = linked(keyed, pairs_with_leaders(shared, percent), rows, width, percent)
    groups = connected_components(led).select(F.col("node").alias("sig"), F.col("component").alias("group"))
    groups = materialize(groups, "groups")
    placed = shared.join(groups, "sig", "left").select("token", "sig", "n", "at", "lead", F.coalesce("group", "sig").alias("group"))
    mixed = placed.groupBy("token").agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a < b").select("token")
    placed = materialize(placed.join(mixed, "token"), "mixed")
    more = linked(keyed, pairs_across(placed, percent), rows, width, percent)

    # links across groups join whole groups
    of = lambda c: groups.select(F.col("sig").alias(c), F.col("group").alias(f"group_{c}"))
    across = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("group_a", "a").alias("a"), F.coalesce("group_b", "b").alias("b"))
    parts = materialize(connected_components(across).select(F.col("node").alias("group"), F.col("component").alias("part")), "parts")
    whole = rows.select("sig", "first").join(groups, "sig", "left").select("sig", "first", F.coalesce("group", "sig").alias("group"))
    named = whole.join(parts, "group", "left").select("sig", "first", F.coalesce("part", "group").alias("part"))
    least = named.groupBy("part").agg(F.min("first").alias("component"))
    named = materialize(named.join(least, "part").select("sig", "component"), "components")
    full = every.where("n > 0").select("id", "sig", "n").join(named, "sig").select("id", "n", "component")
    empty = every.where("n = 0").select("id", "n", F.col("id").alias("component"))
    out = materialize(full.unionAll(empty), "members")
    drop_materialized(every, rows, shared, led, groups, placed, more, parts, named)
    return out.select(F.col("id").alias(id_col), "n", "component")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_links(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))
