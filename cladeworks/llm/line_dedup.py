"""Operator 7: line deduplication by an exact set-similarity join, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.bitmaps import MOST_BITS, Bitmap, bits_for, bucket_classes, held_array
from cladeworks.llm.common import drop_materialized, free_shuffles, materialize, read_table
from cladeworks.llm.components import connected_components

RARITY_BITS = 18
#: Bits of a token that are of the word's hash; those above are its class of rarity.
HASH_BITS = 56
#: From so many lines on that share a key, their most copied one becomes a centre of near copies.
CROWD = 16
#: Fewer near copies than these around a centre are joined like all others.
LEAST_STAR = 8
SMALLEST = -(1 << 63)
PLACE = ["first_id", "first_tie", "first_line"]
EPSILON = 1e-9
#: So many common tokens two lines must have in their prefixes, which are longer by one token less than that; lines of
#: fewer than SHORT tokens ask for one, so that a word that many of them share isn't among those they meet in.
HITS, SHORT = 2, 5


def places(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """id (null: the smallest) and tie (a hash of the text, for rows that share an id)."""
    return [F.coalesce(docs[id_col].cast("long"), F.lit(SMALLEST)).alias("id"), F.xxhash64(docs[text_col]).alias("tie")]


def lines_of(docs: DataFrame) -> DataFrame:
    """(id, tie, line, sig, text): lines that hold a word, lower-cased; ``sig`` is a hash of the line."""
    lines = docs.select("id", "tie", F.posexplode(F.split(F.lower("text"), "\n")).alias("line", "text"))
    return lines.where(F.trim("text", F.lit(" \t\n\x0b\x0c\r")) != "").select("id", "tie", "line", F.xxhash64("text").alias("sig"), "text")


def hits_of(n: Column) -> Column:
    """The common tokens that a line of n tokens asks for."""
    return F.when(n < SHORT, 1).otherwise(HITS)


def words() -> Column:
    """Between single spaces: splitting at one character is much faster than at a pattern, and few lines hold other white space. Some may be empty."""
    odd = reduce(Column.__or__, [F.contains("text", F.lit(c)) for c in "\t\n\x0b\x0c\r"])
    return F.split(F.when(odd, F.regexp_replace("text", r"[\x09-\x0D]", " ")).otherwise(F.col("text")), " ")


def word_hashes() -> Column:
    """The set of a line's words, as hashes."""
    return F.array_remove(F.array_distinct(F.transform(words(), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def rarity_classes(docs: DataFrame) -> Column:
    """For each of 2^18 buckets of word hashes, the logarithm of how many words of all documents fall into it.

    The size is fixed, whatever the data; any order that all lines share gives exact results.
    """
    every = docs.select(F.replace(F.lower("text"), F.lit("\n"), F.lit(" ")).alias("text")).select(F.explode(words()).alias("word")).select(F.xxhash64("word").alias("h"))
    return held_array(docs.sparkSession, bucket_classes(every, "h", RARITY_BITS), "tinyint")


def distinct_lines(base: DataFrame, classes: Column, threshold: float) -> DataFrame:
    """(sig, first place, copies, n, mark, prefix): each different line, its n tokens, and the rarest of them.

    A token is a word's hash below the class of its rarity, so that plain sorting orders tokens by
    rarity. The mark holds 64 bits, each the parity of the tokens that fall on it.
    """
    low = F.lit((1 << HASH_BITS) - 1)
    class_of = lambda h: F.get("classes", h.bitwiseAND(F.lit((1 << RARITY_BITS) - 1)).cast("int"))
    # never null, so that the tokens are sorted as plain numbers
    token = lambda h: F.shiftleft(F.coalesce(class_of(h), F.lit(0).cast("byte")).cast("long"), HASH_BITS).bitwiseOR(h.bitwiseAND(low))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    # exploding a one-element array is a border over which no expression is copied, so that the words are split only once
    lines = lines_of(base).select("id", "tie", "line", "sig", F.explode(F.array(word_hashes())).alias("hashes")).select("*", classes.alias("classes"))
    n = F.size("hashes")
    need = n - F.ceil(n * threshold - EPSILON).cast("int") + hits_of(n)
    mark = F.aggregate("hashes", F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(bit(h)))
    kept = lines.select("id", "tie", "line", "sig", n.alias("n"), mark.alias("mark"), F.slice(F.sort_array(F.transform("hashes", token)), F.lit(1), need).alias("prefix"))
    same = kept.groupBy("sig").agg(F.min(F.struct("id", "tie", "line")).alias("first"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "mark", "prefix")])
    return same.select("sig", F.col("first.id").alias("first_id"), F.col("first.tie").alias("first_tie"), F.col("first.line").alias("first_line"), "copies", "n", "mark", "prefix")


def postings(firsts: DataFrame, *more: str) -> DataFrame:
    return firsts.select("sig", "n", "mark", *more, F.posexplode("prefix").alias("at", "token"))


def filters(threshold: float) -> Column:
    """Whether postings x and y of one token may be of similar lines, and the token one of the first that they share, as many as the smaller set asks for.

    Length; prefix (of two similar sets the smaller one has these tokens within the shorter prefix that
    fits two sets of its size); position (what is left from this token on, and those before it, must
    suffice); and marks: where they differ, at least one token is in only one of the sets.
    """
    n, m = F.col("x.n"), F.col("y.n")
    length = F.least(n, m) >= F.greatest(n, m) * threshold - EPSILON
    before = hits_of(F.least(n, m)) - 1 + F.lit(EPSILON)
    within = lambda t: F.col(f"{t}.at") <= F.col(f"{t}.n") * (1 - 2 * threshold / (1 + threshold)) + before
    position = F.least(n - F.col("x.at"), m - F.col("y.at")) >= (n + m) * (threshold / (1 + threshold)) - before
    apart = F.bit_count(F.col("x.mark").bitwiseXOR(F.col("y.mark")))
    marks = apart <= (n + m) * ((1 - threshold) / (1 + threshold)) + EPSILON
    return marks & length & position & F.when(n < m, within("x")).when(n > m, within("y")).otherwise(within("x") | within("y"))


def candidates(met: DataFrame) -> DataFrame:
    """(x, y) of the rows (x, y, least), one for each common token: pairs with as many of them as the smaller set asks for, or has."""
    return met.groupBy("x", "y").agg(F.count("*").alias("hits"), F.min("least").alias("least")).where(F.col("hits") >= F.least("least", hits_of(F.col("least")))).select("x", "y")


class Verifier:
    """Reads the token sets of candidate pairs again, from the documents, and measures them."""

    def __init__(self, base: DataFrame, firsts: DataFrame, threshold: float):
        self.base, self.firsts, self.threshold = base, firsts, threshold

    def similar(self, pairs: DataFrame, name: str, with_edits: bool = False) -> DataFrame:
        """(x, y, edits): those of the pairs (x, y) whose whole sets are similar, and the tokens that are in only one (those of y alone with all bits turned)."""
        needed = materialize(pairs.select(F.explode(F.array("x", "y")).alias("sig")).distinct().join(self.firsts.select("sig", *PLACE), "sig"), "needed")
        bits = bits_for(needed)
        in_doc, wanted = Bitmap(needed, "first_tie", bits, held=True), Bitmap(needed, "sig", bits, held=True)
        some = lines_of(self.base.where(in_doc.has(F.col("tie")))).where(wanted.has(F.col("sig")))
        same = (F.col("l.sig") == F.col("f.sig")) & (F.col("l.id") == F.col("f.first_id")) & (F.col("l.tie") == F.col("f.first_tie")) & (F.col("l.line") == F.col("f.first_line"))
        sets = some.alias("l").join(needed.alias("f"), same).select("l.sig", F.col("l.text").alias("text")).dropDuplicates(["sig"])
        sets = materialize(sets.select("sig", word_hashes().alias("set")), "sets")
        both = pairs.join(sets.select(F.col("sig").alias("x"), F.col("set").alias("set_x")), "x").join(sets.select(F.col("sig").alias("y"), F.col("set").alias("set_y")), "y")
        # the border again, for the costly intersection
        counted = both.select("x", "y", F.size("set_x").alias("n"), F.size("set_y").alias("m"), F.explode(F.array(F.size(F.array_intersect("set_x", "set_y")))).alias("common"), "set_x", "set_y")
        out = counted.where(F.col("common") >= (F.col("n") + F.col("m") - F.col("common")) * self.threshold - EPSILON)
        edits = F.concat(F.array_except("set_x", "set_y"), F.transform(F.array_except("set_y", "set_x"), F.bitwise_not))
        out = materialize(out.select("x", "y", *[edits.alias("edits")] * with_edits), name)
        drop_materialized(needed, sets)
        return out


def token_bits(lines: DataFrame) -> int:
    """Bits of a bitmap for the prefixes of a written table's lines: eight times as many as for the lines."""
    return min(MOST_BITS, bits_for(lines) + 3)


def stars(firsts: DataFrame, verifier: Verifier, threshold: float) -> DataFrame:
    """(sig, star, slack, edits): lines that are similar to a centre, the one of several that has the most copies.

    Tokens in only one of x and y number at most those in only one of x and the centre and of y and
    the centre. So lines of one star whose slacks sum to zero or more are similar without a look; slack
    is the share of a line's size that may differ, less what differs from the centre (edits). Centres are sought
    where many lines share the two least hashes of their prefixes; every line that is similar to one is found.
    """
    key = F.xxhash64(F.slice(F.sort_array(F.transform("prefix", lambda t: t.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))), 1, 2))
    crowds = firsts.groupBy(key.alias("key")).agg(F.count("*").alias("lines"), F.max(F.struct("copies", "sig")).alias("most"))
    chosen = materialize(crowds.where(F.col("lines") >= CROWD).select(F.col("most.sig").alias("sig")).distinct(), "chosen")
    centres = materialize(firsts.where(Bitmap(chosen, "sig", bits_for(chosen), held=True).has(F.col("sig"))).join(chosen, "sig", "left_semi"), "centres")
    held = postings(centres, "copies")
    near = postings(firsts).where(Bitmap(held, "token", token_bits(centres), held=True).has(F.col("token"))).alias("x").join(held.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.sig") != F.col("y.sig")) & filters(threshold))
    pairs = materialize(candidates(near.select(F.col("x.sig").alias("x"), F.col("y.sig").alias("y"), F.least("x.n", "y.n").alias("least"))), "pairs")
    found = verifier.similar(pairs, "near", with_edits=True).unionByName(centres.select(F.col("sig").alias("x"), F.col("sig").alias("y"), F.array().cast("array<long>").alias("edits")))
    found = found.join(centres.select(F.col("sig").alias("y"), "copies"), "y")
    best = found.groupBy("x").agg(F.max(F.struct("copies", F.col("y").alias("star"), "edits")).alias("best")).select(F.col("x").alias("sig"), "best.star", "best.edits")
    best = materialize(best, "nearest")
    sizes = best.groupBy("star").agg(F.count("*").alias("size")).where(F.col("size") >= LEAST_STAR)
    slack = F.round(F.col("n") * ((1 - threshold) / (1 + threshold)) - F.size("edits"), 6).alias("slack")
    out = materialize(best.join(sizes, "star", "left_semi").join(firsts.select("sig", "n"), "sig").select("sig", "star", slack, "edits"), "stars")
    drop_materialized(pairs, best, centres, chosen)
    return out


def implied_links(placed: DataFrame) -> DataFrame:
    """(sig, n_links, earliest) within stars: how many lines make up for a line's slack, and the first of them.

    ``placed`` has (sig, star, slack, place). Lines are counted by star and slack first, so no pair of lines is made.
    """
    groups = placed.groupBy("star", "slack").agg(F.count("*").alias("lines"), F.min("place").alias("earliest"))
    x, y = groups.alias("x"), groups.alias("y")
    enough = x.join(y, (F.col("x.star") == F.col("y.star")) & (F.col("x.slack") + F.col("y.slack") >= -EPSILON))
    reached = enough.groupBy("x.star", "x.slack").agg(F.sum("y.lines").alias("lines"), F.min("y.earliest").alias("earliest"))
    own = (2 * F.col("slack") >= -EPSILON).cast("long")
    return placed.join(reached, ["star", "slack"]).select("sig", (F.col("lines") - own).alias("n_links"), "earliest")


def compared_links(near: DataFrame) -> DataFrame:
    """(x, y): links within stars whose slacks sum to less than zero.

    Each edit that two lines of a star share, be it a word that both lack or one that both have beside the centre's,
    brings them nearer by two. So they are similar if those make up for the sum, and need not meet in what all lines of the star have.
    """
    each = near.select("sig", "star", "slack", F.explode("edits").alias("edit"))
    x, y = each.where("slack < 0").alias("x"), each.alias("y")
    once = (F.col("y.slack") >= 0) | (F.col("x.sig") < F.col("y.sig"))
    lack = F.col("x.slack") + F.col("y.slack")
    both = x.join(y, (F.col("x.star") == F.col("y.star")) & (F.col("x.edit") == F.col("y.edit")) & (F.col("x.sig") != F.col("y.sig")) & once & (lack < -EPSILON))
    met = both.groupBy(F.col("x.sig").alias("x"), F.col("y.sig").alias("y")).agg(F.count("*").alias("shared"), F.min(lack).alias("lack"))
    return met.where(F.col("lack") + 2 * F.col("shared") >= -1e-5).select("x", "y")


def line_join(docs: DataFrame, threshold: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(removed, members, edges): ``repeated_lines``; (id, tie, line, sig, gone, n_links) of all lines that occur again or are linked; and links (a, b) of sigs that connect what all links connect."""
    base = docs.select(*places(docs, id_col, text_col), docs[text_col].cast("string").alias("text"))
    firsts = materialize(distinct_lines(base, rarity_classes(base), threshold), "firsts")
    free_shuffles(docs.sparkSession)
    verifier = Verifier(base, firsts, threshold)
    near = stars(firsts, verifier, threshold)
    free_shuffles(docs.sparkSession)

    # only lines that may be in a star are joined with the stars
    some = Bitmap(near, "sig", bits_for(near), held=True).has(F.col("sig"))
    alone = firsts.where(~some).select("*", F.lit(None).cast("long").alias("star"), F.lit(None).cast("double").alias("slack"))
    every = postings(alone.unionByName(firsts.where(some).join(near.drop("edits"), "sig", "left")), "star", "slack")
    inner = F.coalesce(F.col("slack") >= 0, F.lit(False))
    outer, core = every.where(~inner), every.where(inner)
    mixed = core.groupBy("token").agg(F.min("star").alias("least"), F.max("star").alias("last")).where("least < last").select("token")
    apart = F.col("x.star").isNull() | F.col("y.star").isNull() | (F.col("x.star") != F.col("y.star"))

    def met(x: DataFrame, y: DataFrame, differ: Column) -> DataFrame:
        both = x.alias("x").join(y.alias("y"), (F.col("x.token") == F.col("y.token")) & differ & filters(threshold))
        return both.select(F.least("x.sig", "y.sig").alias("x"), F.greatest("x.sig", "y.sig").alias("y"), F.least("x.n", "y.n").alias("least"))

    cores = core.join(mixed, "token", "left_semi")
    some = outer.where(Bitmap(core, "token", token_bits(near), held=True).has(F.col("token")))  # of most lines outside, no token is in a core
    parts = [met(outer, outer, (F.col("x.sig") < F.col("y.sig")) & apart), met(some, core, apart), met(cores, cores, F.col("x.star") < F.col("y.star"))]
    pairs = materialize(candidates(reduce(DataFrame.unionByName, parts)), "pairs")
    free_shuffles(docs.sparkSession)
    links = verifier.similar(pairs, "links")
    within = materialize(compared_links(near), "within")

    place = F.struct(*[F.col(c).alias(k) for c, k in zip(PLACE, ("id", "tie", "line"), strict=True)])
    links = links.unionAll(within)
    both = links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    told = both.join(firsts.select(F.col("sig").alias("y"), place.alias("earliest")), "y").groupBy(F.col("x").alias("sig")).agg(F.count("*").alias("n_links"), F.min("earliest").alias("earliest"))
    implied = implied_links(near.drop("edits").join(firsts.select("sig", place.alias("place")), "sig"))
    linked = materialize(told.unionByName(implied).groupBy("sig").agg(F.sum("n_links").alias("n_links"), F.min("earliest").alias("earliest")), "linked")

    later = F.coalesce(F.col("earliest") < place, F.lit(False))
    marked = firsts.select("sig", *PLACE, "copies").join(linked, "sig", "left").where("n_links is not null or copies > 1")
    marked = materialize(marked.select("sig", place.alias("place"), later.alias("later"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "marked")
    again = F.col("later") | (F.struct("id", "tie", "line") > F.col("place"))
    some = lines_of(base).select("id", "tie", "line", "sig").where(Bitmap(marked, "sig", bits_for(marked), held=True).has(F.col("sig")))
    members = materialize(some.join(marked, "sig").select("id", "tie", "line", "sig", again.alias("gone"), "n_links"), "members")
    out = members.where("gone").select(F.when(F.col("id") != SMALLEST, F.col("id")).alias(id_col), "tie", "line")
    edges = links.select(F.col("x").alias("a"), F.col("y").alias("b")).unionAll(near.select(F.col("star").alias("a"), F.col("sig").alias("b")))
    drop_materialized(pairs, marked, linked, firsts)
    free_shuffles(docs.sparkSession)
    return out, members, edges


def repeated_lines(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tie, line): lines for which an earlier line is similar; earlier is by id, tie, then line number.

    A line's tokens are the set of its words (lower-cased, between white space, by their 64-bit hashes).
    Similar: a Jaccard index of ``threshold`` or more, so a line of fewer than five words is similar to
    those of the same words. It does not matter whether the earlier line is itself removed. Lines
    without a word always stay.
    Equal lines are merged first and stand for each other. The others meet in their rarest tokens
    (``filters``), and all that pass are verified on their whole sets. Groups of near copies are held as
    stars around a centre (``stars``), so that they cost in proportion to their size.
    Null ids take the smallest place; tie is a hash of the text, for rows that share an id; repeated rows
    share a place and are judged alike. Null and empty texts have no lines; very long lines and texts of
    many lines are treated like others; an empty table gives an empty one; other columns are ignored.
    """
    return line_join(docs, threshold, id_col, text_col)[0]


def document_classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_removed, lines, class_id, n_links), one row for every different pair of id and text.

    lines are those of ``repeated_lines``, n_removed their number. n_links counts the links of the
    document's lines: for each different line of it, the other different lines of all documents that are
    similar to it. class_id is the smallest id reachable over equal and similar lines (the id itself where
    there are none). Repeated rows are one document, and rows that share an id one node of the classes;
    the null id is smallest and gives a null class_id.
    """
    removed, members, edges = line_join(docs, threshold, id_col, text_col)
    ids = docs.select(*places(docs, id_col, text_col)).distinct()
    gone = removed.groupBy(F.coalesce(id_col, F.lit(SMALLEST)).alias("id"), "tie").agg(F.array_sort(F.collect_set("line")).alias("lines"))
    held = materialize(members.select("id", "tie", "sig", "n_links").distinct(), "held")

    # lines that occur once and are linked with none neither count nor connect
    n_links = held.where("n_links > 0").groupBy("id", "tie").agg(F.sum("n_links").alias("n_links"))
    alike = connected_components(edges).withColumnRenamed("node", "sig")
    placed = materialize(held.join(alike, "sig", "left").select("id", F.coalesce("component", "sig").alias("lines")).distinct(), "placed")
    least = placed.groupBy("lines").agg(F.min("id").alias("b"), F.max("id").alias("last")).where("b < last").drop("last")
    parts = connected_components(placed.join(least, "lines").select(F.col("id").alias("a"), "b")).withColumnRenamed("node", "id")

    out = ids.join(gone, ["id", "tie"], "left").join(n_links, ["id", "tie"], "left").join(parts, "id", "left")
    known = lambda c: F.when(c != SMALLEST, c)
    lines = F.coalesce("lines", F.array().cast("array<int>"))
    return out.select(known(F.col("id")).alias(id_col), F.size(lines).cast("long").alias("n_removed"), lines.alias("lines"), known(F.coalesce("component", "id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_repeated_lines(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines in ``removed``; a document whose every line is removed goes with them."""
    by_doc = removed.groupBy(F.coalesce(id_col, F.lit(SMALLEST)).alias("id"), "tie").agg(F.collect_set("line").alias("lines"))
    # the document's other columns travel in a struct, so that none of their names can clash
    rows = docs.select(*places(docs, id_col, text_col), F.struct(F.lit(0), *[docs[c] for c in docs.columns if c != text_col]).alias("row"), docs[text_col].alias("text"))
    joined = rows.join(by_doc, ["id", "tie"], "left")
    kept = F.filter(F.split("text", "\n"), lambda line, k: ~F.array_contains("lines", k))
    changed = joined.select("row", "text", F.when(F.col("lines").isNotNull(), kept).alias("kept")).where("kept is null or size(kept) > 0")
    text = F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("text"))
    return changed.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_removed, the numbers of the lines to remove, class_id and n_links."""
    return document_classes(read_table(spark, sf_dir, "documents"))
