"""Operator 3: secret scans by patterns and sliding-window entropy, with DataFrame functions only."""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.bitmaps import literal_array
from cladeworks.llm.common import read_table, text_or_empty

# The base kinds in their listed order, (pattern, least length, group that the length is of).
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
    "access": (r"AKIA[A-Z0-9]+", 20, 0),
    # a run of 24 or more is the whole run, and shorter runs fail
    "hex": (r"[0-9a-f]{24,}", 24, 0),
}
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: Character classes of candidates: (pattern of the whole candidate, least bits per character in a window).
CLASSES = {"entropy_hex": (r"^[0-9a-fA-F]+$", 2.8), "entropy_base64": (r"^[A-Za-z0-9+/_=-]+$", 3.7)}
#: Candidates that match one of these are known to be harmless.
ALLOWED = (
    r"^[A-Za-z_=/+-]*$",  # no digit: words, paths, rulers
    r"^[0-9_=/+-]*$",  # no letter: numbers and dates
    r"(?i)example|sample|placeholder|dummy|xxxx|0123456789|123456789|abcdefghij",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs
)


MATCHES = "array<struct<start:int,end:int,match:string>>"
#: Matches located together; blocks of them are put one behind the other.
BLOCK = 256


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once: an expression put into a lambda would be computed at each mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(text: Column, pattern: str, found: Column) -> Column:
    """Where the leftmost non-overlapping matches ``found`` stand: they and the gaps between them make up the text."""
    n = F.size(found)

    def fold(gaps: Column) -> Column:
        def step(acc, i):
            start = acc["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(found, i))
            return F.struct(end.alias("at"), F.array_append(acc["spans"], F.struct(start.alias("start"), end.alias("end"), F.get(found, i).alias("match"))).alias("spans"))

        def block(acc, first):
            inside = F.aggregate(F.sequence(first, F.least(first + BLOCK, n) - 1), F.struct(acc["at"].alias("at"), F.array().cast(MATCHES).alias("spans")), step)
            return bound(inside, lambda b: F.struct(b["at"].alias("at"), F.array_append(acc["blocks"], b["spans"]).alias("blocks")))

        nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{MATCHES}>").alias("blocks"))
        return F.flatten(F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(BLOCK)), nothing, block)["blocks"])

    return F.when(n > 0, bound(F.split(text, pattern, -1), fold)).otherwise(F.array().cast(MATCHES))


#: The least and the most code of a candidate's characters.
FIRST_CODE, LAST_CODE = ord("+"), ord("z")


class Counts:
    """How often each character is in the window, as small numbers side by side in a few longs."""

    def __init__(self, window: int):
        self.bits = (window + 1).bit_length()
        self.per = 63 // self.bits
        self.lanes = (LAST_CODE - FIRST_CODE) // self.per + 1

    def none(self) -> Column:
        return F.array_repeat(F.lit(0).cast("long"), self.lanes)

    def lane(self, code: Column) -> Column:
        return F.floor((code - FIRST_CODE) / self.per).cast("int")

    def one(self, code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), ((code - FIRST_CODE) % self.per * self.bits).cast("int"))

    def of(self, counts: Column, code: Column) -> Column:
        shifted = F.call_function("shiftright", F.get(counts, self.lane(code)), ((code - FIRST_CODE) % self.per * self.bits).cast("int"))
        return shifted.bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int")

    def moved(self, counts: Column, new: Column, old: Column) -> Column:
        """With a character more, and one less where ``old`` isn't null."""
        def each(v, k):
            out = F.when(k == self.lane(old), self.one(old)).otherwise(F.lit(0).cast("long"))
            return v + F.when(k == self.lane(new), self.one(new)).otherwise(F.lit(0).cast("long")) - F.coalesce(out, F.lit(0).cast("long"))

        return F.transform(counts, each)


def entropy_span(candidate: Column, window: int, least: Column) -> Column:
    """struct<lo, hi>: from the first to the last window of at least so many bits per character; lo is -1 if none has.

    Slides one character at a time and keeps the counts of the window's characters: the one that comes in and the one that goes
    out change two of them, and the sum of n log2 n by what that makes. The work is in proportion to the length.
    """
    weight, kept = literal_array([n * log2(n) if n else 0.0 for n in range(window + 2)], "double"), Counts(window)

    def slide(codes: Column) -> Column:
        def step(acc, i):
            new, old = F.get(codes, i), F.when(i >= window, F.get(codes, i - window))
            changed = F.struct(
                kept.of(acc["counts"], new).alias("come"),
                # the count of what goes out, with what came in already among it
                (kept.of(acc["counts"], old) + (old == new).cast("int")).alias("gone"),
                kept.moved(acc["counts"], new, old).alias("counts"),
            )
            return bound(changed, lambda m: bound(total(acc, m), lambda t: seen(acc, m, t, i)))

        def total(acc, m):
            grown = F.get(weight, m["come"] + 1) - F.get(weight, m["come"])
            shrunk = F.get(weight, m["gone"] - 1) - F.get(weight, m["gone"])
            return acc["sum"] + grown + F.coalesce(shrunk, F.lit(0.0))

        def seen(acc, m, total, i):
            enough = (i >= window - 1) & (F.round(F.lit(log2(window)) - total / window, 9) >= least)
            return F.struct(m["counts"].alias("counts"), total.alias("sum"), F.when(enough & (acc["lo"] < 0), i - (window - 1)).otherwise(acc["lo"]).alias("lo"), F.when(enough, i + 1).otherwise(acc["hi"]).alias("hi"))

        nothing = F.struct(kept.none().alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1).alias("lo"), F.lit(-1).alias("hi"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), nothing, step, lambda acc: F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi")))

    return bound(F.transform(F.split(candidate, ""), lambda c: F.ascii(c)), slide)


SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def clear_of(found: Column, base: Column) -> Column:
    """Those of the spans ``found`` that overlap none of ``base``: all are put in order once and read once.

    A found span is judged where it ends: what begins before then and ends behind its start overlaps it.
    """
    event = lambda at, order: lambda s: F.struct(at(s).alias("at"), F.lit(order).alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind"))
    events = F.array_sort(F.concat(F.transform(found, event(lambda s: s["end"], 0)), F.transform(base, event(lambda s: s["start"], 1))))

    def fold(rows: Column) -> Column:
        n = F.size(rows)

        def step(acc, i):
            e = F.get(rows, i)
            free = (e["order"] == 0) & (acc["reach"] <= e["start"])
            reach = F.when(e["order"] == 1, F.greatest(acc["reach"], e["end"])).otherwise(acc["reach"])
            span = F.struct(e["start"].alias("start"), e["rank"].alias("rank"), e["end"].alias("end"), e["kind"].alias("kind"))
            return F.struct(reach.alias("reach"), F.when(free, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

        def block(acc, first):
            start = F.struct(acc["reach"].alias("reach"), F.array().cast(SPANS).alias("spans"))
            inside = F.aggregate(F.sequence(first, F.least(first + BLOCK, n) - 1), start, step)
            return bound(inside, lambda b: F.struct(b["reach"].alias("reach"), F.array_append(acc["blocks"], b["spans"]).alias("blocks")))

        nothing = F.struct(F.lit(-1).alias("reach"), F.array().cast(f"array<{SPANS}>").alias("blocks"))
        return F.flatten(F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(BLOCK)), nothing, block)["blocks"])

    return F.when(F.size(found) > 0, bound(events, fold)).otherwise(F.array().cast(SPANS))


def joined(spans: Column) -> Column:
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def find_secrets(docs: DataFrame, window: int = 20, classes: dict = CLASSES, allowed: tuple[str, ...] = ALLOWED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans) per row, over its whole text.

    Base spans are pattern matches. Further candidates are whole runs of key characters; those without
    an allow-listed shape get the span of their windows of high Shannon entropy, with the bound of their
    character class, unless it overlaps a base span. Spans are kind:start:end in code points, end
    exclusive, by start and kind. One narrow stage: nothing is shuffled or leaves the JVM. Null and empty
    texts have no spans; very long texts and candidates are read whole, in proportion to their length;
    windows that tie in entropy all count; repeated rows are scanned each; an empty table gives an empty
    one; other columns are ignored.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).withColumn("text", text_or_empty("text"))
    patterns = {kind: pattern for kind, (pattern, _, _) in BASE.items()} | {"candidate": CANDIDATE}
    rows = rows.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in patterns.items()])
    rows = rows.select("id", *[located(F.col("text"), p, F.col(f"m_{k}")).alias(k) for k, p in patterns.items()])

    def base(rank: int, kind: str) -> Column:
        pattern, least, group = BASE[kind]
        long_enough = lambda m: F.length(F.regexp_extract(m["match"], pattern, group)) >= least
        return F.transform(F.filter(kind, long_enough), lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))

    rows = rows.select("id", "candidate", *[base(k, kind).alias(kind) for k, kind in enumerate(BASE)])
    rows = rows.select("id", "candidate", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE], F.concat(*BASE).alias("base"))
    kind_of = lambda m: F.coalesce(*[F.when(m["match"].rlike(p), F.struct(F.lit(k + len(BASE)).alias("rank"), F.lit(name).alias("kind"), F.lit(bits).alias("bits"))) for k, (name, (p, bits)) in enumerate(classes.items())])
    harmless = lambda m: F.greatest(*[m["match"].rlike(p) for p in allowed], F.lit(False))

    def high(m):
        spans = F.transform(F.array(kind_of(m)), lambda k: F.struct(k.alias("k"), entropy_span(m["match"], window, k["bits"]).alias("at")))
        return F.transform(spans, lambda b: F.struct((m["start"] + b["at"]["lo"]).alias("start"), b["k"]["rank"].alias("rank"), (m["start"] + b["at"]["hi"]).alias("end"), b["k"]["kind"].alias("kind"), b["at"]["lo"].alias("lo")))

    found = F.filter(F.flatten(F.transform(F.filter("candidate", lambda m: ~harmless(m)), high)), lambda s: s["lo"] >= 0)
    rows = rows.withColumn("found", found).withColumn("found", clear_of(F.col("found"), F.col("base")))
    return rows.select(
        F.col("id").alias(id_col), *[f"n_{k}" for k in BASE], F.size("found").cast("long").alias("n_entropy"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "found")).alias("spans"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))
