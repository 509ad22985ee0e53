"""Operator 10: benchmark decontamination by spaced seeds, with DataFrame functions only."""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.bitmaps import Bitmap
from cladeworks.llm.common import materialize, read_table

#: Masks over token positions (1: compared, 0: ignored). Together they hit every window of 20 tokens
#: with up to 4 substitutions and every one of 16 with up to 3, wherever those stand.
MASKS = ("1101010001", "111011")
#: What separates tokens; tokens are lower-cased runs of letters and digits.
BREAKS = r"[^\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(F.lower(text), BREAKS), ""), lambda w: F.xxhash64(w))


def at_offsets(hashes: Column, start: Column, offsets: list[int]) -> Column:
    return F.xxhash64(*[F.get(hashes, start + o) for o in offsets])


def pair_hash(hashes: Column, start: Column) -> Column:
    """Of the first two tokens, which every mask compares."""
    return at_offsets(hashes, start, [0, 1])


def seeds_at(hashes: Column, size: Column, start: Column, masks: tuple[str, ...]) -> Column:
    """array<struct<mask, pos, span, seed>>: the masks that fit at ``start``."""
    made = [F.struct(F.lit(k).alias("mask"), start.alias("pos"), F.lit(len(m)).alias("span"), at_offsets(hashes, start, [o for o, c in enumerate(m) if c == "1"]).alias("seed")) for k, m in enumerate(masks)]
    return F.filter(F.array(*made), lambda s: s["pos"] + s["span"] <= size)


def starts(size: Column, masks: tuple[str, ...]) -> Column:
    least = min(map(len, masks))
    return F.when(size >= least, F.sequence(F.lit(0), size - least)).otherwise(F.array().cast("array<int>"))


def always_hit(width: int, substitutions: int, masks: tuple[str, ...]) -> bool:
    """Whether some mask fits a window clear of the substitutions, wherever these stand."""
    placed = [frozenset(at + o for o, c in enumerate(m) if c == "1") for m in masks for at in range(width - len(m) + 1)]
    return all(any(not p & set(gone) for p in placed) for gone in combinations(range(width), substitutions))


def whole_masks(width: int, substitutions: int) -> list[tuple[int, str]]:
    """(place, mask) over whole items of ``width`` tokens, so that every placement of substitutions leaves one clear.

    The item falls into two parts more than substitutions; two parts are always clear, and each pair of parts is a mask.
    """
    parts = min(substitutions + 2, width)
    edges = [round(k * width / parts) for k in range(parts + 1)]
    out = []
    for kept in combinations(range(parts), parts - substitutions):
        mask = "".join("1" if any(edges[k] <= o < edges[k + 1] for k in kept) else "0" for o in range(width))
        out.append((mask.index("1"), mask.strip("0")))
    return out


def short_masks(widths: list[int], share: float, masks: tuple[str, ...]) -> list[tuple[int, int, str]]:
    """(width, place, mask) for those widths of items that the general masks don't always hit."""
    allowed = {w: w - ceil(w * share - 1e-9) for w in widths}
    return [(w, *m) for w in widths if not always_hit(w, allowed[w], masks) for m in whole_masks(w, allowed[w])]


def with_context(seeds: DataFrame, window: int) -> DataFrame:
    """Add the tokens that windows around the seed can cover, and where in them it stands."""
    low = F.greatest(F.col("s.pos") + F.col("s.span") - window, F.lit(0))
    high = F.least(F.col("s.pos") + window, F.col("size"))
    return seeds.select("id", "size", "s.mask", "s.seed", (F.col("s.pos") - low).alias("at"), F.slice("hashes", low + 1, high - low).alias("context"))


def best_window(doc: Column, doc_at: Column, item: Column, item_at: Column, window: Column) -> Column:
    """The most equal tokens in ``window`` aligned ones around a seed; null if there are fewer."""
    before = F.least(doc_at, item_at)
    aligned = before + F.least(F.size(doc) - doc_at, F.size(item) - item_at)

    def sums(equal: Column) -> Column:
        totals = F.transform(F.sequence(F.lit(1), aligned - window + 1), lambda s: F.aggregate(F.slice(equal, s, window), F.lit(0), lambda a, x: a + x))
        return F.array_max(totals)

    equal = F.transform(F.sequence(F.lit(0), aligned - 1), lambda t: (F.get(doc, doc_at - before + t) == F.get(item, item_at - before + t)).cast("int"))
    return F.when(aligned >= window, F.get(F.transform(F.array(equal), sums), F.lit(0)))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 20, share: float = 0.8, masks: tuple[str, ...] = MASKS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item, matched): documents that hold ``window`` consecutive tokens of a benchmark item with at least ``share`` of them equal.

    Items shorter than ``window`` are compared as a whole, down to one token; widths that the masks might
    miss get masks of their own. ``matched`` is the most equal tokens of any such window. Every item with
    equal text is named. Bitmaps of fixed size keep back what can't join, so only a few seeds with their
    context are shuffled, never texts; equal contexts of the benchmark are merged first. Null and empty
    texts hold nothing; very long texts are read whole; repeated rows give one result; an empty table or
    benchmark gives an empty one; null ids take part; other columns are ignored.
    """
    size, hashes = F.size("hashes"), F.col("hashes")
    items = benchmark.select(benchmark[item_col].alias("id"), token_hashes(benchmark[item_text_col].cast("string")).alias("hashes")).where("size(hashes) > 0").withColumn("size", size)
    widths = sorted(r["size"] for r in items.where(F.col("size") < window).select("size").distinct().collect())  # fewer than ``window`` numbers
    short = short_masks(widths, share, masks)
    every = (*masks, *(m for _, _, m in short))

    def seed(k: int, start: Column) -> Column:
        return F.struct(F.lit(k).alias("mask"), start.alias("pos"), F.lit(len(every[k])).alias("span"), at_offsets(hashes, start, [o for o, c in enumerate(every[k]) if c == "1"]).alias("seed"))

    general = F.flatten(F.transform(starts(F.col("size"), masks), lambda i: seeds_at(hashes, F.col("size"), i, masks)))
    whole = [F.when(F.col("size") == w, F.array(seed(k, F.lit(at)))) for k, (w, at, _) in enumerate(short, len(masks))]
    made = F.concat(general, *[F.coalesce(x, F.filter(general, lambda s: F.lit(False))) for x in whole]) if short else general
    item_seeds = with_context(items.select("id", "size", "hashes", F.explode(made).alias("s")), window)
    width = F.least(F.col("size"), F.lit(window)).alias("width")
    item_seeds = materialize(item_seeds.select("id", "mask", "seed", "at", "context", width).withColumn("class", F.xxhash64("mask", "seed", "at", "context", "width")), "seeds")
    classes = item_seeds.groupBy("mask", "seed", "class").agg(*[F.first(c).alias(c) for c in ("at", "context", "width")])
    firsts = items.select(F.explode(F.transform(starts(F.col("size"), masks), lambda i: pair_hash(hashes, i))).alias("h"))
    pairs, seeds = Bitmap(firsts, "h"), Bitmap(item_seeds, "seed")

    rows = docs.select(docs[id_col].alias("id"), token_hashes(docs[text_col].cast("string")).alias("hashes")).where("hashes is not null").withColumn("size", size)
    likely = F.filter(starts(F.col("size"), masks), lambda i: pairs.has(pair_hash(hashes, i)))
    hits = F.flatten(F.transform(likely, lambda i: F.filter(seeds_at(hashes, F.col("size"), i, masks), lambda s: seeds.has(s["seed"]))))
    if short:
        heads = Bitmap(items.where(F.col("size").isin(sorted({w for w, _, _ in short}))).select(F.explode("hashes").alias("h")), "h")
        of_short = lambda i: F.filter(F.array(*[seed(k, i) for k in range(len(masks), len(every))]), lambda s: (s["pos"] + s["span"] <= F.col("size")) & seeds.has(s["seed"]))
        places = F.filter(starts(F.col("size"), ("1",)), lambda i: heads.has(F.get(hashes, i)))
        hits = F.concat(hits, F.flatten(F.transform(places, of_short)))
    doc_seeds = with_context(rows.select("id", "size", "hashes", F.explode(hits).alias("s")), window).select("id", "mask", "seed", F.col("at").alias("doc_at"), F.col("context").alias("doc_context"))
    met = doc_seeds.join(classes, ["mask", "seed"]).select("id", "class", "width", best_window(F.col("doc_context"), F.col("doc_at"), F.col("context"), F.col("at"), F.col("width")).alias("matched"))
    found = met.where(F.col("matched") >= F.ceil(F.col("width") * share - 1e-9)).groupBy("id", "class").agg(F.max("matched").alias("matched"))
    named = found.join(item_seeds.select(F.col("id").alias("item"), "class").distinct(), "class")
    return named.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(F.max("matched").alias("matched"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
