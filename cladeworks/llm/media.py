"""Operator 8: cropped and edited copies of images by local descriptors."""

from __future__ import annotations

from functools import lru_cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.common import drop_materialized, free_shuffles, give_back_memory, materialize, read_table
from cladeworks.llm.components import connected_components
from cladeworks.llm.imagekernels import FEATURE, agree, enough, features, folded, table_keys, waves

#: Images that are drawn, described or keyed together: what a task holds at once.
TOGETHER = 32
#: Hamming tables, and bits of a descriptor in the key of each.
TABLES, SAMPLE = 12, 64
#: Keys of so few images don't call for a round: pairs that share one such key only are left to the comparison in full.
FEW = 4
#: So many pairs are compared in one go, about 4 GB of descriptors that are moved; what they took is freed before the next go.
PAIRS = 4_000_000


def slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(at, TOGETHER)
    give_back_memory()


def vector_images(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 96) -> DataFrame:
    """(id, height, width, pixels): each vector as a square grey image, a sum of one wave for each of its values.

    A stand-in for a media column, since the tables hold no images: waves of many lengths and directions
    give detail at every place and scale, as photographs have, and like vectors give like images. Vectors of any
    length are drawn whole; null and infinite values count as zero in their place. Grey values are
    scaled to the image's own range. Null and empty vectors give null pixels.
    """
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            pixels = [None] * batch.num_rows
            values = batch.column(1).to_pylist()
            for length in sorted({len(v) for v in values if v}):
                some = [k for k, v in enumerate(values) if v and len(v) == length]
                grey = waves(np.nan_to_num(np.array([[x or 0.0 for x in values[k]] for k in some], np.float32), posinf=0, neginf=0), size)
                for k, image in zip(some, grey, strict=True):
                    pixels[k] = image.tobytes()
            side = pa.array([size] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), side, side, pa.array(pixels, pa.binary())], ["id", "height", "width", "pixels"])

    slim = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("v"))
    return slim.mapInArrow(run, f"id {kind}, height int, width int, pixels binary").withColumnRenamed("id", id_col)


def described(images: DataFrame, most: int, levels: int) -> DataFrame:
    """(id, digest, corners) of images (id, height, width, pixels): corners packs the descriptors; wrong sizes and nulls have neither."""
    kind = images.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            digest, packed = [None] * batch.num_rows, [b""] * batch.num_rows
            rows = [(k, h, w) for k, (h, w, p) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2)), batch.column(3), strict=True)) if p.is_valid and h and w and len(p.as_buffer()) == h * w]
            for h, w in sorted({r[1:] for r in rows}):
                some = [k for k, *shape in rows if shape == [h, w]]
                buffers = [batch.column(3)[k].as_buffer() for k in some]
                stack = np.stack([np.frombuffer(b, np.uint8).reshape(h, w) for b in buffers]).astype(np.float32)
                for k, b, found in zip(some, buffers, features(stack, most, levels), strict=True):
                    digest[k], packed[k] = sha256(b"%d %d " % (h, w) + b.to_pybytes()).digest(), found.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.binary()), pa.array(packed, pa.binary())], ["id", "digest", "corners"])

    return images.select("id", "height", "width", "pixels").mapInArrow(run, f"id {kind}, digest binary, corners binary")


@lru_cache(maxsize=1)
def samples() -> np.ndarray:
    """TABLES masks over the four words of a descriptor, each with SAMPLE bits set."""
    rng, out = np.random.default_rng(41), []
    for _ in range(TABLES):
        bits = np.zeros(256, np.uint8)
        bits[rng.permutation(256)[:SAMPLE]] = 1
        out.append(np.packbits(bits, bitorder="little").view("<u8"))
    return np.array(out)


def packed(column: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values that a binary column packs, end to end, and the place where each row's begin; the last place is their end."""
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(column.buffers()[2], dtype, (edges[-1] - edges[0]) // dtype.itemsize, edges[0])
    return values, (edges - edges[0]) // dtype.itemsize


def keyed(corners: DataFrame) -> DataFrame:
    """(key, id): the Hamming-table keys of images (id, corners), each once an image."""
    kind = corners.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            found, edges = packed(batch.column(1), FEATURE)
            keys = table_keys(found["words"], samples(), slice(None))
            of = np.tile(np.repeat(np.arange(batch.num_rows), np.diff(edges)), TABLES)
            order = np.lexsort((keys, of))
            keys, of = keys[order], of[order]
            once = np.ones(len(keys), bool)
            once[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(keys[once]), batch.column(0).take(pa.array(of[once]))], ["key", "id"])

    return corners.select("id", "corners").mapInArrow(run, f"key long, id {kind}")


def recurring(keys: DataFrame) -> DataFrame:
    """Those of the rows (key, id) whose key other rows have too: rows are sorted by key, and each is held against its neighbours."""

    def run(batches):
        last, key, kept = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column(0).to_numpy()
            same = found[1:] == found[:-1]
            on = last is not None and bool(found[0] == key)
            if kept or on:
                yield last
            keep = np.r_[on, same] | np.r_[same, False]
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array(keep[:-1]))
            last, key, kept = batch.slice(batch.num_rows - 1), found[-1], bool(keep[-1])
        if kept:
            yield last

    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(run, keys.schema)


def enough_corners(second: pa.Array, x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], bits: int, votes: int) -> np.ndarray:
    """For each pair of a batch, whether ``votes`` corners of its first image match some of its second: ``packed`` descriptors of either.

    Pairs of one second image that follow each other are worked on together.
    """
    (x, edges_x), (y, edges_y) = x, y
    ids = second.to_numpy(zero_copy_only=False)
    good = np.zeros(len(ids), bool)
    runs = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1], True][: len(ids) + 1])
    for start, stop in zip(runs[:-1], runs[1:], strict=True):
        one = y[edges_y[start] : edges_y[start + 1]]
        for at in range(start, stop, TOGETHER):
            to = min(at + TOGETHER, stop)
            edges = edges_x[at : to + 1]
            good[at:to] = enough(x[edges[0] : edges[-1]], edges[:-1] - edges[0], one, bits, votes)
    return good


def with_both(pairs: DataFrame, described: DataFrame) -> DataFrame:
    """Pairs of images (a, b, and other columns), then what ``described`` (id, of) holds of a and of b."""
    side = lambda c: described.select(F.col("id").alias(c), F.col("of").alias(f"of_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select(*pairs.columns, "of_a", "of_b")


def likely(pairs: DataFrame, corners: DataFrame, bits: int, votes: int) -> list[DataFrame]:
    """The written pairs of images (a, b), in tables of up to about PAIRS candidates each, without most of those that ``verified`` would discard, and with all that it would keep.

    Descriptors are folded, which brings none further apart, and go without places, so that fewer bytes are moved.
    """
    kind = corners.schema["id"].dataType.simpleString()
    three = np.dtype(("<u8", (3,)))

    def fold(batches):
        for batch in batches:
            found, edges = packed(batch.column(1), FEATURE)
            short = folded(found["words"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([short[x:y].tobytes() for x, y in zip(edges[:-1], edges[1:], strict=True)], pa.binary())], ["id", "of"])

    def run(batches):
        for batch in batches:
            good = enough_corners(batch.column(1), packed(batch.column(2), three), packed(batch.column(3), three), bits, votes)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    short, found = corners.select("id", "corners").mapInArrow(fold, f"id {kind}, of binary"), []
    goes = -(-pairs.count() // PAIRS) or 1
    for go in range(goes):
        some = pairs.where(F.pmod(F.xxhash64("b"), F.lit(goes)) == go)
        found.append(materialize(with_both(some, short).mapInArrow(run, pairs.schema), "likely"))
        free_shuffles(pairs.sparkSession)
    return found


def verified(pairs: DataFrame, corners: DataFrame, bits: int, votes: int, cell: float) -> DataFrame:
    """Those of the pairs of images (a, b, and other columns) that ``votes`` or more matching corners agree on one turn, scale and shift."""
    kept = pairs.columns

    def run(batches):
        for batch in batches:
            (x, edges_x), (y, edges_y) = (packed(batch.column(k), FEATURE) for k in (-2, -1))
            good = enough_corners(batch.column("b"), (x["words"], edges_x), (y["words"], edges_y), bits, votes)
            for k in np.flatnonzero(good):
                good[k] = agree(x[edges_x[k] : edges_x[k + 1]], y[edges_y[k] : edges_y[k + 1]], bits, votes, cell)
            yield batch.select(kept).filter(pa.array(good))

    return with_both(pairs, corners.select("id", F.col("corners").alias("of"))).mapInArrow(run, pairs.schema)


def followed(hooks: DataFrame) -> DataFrame:
    """(component, root): where the path from each component ends, of hooks (component, root) that each lead to a smaller one.

    There is one hook a component and so no circle; paths double their length in each round.
    """
    on = hooks.select(F.col("component").alias("root"), F.col("root").alias("next"))
    step = materialize(hooks.join(on, "root", "left").select("component", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "hooks")
    out = step.select("component", "root")
    if not step.where("moved").isEmpty():
        out = followed(out)
        drop_materialized(step)
        return out
    out.materialized_at = step.materialized_at
    return out


def relabelled(labels: DataFrame | None, hooks: DataFrame) -> DataFrame:
    """(id, component) of the images whose component isn't their own id, after components are hooked to others (component, root)."""
    fresh = hooks.select(F.col("component").alias("id"), F.col("root").alias("component"))
    if labels is None:
        return fresh
    return labels.join(hooks, "component", "left").select("id", F.coalesce("root", "component").alias("component")).unionByName(fresh)


def copy_groups(corners: DataFrame, bits: int, votes: int, cell: float) -> DataFrame:
    """(id, component): the smallest image that each image reaches by links between images that share a key, where that is another.

    Only keys that several images have are written, once. In each round an image is compared with the image
    that leads most of its keys, by what it is linked to so far, and a component is hooked to the smallest
    that one of its images is linked to. So groups of copies settle in proportion to their size, without a pass over
    all links. When a round finds nothing more, all images of a key that are still not in one component are compared,
    so a link that a component did not follow is met again; links that this finds join components last. Most of
    these pairs are unlike images that share one key by chance, and their number grows with the square of the images: rounds
    leave them out, and ``likely`` discards them at a small cost.
    """
    shared = materialize(recurring(keyed(corners)), "keys")
    free_shuffles(corners.sparkSession)
    labels, made = None, [shared]

    def named() -> DataFrame:
        if labels is None:
            return shared.select("key", F.col("id").alias("component"), "id")
        return shared.join(labels, "id", "left").select("key", F.coalesce("component", "id").alias("component"), "id")

    while True:
        # one image stands for those of one component that share a key
        some = named().withColumn("size", F.lit(1))
        if labels is not None:
            some = materialize(some.groupBy("key", "component").agg(F.min("id").alias("id"), F.count("*").alias("size")), "placed")
            made.append(some)
        leaders = some.groupBy("key").agg(F.min(F.struct("component", "id")).alias("lead"), F.max("component").alias("last"), F.sum("size").alias("images")).where("lead.component < last").select("key", "lead", "images")
        met = some.join(leaders, "key").where("component <> lead.component").groupBy("id", "component", "lead").agg(F.count("*").alias("n"), F.max("images").alias("images"))
        best = met.where((F.col("n") > 1) | (F.col("images") > FEW)).groupBy("id", "component").agg(F.max(F.struct("n", "lead.id", "lead.component")).alias("best"))
        best = materialize(best.select(F.col("best.id").alias("a"), F.col("id").alias("b"), F.col("best.component").alias("root"), "component"), "best")
        new = materialize(verified(best, corners, bits, votes, cell), "links")
        made += [best, new]
        if new.isEmpty():
            break
        hooks = followed(new.groupBy("component").agg(F.min("root").alias("root")))
        labels = materialize(relabelled(labels, hooks), "labels")
        made += [hooks, labels]

    rows = materialize(named(), "rows")
    mixed = rows.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("last")).where("least < last").select("key")
    mixed = materialize(rows.join(mixed, "key"), "mixed")
    rest = mixed.alias("x").join(mixed.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")))
    rest = materialize(rest.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct(), "pairs")
    near = likely(rest, corners, bits, votes)
    last = materialize(verified(reduce(DataFrame.unionByName, near), corners, bits, votes, cell), "links")
    made += [rows, mixed, rest, *near, last]
    if not last.isEmpty():
        for c in ("a", "b") if labels is not None else ():
            last = last.join(labels.select(F.col("id").alias(c), F.col("component").alias("of")), c, "left").withColumn(c, F.coalesce("of", c)).drop("of")
        parts = connected_components(last)
        hooks = materialize(parts.where("node <> component").select(F.col("node").alias("component"), F.col("component").alias("root")), "hooks")
        labels = relabelled(labels, hooks)
        made.append(hooks)
    if labels is None:
        labels = corners.select("id", F.col("id").alias("component")).limit(0)
    out = materialize(labels, "parts")
    drop_materialized(*made)
    return out


def image_copies(images: DataFrame, most: int = 24, levels: int = 3, bits: int = 32, votes: int = 4, cell: float = 12.0, id_col: str = "id") -> DataFrame:
    """(id, n_others, component): groups of copies among images (id, height, width, pixels: bytes of grey values).

    Images of equal size and pixels are merged first and represented by the smallest id. Others are copies if
    ``votes`` of their corners match, by ``bits`` or fewer differing bits of 256, and agree on turn, scale
    and shift. Candidates share a key in one of TABLES tables, each of SAMPLE sampled bits. The component
    is the smallest id reachable over copies (ties of places and scores never matter to it), n_others the
    number of other different images in it. Null pixels, wrong sizes, images without corners and images
    with a side of 36 pixels or less, which leaves a descriptor no room, are linked by equal pixels only. A
    null id is kept, without links; repeated rows are kept; very large images are read whole; an empty table
    gives an empty one; other columns are ignored.
    """
    slim = images.select(images[id_col].alias("id"), images["height"].alias("height"), images["width"].alias("width"), images["pixels"].alias("pixels"))
    found = materialize(described(slim, most, levels), "images")
    same = materialize(found.groupBy("digest").agg(F.min("id").alias("first")).where("digest is not null and first is not null"), "same")
    firsts = found.join(same, "digest").where("id = first").select("id", "corners").dropDuplicates(["id"])
    corners = materialize(firsts.where(F.octet_length("corners") > 0), "corners")
    labels = copy_groups(corners, bits, votes, cell)
    sizes = labels.groupBy("component").agg(F.count("*").alias("n_others"))
    placed = same.join(labels.withColumnRenamed("id", "first"), "first", "left").select("digest", F.coalesce("component", "first").alias("component"))
    named = placed.join(sizes, "component", "left").select("digest", "n_others", "component")
    out = found.select("id", "digest").join(named, "digest", "left")
    known = F.col("id").isNotNull()
    return out.select(F.col("id").alias(id_col), F.coalesce(F.when(known, F.col("n_others")), F.lit(0)).cast("long").alias("n_others"), F.when(known, F.coalesce("component", "id")).alias("component"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images are drawn from ``embeddings``."""
    images = vector_images(read_table(spark, sf_dir, "embeddings"))
    return image_copies(images, id_col="vec_id").select("vec_id", "n_others", F.col("component").alias("component_id"))
