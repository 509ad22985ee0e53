"""NumPy kernels for batches of grey images: corners, orientations, binary descriptors and their agreement."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Radius in pixels of the patch that a descriptor sees, and tests in a descriptor.
RADIUS, TESTS = 15, 256
#: Orientations are normalised in so many steps of the circle.
TURNS = 24
#: Ratio of the sizes of two levels.
STEP = 1.5
#: A described corner: its place in the full image, level, orientation and bits.
FEATURE = np.dtype([("y", "<f4"), ("x", "<f4"), ("level", "i1"), ("turn", "i1"), ("words", "<u8", (TESTS // 64,))])


def box(image: np.ndarray, r: int) -> np.ndarray:
    """Means over (2r + 1)-squares, edges repeated."""
    for axis in (1, 2):
        # rows along the axis come first, so that running sums are additions of whole rows
        rows = np.moveaxis(image, axis, 0)
        total = np.empty((len(rows) + 2 * r + 1, *rows.shape[1:]), np.float32)
        total[: r + 1], total[r + 1 : r + 1 + len(rows)], total[r + 1 + len(rows) :] = rows[0], rows, rows[-1]
        for k in range(1, len(total)):
            total[k] += total[k - 1]
        image = np.moveaxis((total[2 * r + 1 :] - total[: -(2 * r + 1)]) / (2 * r + 1), 0, axis)
    return np.ascontiguousarray(image)


def resized(images: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear."""
    for axis, size in ((1, height), (2, width)):
        old = images.shape[axis]
        at = np.clip((np.arange(size) + 0.5) * old / size - 0.5, 0, old - 1)
        low = np.minimum(at.astype(int), max(old - 2, 0))
        part = (at - low).astype(np.float32)
        part = part[:, None] if axis == 1 else part
        images = images.take(low, axis) * (1 - part) + images.take(np.minimum(low + 1, old - 1), axis) * part
    return images


def corners(images: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """(image, y, x) of the strongest Harris corners, away from the edges and from stronger ones."""
    dy, dx = np.gradient(images, axis=(1, 2))
    a, b, c = box(dx * dx, 2), box(dy * dy, 2), box(dx * dy, 2)
    response = a * b - c * c - 0.05 * (a + b) ** 2
    best = response.copy()
    for axis in (1, 2):
        wide = best.copy()
        for s in (1, 2, 3):
            wide = np.maximum(wide, np.maximum(np.roll(best, s, axis), np.roll(best, -s, axis)))
        best = wide
    inside = np.zeros(images.shape[1:], bool)
    inside[RADIUS:-RADIUS, RADIUS:-RADIUS] = True
    strong = np.where((response >= best) & inside & (response > 1.0), response, 0).reshape(len(images), -1)
    k = min(most, strong.shape[1])
    top = np.argpartition(-strong, k - 1, axis=1)[:, :k]
    image, rank = np.nonzero(np.take_along_axis(strong, top, 1) > 0)
    return image, *np.divmod(top[image, rank], images.shape[2])


@lru_cache(maxsize=1)
def patterns() -> tuple[np.ndarray, np.ndarray]:
    """(disc offsets, TURNS x TESTS x 2 points x (y, x) offsets of the tests, turned)."""
    grid = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1].reshape(2, -1).T
    disc = grid[(grid**2).sum(1) <= (RADIUS - 4) ** 2]
    points = np.random.default_rng(20).normal(0, RADIUS / 2.2, (4 * TESTS, 2, 2))
    points = points[(np.hypot(points[..., 0], points[..., 1]) <= RADIUS - 1).all(1)][:TESTS]
    angle = np.arange(TURNS) * 2 * np.pi / TURNS
    cos, sin = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
    y, x = points[None, ..., 0], points[None, ..., 1]
    return disc, np.rint(np.stack([y * cos + x * sin, x * cos - y * sin], -1)).astype(int)


def describe(images: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """(image, y, x, turn, four 64-bit words) of each corner of equally sized images (n x h x w, 0 to 255)."""
    image, y, x = corners(images, most)
    smooth = box(images, 1)
    disc, tests = patterns()
    at, width = np.ravel_multi_index((image, y, x), images.shape)[:, None], images.shape[2]
    patch = images.ravel().take(at + (disc[:, 0] * width + disc[:, 1]))
    patch = patch - patch.mean(1, keepdims=True)
    angle = np.arctan2(patch @ disc[:, 0].astype(np.float32), patch @ disc[:, 1].astype(np.float32))
    turn = np.rint(angle * TURNS / (2 * np.pi)).astype(int) % TURNS
    steps = (tests[..., 0] * width + tests[..., 1])[turn]
    first, second = (smooth.ravel().take(at + steps[..., k]) for k in range(2))
    bits = np.packbits(first < second, axis=1, bitorder="little")
    return image, y, x, turn, bits.view("<u8").reshape(len(image), TESTS // 64)


def multiscale(images: np.ndarray, most: int, levels: int, step: float = STEP) -> list[np.ndarray]:
    """Columns (image, y, x, level, turn, words) over all levels; y and x are places in the full image."""
    parts, (height, width) = [], images.shape[1:]
    for level in range(levels):
        h, w = round(height / step**level), round(width / step**level)
        if min(h, w) <= 2 * RADIUS + 6:
            break
        image, y, x, turn, words = describe(images if level == 0 else resized(images, h, w), most)
        parts.append((image, y * height / h, x * width / w, np.full(len(image), level), turn, words))
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros((0, 4)) if k == 5 else np.zeros(0) for k in range(6)]


def features(images: np.ndarray, most: int, levels: int) -> list[np.ndarray]:
    """The FEATUREs of each image."""
    image, y, x, level, turn, words = multiscale(images, most, levels)
    out = np.zeros(len(image), FEATURE)
    for name, values in zip(FEATURE.names, (y, x, level, turn, words), strict=True):
        out[name] = values
    order = np.argsort(image, kind="stable")
    edges = np.searchsorted(image[order], np.arange(len(images) + 1))
    return [out[order[a:b]] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def table_keys(words: np.ndarray, masks: np.ndarray, tables: slice) -> np.ndarray:
    """One 64-bit key for each descriptor and table: a hash of the table and the bits under its mask."""
    out = []
    with np.errstate(over="ignore"):
        for k in range(len(masks))[tables]:
            h = np.full(len(words), k + 1, np.uint64)
            for i in range(words.shape[1]):
                h = (h ^ (words[:, i] & masks[k, i])) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
            out.append(h)
    return np.concatenate(out).view(np.int64)


def folded(words: np.ndarray) -> np.ndarray:
    """Descriptors in three words: the bits of the last two are added modulo two, so two descriptors come no further apart."""
    return np.column_stack([words[:, :2], words[:, 2] ^ words[:, 3]])


def enough(many: np.ndarray, starts: np.ndarray, one: np.ndarray, bits: int, votes: int) -> np.ndarray:
    """Whether ``votes`` descriptors of each of many images match some of one; many holds those of all images, end to end."""
    apart = np.zeros((len(one), len(many)), np.uint16)
    for k in range(one.shape[1]):
        apart += np.bitwise_count(one[:, k, None] ^ many[:, k])
    return np.add.reduceat((apart <= bits).any(0), starts, dtype=np.int64) >= votes


def agree(a: np.ndarray, b: np.ndarray, bits: int, votes: int, cell: float) -> bool:
    """Whether ``votes`` corners of a match corners of b, and agree on one turn, scale and shift.

    Each match votes for two neighbouring steps of the turn and of the shift along either axis, so that no
    border parts votes that are close. A corner counts once in a ballot.
    """
    apart = np.bitwise_count(a["words"][:, None, :] ^ b["words"][None, :, :]).sum(2, dtype=np.int64)
    i, j = np.nonzero(apart <= bits)
    if len(np.unique(i)) < votes:
        return False
    p, q = a[i], b[j]
    zoom = p["level"].astype(int) - q["level"]
    turn = (p["turn"].astype(int) - q["turn"]) % TURNS
    angle, scale = turn * (2 * np.pi / TURNS), STEP**zoom
    dy = p["y"] - scale * (q["y"] * np.cos(angle) + q["x"] * np.sin(angle))
    dx = p["x"] - scale * (q["x"] * np.cos(angle) - q["y"] * np.sin(angle))
    ballots = []
    for more in range(2):
        for half_y in (0, 0.5):
            for half_x in (0, 0.5):
                ballots.append(np.stack([zoom, (turn + more) % TURNS, np.floor(dy / cell + half_y), np.floor(dx / cell + half_x), np.full(len(i), 4 * half_y + 2 * half_x), i], 1))
    cast = np.unique(np.concatenate(ballots).astype(np.int64), axis=0)
    return bool(np.unique(cast[:, :5], axis=0, return_counts=True)[1].max() >= votes)


@lru_cache(maxsize=4)
def wave_block(block: int, size: int) -> np.ndarray:
    """64 plane waves over a square, of random directions, phases and lengths down to eight pixels; longer ones are stronger."""
    rng = np.random.default_rng([17, block])
    cycles, angle, phase = rng.uniform(1.5, size / 8, 64), rng.uniform(0, 2 * np.pi, 64), rng.uniform(0, 2 * np.pi, 64)
    y, x = np.mgrid[:size, :size] * (2 * np.pi / size)
    at = (cycles * np.sin(angle))[:, None, None] * y + (cycles * np.cos(angle))[:, None, None] * x + phase[:, None, None]
    return (np.cos(at) / np.sqrt(cycles)[:, None, None]).astype(np.float32).reshape(64, -1)


def waves(vectors: np.ndarray, size: int) -> np.ndarray:
    """Each vector (n x length) as a grey image: the sum of its values' waves, scaled to 0 to 255."""
    grey = np.zeros((len(vectors), size * size), np.float32)
    for at in range(0, vectors.shape[1], 64):
        part = vectors[:, at : at + 64]
        grey += part @ wave_block(at // 64, size)[: part.shape[1]]
    grey -= grey.min(1, keepdims=True)
    grey *= 255 / np.maximum(grey.max(1, keepdims=True), 1e-9)
    return np.rint(grey).astype(np.uint8).reshape(-1, size, size)
