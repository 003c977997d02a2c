"""Images as flat arrays: index arithmetic on height x width x channels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from fitloom.functions.hashing import coin, let, uniform


def _remap(px: Column, n: int, source) -> Column:
    """New array of ``n`` entries, entry i taken from ``px[source(i)]``; an image of another size is an error."""
    cells = F.sequence(F.lit(0), F.lit(n - 1))

    def moved(p):
        wrong = F.raise_error(F.concat(F.lit(f"image of {n} values expected, not "), F.size(p).cast("string")))
        return F.when(p.isNotNull() & (F.size(p) != n), wrong).when(p.isNotNull(), F.transform(cells, lambda i: F.get(p, source(i).cast("int"))))

    return let(px, moved)


def _div(i: Column, n: int) -> Column:
    return F.floor(i / F.lit(n)).cast("int")


def to_unit_chw(px: Column, h: int, w: int, c: int) -> Column:
    """0..255 interleaved (row, column, channel) -> 0..1 channel-first."""
    plane = h * w
    moved = _remap(px, plane * c, lambda i: (i % plane) * c + _div(i, plane))
    return F.transform(moved, lambda x: x / F.lit(255.0))


def chw_to_hwc(px: Column, h: int, w: int, c: int) -> Column:
    plane = h * w
    return _remap(px, plane * c, lambda i: (i % c) * plane + _div(i, c))


def normalize(px: Column, mean: float = 0.5, std: float = 0.5) -> Column:
    return F.transform(px, lambda x: (x - F.lit(mean)) / F.lit(std))


def denormalize(px: Column) -> Column:
    """-1..1 -> 0..1."""
    return F.transform(px, lambda x: x / F.lit(2.0) + F.lit(0.5))


def to_bytes(px: Column) -> Column:
    """0..1 -> 0..255, clamped and truncated."""
    return F.transform(
        px, lambda x: F.floor(F.least(F.greatest(x * F.lit(255.0), F.lit(0.0)), F.lit(255.0))).cast("int")
    )


def hflip(px: Column, h: int, w: int, c: int = 1) -> Column:
    """Left-right, for an interleaved image."""
    row = w * c
    return _remap(px, h * row, lambda i: _div(i, row) * row + (F.lit(w - 1) - _div(i % row, c)) * c + i % c)


def vflip(px: Column, h: int, w: int, c: int = 1) -> Column:
    """Top-bottom, for an interleaved image."""
    row = w * c
    return _remap(px, h * row, lambda i: (F.lit(h - 1) - _div(i, row)) * row + i % row)


def rotate(px: Column, degrees: Column, h: int, w: int, c: int = 1) -> Column:
    """Counter-clockwise about the centre, nearest neighbour, zeros outside."""
    cx, cy, row = (w - 1) / 2.0, (h - 1) / 2.0, w * c
    cells = F.sequence(F.lit(0), F.lit(h * row - 1))

    def turned(t):
        def cell(i):
            x = _div(i % row, c) - F.lit(cx)
            y = _div(i, row) - F.lit(cy)
            sx = F.floor(x * t["cos"] - y * t["sin"] + F.lit(cx + 0.5)).cast("int")
            sy = F.floor(x * t["sin"] + y * t["cos"] + F.lit(cy + 0.5)).cast("int")
            inside = sx.between(0, w - 1) & sy.between(0, h - 1)
            return F.when(inside, F.get(t["px"], sy * row + sx * c + i % c)).otherwise(F.lit(0.0))

        return F.transform(cells, cell)

    return let(
        degrees * F.lit(math.pi / 180.0),
        lambda a: let(F.struct(px.alias("px"), F.cos(a).alias("cos"), F.sin(a).alias("sin")), turned),
    )


def random_hflip(px: Column, row_id: Column, p: float, seed: int, h: int, w: int, c: int = 1) -> Column:
    return let(px, lambda x: F.when(coin(p, row_id, "hflip", seed), hflip(x, h, w, c)).otherwise(x))


def random_vflip(px: Column, row_id: Column, p: float, seed: int, h: int, w: int, c: int = 1) -> Column:
    return let(px, lambda x: F.when(coin(p, row_id, "vflip", seed), vflip(x, h, w, c)).otherwise(x))


def random_rotation(px: Column, row_id: Column, limit: float, seed: int, h: int, w: int, c: int = 1) -> Column:
    """Rotate by a uniform angle in [-limit, limit) degrees."""
    angle = (uniform(row_id, "rotate", seed) * F.lit(2.0) - F.lit(1.0)) * F.lit(float(limit))
    return rotate(px, angle, h, w, c)


# Share of the area and aspect ratio a blanked rectangle may have.
ERASE_AREA = (0.02, 0.33)
ERASE_RATIO = (0.3, 3.3)


def erase_box(row_id: Column, seed: int, h: int | Column, w: int | Column) -> Column:
    """struct(top, left, eh, ew): the rectangle drawn for a row; height and width may be columns."""
    lo, hi = ERASE_AREA
    area = (uniform(row_id, "area", seed) * F.lit(hi - lo) + F.lit(lo)) * F.lit(h * w).cast("double")
    log_lo, log_hi = math.log(ERASE_RATIO[0]), math.log(ERASE_RATIO[1])
    ratio = F.exp(uniform(row_id, "ratio", seed) * F.lit(log_hi - log_lo) + F.lit(log_lo))

    def size(d):
        eh = F.least(F.floor(F.sqrt(d["area"] * d["ratio"]) + F.lit(0.5)), F.lit(h - 1)).cast("int")
        ew = F.least(F.floor(F.sqrt(d["area"] / d["ratio"]) + F.lit(0.5)), F.lit(w - 1)).cast("int")
        return F.struct(eh.alias("eh"), ew.alias("ew"))

    def place(s):
        top = F.floor(uniform(row_id, "top", seed) * (F.lit(h + 1) - s["eh"])).cast("int")
        left = F.floor(uniform(row_id, "left", seed) * (F.lit(w + 1) - s["ew"])).cast("int")
        return F.struct(top.alias("top"), left.alias("left"), s["eh"].alias("eh"), s["ew"].alias("ew"))

    return let(let(F.struct(area.alias("area"), ratio.alias("ratio")), size), place)


def random_erase(px: Column, row_id: Column, p: float, seed: int, h: int, w: int, c: int = 1) -> Column:
    """Blank one random rectangle in every channel of a channel-first image."""

    def blanked(x, box):
        def cell(v, i):
            r, k = _div(i % (h * w), w), i % w
            hit = (
                (r >= box["top"]) & (r < box["top"] + box["eh"])
                & (k >= box["left"]) & (k < box["left"] + box["ew"])
            )
            return F.when(hit, F.lit(0.0)).otherwise(v)

        return F.transform(x, cell)

    return let(
        px,
        lambda x: F.when(
            coin(p, row_id, "erase", seed),
            let(erase_box(row_id, seed, h, w), lambda box: blanked(x, box)),
        ).otherwise(x),
    )


def train_augmentation(px: Column, row_id: Column, seed: int, h: int, w: int, c: int) -> Column:
    """Byte image in: flips, rotation, unit channel-first, erasing, normalising."""
    px = random_hflip(px, row_id, 0.2, seed, h, w, c)
    px = random_vflip(px, row_id, 0.5, seed, h, w, c)
    px = random_rotation(px, row_id, 24.0, seed, h, w, c)
    px = to_unit_chw(px, h, w, c)
    px = random_erase(px, row_id, 0.2, seed, h, w, c)
    return normalize(px)


def plain_preparation(px: Column, h: int, w: int, c: int) -> Column:
    """What validation and test images get."""
    return normalize(to_unit_chw(px, h, w, c))
