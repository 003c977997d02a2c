"""Augmentation of images of mixed sizes: drawn by Spark expressions, carried out per shape in Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from fitloom.functions.hashing import coin, uniform
from fitloom.functions.pixels import erase_box

CHUNK_CELLS = 1 << 21
PLAIN = ("unit", "normalize")
TRAIN = ("hflip", "vflip", "rotation", "unit", "erase", "normalize")
MEAN = STD = 0.5


def _rotated(x: np.ndarray, cos: np.ndarray, sin: np.ndarray) -> np.ndarray:
    """Counter-clockwise about the centre, nearest neighbour, zeros outside."""
    n, h, w, _ = x.shape
    cx, cy = (w - 1) / 2.0, (h - 1) / 2.0
    cos, sin = cos[:, None, None], sin[:, None, None]
    right, down = np.arange(w)[None, None, :] - cx, np.arange(h)[None, :, None] - cy
    sx = np.floor(right * cos - down * sin + (cx + 0.5)).astype(np.int64)
    sy = np.floor(right * sin + down * cos + (cy + 0.5)).astype(np.int64)
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = x[np.arange(n)[:, None, None], np.clip(sy, 0, h - 1), np.clip(sx, 0, w - 1)]
    return np.where(inside[..., None], out, 0.0)


def _changed(x: np.ndarray, draws: dict[str, np.ndarray], steps: tuple[str, ...]) -> np.ndarray:
    """Images of one shape (n, h, w, c) through ``steps``; channel-first from the step ``unit`` on."""
    for step in steps:
        if step == "hflip":
            x = np.where(draws["hflip"][:, None, None, None], x[:, :, ::-1], x)
        elif step == "vflip":
            x = np.where(draws["vflip"][:, None, None, None], x[:, ::-1], x)
        elif step == "rotation":
            x = _rotated(x, draws["cos"], draws["sin"])
        elif step == "unit":
            x = (x / 255.0).transpose(0, 3, 1, 2)
        elif step == "erase":
            first = 2 if "unit" in steps[: steps.index(step)] else 1
            rows, cols = np.arange(x.shape[first])[None, :, None], np.arange(x.shape[first + 1])[None, None, :]
            top, left, eh, ew = (draws[c][:, None, None] for c in ("top", "left", "eh", "ew"))
            hit = draws["erase"][:, None, None] & (rows >= top) & (rows < top + eh) & (cols >= left) & (cols < left + ew)
            x = np.where(hit[:, None] if first == 2 else hit[..., None], 0.0, x)
        elif step == "normalize":
            x = (x - MEAN) / STD
        else:
            raise ValueError(step)
    return x


def transform_images(
    df: DataFrame, image: str, height: Column, width: Column, channels: Column, row_id: Column, seed: int = 42, steps: tuple[str, ...] = TRAIN,
    p_hflip: float = 0.2, p_vflip: float = 0.5, degrees: float = 24.0, p_erase: float = 0.2,
) -> DataFrame:
    """``df`` with the array ``image`` (interleaved rows, columns, channels; 0..255) taken through ``steps``.

    Sizes are columns and may differ from row to row. Every draw depends on the row id and the seed alone and is the one
    that the column functions of ``pixels`` make. A batch is grouped by shape and worked on as whole arrays of bounded size; nothing is
    shuffled. A null image stays null (its sizes may be null too); one whose size is not height x width x channels raises.
    """
    used = {"h": height.cast("int"), "w": width.cast("int"), "c": channels.cast("int")}
    if "hflip" in steps:
        used["hflip"] = coin(p_hflip, row_id, "hflip", seed)
    if "vflip" in steps:
        used["vflip"] = coin(p_vflip, row_id, "vflip", seed)
    if "rotation" in steps:
        angle = (uniform(row_id, "rotate", seed) * F.lit(2.0) - F.lit(1.0)) * F.lit(float(degrees)) * F.lit(math.pi / 180.0)
        used |= {"cos": F.cos(angle), "sin": F.sin(angle)}
    if "erase" in steps:
        box = erase_box(row_id, seed, height, width)
        used |= {"erase": coin(p_erase, row_id, "erase", seed), **{k: box[k] for k in ("top", "left", "eh", "ew")}}
    names = list(used)
    plain = F.col(image).cast("array<double>").alias(image)
    rows = df.select(*[plain if c == image else F.col(f"`{c}`") for c in df.columns], F.struct(*[v.alias(k) for k, v in used.items()]).alias("__draws"))
    at = df.columns.index(image)

    def run(batches):
        for batch in batches:
            column, draws = batch.column(at), batch.column(len(names_out)).flatten()
            draws = {k: d.to_numpy(zero_copy_only=False) for k, d in zip(names, draws)}
            there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            flat, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            size = np.diff(starts)
            shapes = np.stack([draws[k][there].astype(np.int64) for k in "hwc"], axis=1) if len(there) else np.zeros((0, 3), np.int64)
            wrong = np.flatnonzero(shapes.prod(axis=1) != size[there])
            if len(wrong):
                raise ValueError(f"image of {tuple(shapes[wrong[0]].tolist())} expected, not of {size[there][wrong[0]]} values")
            out = np.empty(int(size[there].sum()))
            place = np.cumsum(size * column.is_valid().to_numpy(zero_copy_only=False)) - size
            for shape in np.unique(shapes, axis=0):
                group = there[(shapes == shape).all(axis=1)]
                cells = int(shape.prod())
                for part in np.array_split(group, 1 + len(group) * cells // CHUNK_CELLS):
                    if len(part) and cells:
                        index = np.arange(cells)[None, :]
                        x = flat[starts[part][:, None] + index].reshape(len(part), *shape)
                        y = _changed(x, {k: d[part] for k, d in draws.items()}, steps)
                        out[place[part][:, None] + index] = y.reshape(len(part), cells)
            ends = np.concatenate(([0], np.cumsum(size * column.is_valid().to_numpy(zero_copy_only=False)))).astype(np.int32)
            mask = None if len(there) == len(column) else pa.array(~column.is_valid().to_numpy(zero_copy_only=False))
            new = pa.ListArray.from_arrays(pa.array(ends), pa.array(out), mask=mask)
            columns = list(batch.columns[:-1])
            columns[at] = new
            yield pa.RecordBatch.from_arrays(columns, names=names_out)

    names_out = df.columns
    schema = StructType(list(rows.drop("__draws").schema.fields))
    schema[at].dataType = ArrayType(DoubleType())
    return rows.mapInArrow(run, schema)
