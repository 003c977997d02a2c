"""Expressions over array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fitloom.functions.hashing import gaussian_vector, let


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def total(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x)


def pad_right(vec: Column, length: Column, value: float = 0.0) -> Column:
    """Append ``value`` up to ``length``; longer arrays stay whole."""
    missing = F.greatest(length.cast("int") - F.size(vec), F.lit(0))
    return F.concat(vec, F.array_repeat(F.lit(float(value)), missing))


def last_index(vec: Column) -> Column:
    return F.size(vec) - 1


def gather(vec: Column, index: Column) -> Column:
    """Entry at a 0-based index, NULL outside the array."""
    return F.get(vec, index)


def argmax(vec: Column) -> Column:
    """0-based place of the largest entry, the first one on ties."""
    return let(vec, lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("int"))


def log_sum_exp(vec: Column) -> Column:
    def shifted(v):
        return let(
            F.array_max(v),
            lambda peak: peak + F.ln(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + F.exp(x - peak))),
        )

    return let(vec, shifted)


def softmax(vec: Column) -> Column:
    """Row-wise softmax, shifted by the maximum so that exp never overflows."""
    return let(vec, lambda v: let(log_sum_exp(v), lambda norm: F.transform(v, lambda x: F.exp(x - norm))))


def reshape(vec: Column, rows: int, width: int) -> Column:
    """Cut a flat vector into ``rows`` arrays of ``width``."""
    starts = F.sequence(F.lit(1), F.lit((rows - 1) * width + 1), F.lit(width))
    return let(vec, lambda v: F.transform(starts, lambda r: F.slice(v, r, F.lit(width))))


def flatten_vector(nested: Column, depth: int = 1) -> Column:
    for _ in range(depth):
        nested = F.flatten(nested)
    return nested


def forward_noise(vec: Column, keep: Column, spread: Column, noise: Column) -> Column:
    """keep * x + spread * noise, entry by entry."""
    return F.zip_with(vec, noise, lambda x, e: keep * x + spread * e)


def gaussian_sample(mean: Column, log_var: Column, noise: Column) -> Column:
    """mean + exp(log_var / 2) * noise, entry by entry."""
    spread = F.zip_with(log_var, noise, lambda lv, e: F.exp(F.lit(0.5) * lv) * e)
    return F.zip_with(mean, spread, lambda m, s: m + s)


def unit_noise(row_id: Column, like: Column, seed: int) -> Column:
    """Standard normals, as many as ``like`` has entries."""
    return gaussian_vector(row_id, F.size(like), seed)


def l1_sum(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def l2_sum(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def kl_to_unit_normal(mean: Column, log_var: Column) -> Column:
    """-1/2 * sum(1 + lv - m^2 - exp(lv)) of one row."""
    inner = F.zip_with(mean, log_var, lambda m, lv: F.lit(1.0) + lv - m * m - F.exp(lv))
    return F.lit(-0.5) * total(inner)


def cross_entropy(logits: Column, label: Column) -> Column:
    """-log softmax(logits)[label] of one row."""
    return log_sum_exp(logits) - F.get(logits, label)
