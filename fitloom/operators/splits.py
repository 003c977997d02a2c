"""Splits of exact size, shuffles and batches.

A split needs only the row at the border of each part, so it is two narrow passes over
the ids and then a filter on the data: no row of the data is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.functions.hashing import order_key
from fitloom.operators.joins import attach_by_key
from fitloom.operators.rank import DIGITS, find_cuts, shuffled_rank


def _holdout_rows(n: int, frac: float) -> int:
    return math.ceil(frac * n)


def holdout_split(df: DataFrame, ids: list[str], frac: float, seed: int = 42, names=("train", "holdout"), out: str = "split") -> DataFrame:
    """Mark ceil(frac * n) rows as holdout, the others as train."""
    _, (cut,) = find_cuts(df, ids, seed, lambda n: [_holdout_rows(n, frac)])
    return df.withColumn(out, F.when(cut.holds(), names[1]).otherwise(names[0]))


def three_way_split(df: DataFrame, ids: list[str], frac: float = 0.3, test_frac: float = 0.33, seed: int = 42, out: str = "split") -> DataFrame:
    """Holdout of ceil(frac * n); ceil(test_frac) of it is test, the rest validate."""
    _, (held,) = find_cuts(df, ids, seed, lambda n: [_holdout_rows(n, frac)])
    _, (test,) = find_cuts(df.where(held.holds()), ids, seed + 1, lambda n: [_holdout_rows(n, test_frac)])
    part = F.when(~held.holds(), "train").when(test.holds(), "test").otherwise("validate")
    return df.withColumn(out, part)


def train_fraction_split(df: DataFrame, ids: list[str], frac: float = 0.8, seed: int = 42, out: str = "split") -> DataFrame:
    """floor(frac * n) rows are train, the rest valid."""
    _, (cut,) = find_cuts(df, ids, seed, lambda n: [math.floor(frac * n)])
    return df.withColumn(out, F.when(cut.holds(), "train").otherwise("valid"))


def fraction_sizes(n: int, fractions: list[float]) -> list[int]:
    """floor of each share; rows left over go to the first parts in turn."""
    sizes = [math.floor(n * f) for f in fractions]
    for i in range(n - sum(sizes)):
        sizes[i % len(sizes)] += 1
    return sizes


def fraction_split(df: DataFrame, ids: list[str], fractions: list[float], seed: int = 42, out: str = "part") -> DataFrame:
    """Part number per row; all rows are used, part sizes as in ``fraction_sizes``."""

    def ends(n: int) -> list[int]:
        sizes = fraction_sizes(n, fractions)
        return [sum(sizes[: i + 1]) for i in range(len(sizes) - 1)]

    _, cuts = find_cuts(df, ids, seed, ends)
    part = F.lit(len(fractions) - 1)
    for i in reversed(range(len(cuts))):
        part = F.when(cuts[i].holds(), i).otherwise(part)
    return df.withColumn(out, part)


def stratified_split(df: DataFrame, ids: list[str], label: str, train: float = 0.7, valid: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """Per class: round-half-even shares for train and validate, the rest is test.

    Two passes over ids and labels find each class's two border rows: counts per (class,
    key prefix) name the bucket of a border, and only such buckets are numbered. The data
    itself is read once and compared with the border rows of its class.
    """
    c, b, k = "__class", "__bucket", "__key"
    by_class = W.partitionBy(c)
    keyed = df.select(*ids, _class_text(label).alias(c), order_key(seed, ids).alias(k)).withColumn(b, F.substring(k, 1, DIGITS))
    counts = keyed.groupBy(c, b).count().select(
        c, b, F.col("count"), F.sum("count").over(by_class).alias("n"), F.sum("count").over(by_class.orderBy(b)).alias("end")
    )
    first = F.bround(F.col("n") * F.lit(train), 0).cast("bigint")
    second = first + F.bround(F.col("n") * F.lit(valid), 0).cast("bigint")
    at = F.explode(F.array(F.struct(F.lit(1).alias("which"), first.alias("k")), F.struct(F.lit(2).alias("which"), second.alias("k"))))
    start = F.col("end") - F.col("count")
    borders = (
        counts.withColumn("at", at).where((start < F.col("at.k")) & (F.col("at.k") <= F.col("end")))
        .select(c, b, F.col("at.which").alias("__which"), (F.col("at.k") - start).alias("__m"))
    )  # two rows per class
    place = F.row_number().over(W.partitionBy(c, b, "__which").orderBy(k, *ids))
    found = attach_by_key(keyed, borders, [c, b], ids).withColumn("__place", place).where(F.col("__place") == F.col("__m"))
    row = F.struct(F.col(k).alias("k"), *ids)
    cuts = found.groupBy(c).agg(
        F.max(F.when(F.col("__which") == 1, row)).alias("__cut1"), F.max(F.when(F.col("__which") == 2, row)).alias("__cut2")
    )
    marked = attach_by_key(df.withColumn(c, _class_text(label)), cuts, [c], ids, "left")
    here = F.struct(order_key(seed, ids).alias("k"), *ids)
    part = F.when(here <= F.col("__cut1"), "train").when(here <= F.col("__cut2"), "validate").otherwise("test")
    return marked.withColumn(out, part).select(*df.columns, out)


def _class_text(label: str) -> Column:
    return F.coalesce(F.col(label).cast("string"), F.lit("\x00"))


def index_within_class(df: DataFrame, ids: list[str], label: str, seed: int = 42, out: str = "idx") -> DataFrame:
    """0-based place of each row inside its shuffled class."""
    return shuffled_rank(df, ids, seed, by=(label,), out=out).withColumn(out, F.col(out) - 1)


def reset_index(df: DataFrame, ids: list[str], seed: int = 42, out: str = "idx") -> DataFrame:
    """Fresh consecutive 0-based index in shuffled order."""
    return shuffled_rank(df, ids, seed, out=out).withColumn(out, F.col(out) - 1)


def shuffle_rows(df: DataFrame, ids: list[str], seed: int = 42, epoch: int = 0, out: str = "rank") -> DataFrame:
    """Every epoch has its own order, given as a rank column."""
    return shuffled_rank(df, ids, seed + epoch, out=out)


def assign_batches(df: DataFrame, ids: list[str], size: int, seed: int = 42, drop_last: bool = False, out: str = "batch") -> DataFrame:
    """Batch number in shuffled order; ``drop_last`` leaves out a short last batch."""
    ranked = shuffled_rank(df, ids, seed, out="__rank", total="__rows")
    batch = F.floor((F.col("__rank") - 1) / F.lit(size)).cast("bigint")
    batched = ranked.withColumn(out, batch)
    if drop_last:
        batched = batched.where((F.col(out) + 1) * size <= F.col("__rows"))
    return batched.drop("__rank", "__rows")


def first_batch(df: DataFrame, ids: list[str], size: int, seed: int = 42) -> DataFrame:
    """The rows of batch 0, found by their keys alone."""
    return df.orderBy(order_key(seed, ids), *ids).limit(size)


def cap_rows(df: DataFrame, ids: list[str], k: int, seed: int = 42) -> DataFrame:
    """The first ``k`` rows in seeded order; a negative ``k`` gives none."""
    _, (cut,) = find_cuts(df, ids, seed, lambda n: [k])
    return df.where(cut.holds())


def collate_batches(df: DataFrame, ids: list[str], size: int, collate, schema: str, seed: int = 42, drop_last: bool = False) -> DataFrame:
    """The user's ``collate(pandas frame) -> pandas frame`` on each batch of ``size`` rows."""
    return assign_batches(df, ids, size, seed, drop_last).groupBy("batch").applyInPandas(collate, schema)
