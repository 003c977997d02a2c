"""Counts, moments, exact quantiles and histograms."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.functions.classes import known

BINS = 4096
FEW = 4096
QUARTILES = [0.25, 0.5, 0.75]


def _long(row: DataFrame, records: list[Column]) -> DataFrame:
    """One-row aggregate -> one row per record."""
    return row.select(F.inline(F.array(*records)))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float]]:
    """Quantiles with linear interpolation, NULL and NaN left out.

    The interval that holds a wanted order statistic is cut into bins again and again: by
    sign and binary exponent while it is wide, into equal parts within a power of four. So any
    doubles take at most eight passes, each one scan with a small count per bin, and nothing
    is sorted or collected but the last few values. An empty column gives NaN.
    """
    values = df.select(*[known(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(cols)])
    first = []
    for i in range(len(cols)):
        v = F.col(f"v{i}")
        finite = F.when(F.abs(v) < F.lit(math.inf), v)
        first += [
            F.count(v).alias(f"n{i}"), F.count_if(v == -math.inf).alias(f"neg{i}"),
            F.count_if(v == math.inf).alias(f"pos{i}"), F.min(finite).alias(f"min{i}"), F.max(finite).alias(f"max{i}"),
        ]
    head = values.agg(*first).first().asDict()
    found: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], tuple[float, float, int]] = {}
    for i in range(len(cols)):
        n = head[f"n{i}"]
        for p in probs if n else []:
            for r in {math.floor((n - 1) * p), math.ceil((n - 1) * p)}:
                if r < head[f"neg{i}"]:
                    found[i, r] = -math.inf
                elif r >= n - head[f"pos{i}"]:
                    found[i, r] = math.inf
                elif head[f"min{i}"] == head[f"max{i}"]:
                    found[i, r] = head[f"min{i}"]
                else:
                    open_[i, r] = (head[f"min{i}"], head[f"max{i}"], head[f"neg{i}"])
    few: dict[tuple[int, int], tuple[float, float, int]] = {}
    while open_:
        spans = sorted({(i, *span) for (i, _), span in open_.items()})
        bins = _bin_counts(df, cols, spans)
        wanted, open_ = open_, {}
        for (i, r), span in wanted.items():
            below = span[2]
            for n, lo, hi in bins[i, *span]:
                if r < below + n:
                    break
                below += n
            if lo == hi:
                found[i, r] = lo
            elif n <= FEW:
                few[i, r] = (lo, hi, below)
            else:
                open_[i, r] = (lo, hi, below)
    if few:
        spans = sorted({(i, *span) for (i, _), span in few.items()})
        rows = _inside(df, cols, spans).select("s", "v").collect()
        inside = {s: sorted(r["v"] for r in rows if r["s"] == j) for j, s in enumerate(spans)}
        for (i, r), span in few.items():
            found[i, r] = inside[i, *span][r - span[2]]
    out = {}
    for i, c in enumerate(cols):
        n = head[f"n{i}"]
        out[c] = []
        for p in probs:
            at = (n - 1) * p
            lo, hi = (found[i, math.floor(at)], found[i, math.ceil(at)]) if n else (math.nan, math.nan)
            out[c].append(lo if lo == hi else lo + (hi - lo) * (at - math.floor(at)))
    return out


def _raw(name: str) -> Column:
    return F.col(f"`{name}`").cast("double")


def _place(v: Column, lo: float, hi: float) -> Column:
    """Bin of a value within [lo, hi]; a larger value never gets a smaller bin."""
    if 0 < lo and hi <= 4 * lo or hi < 0 and lo >= 4 * hi:
        return F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(BINS))), F.lit(BINS - 1)).cast("int")
    size = (F.floor(F.log2(F.abs(v))) + F.lit(1100)).cast("int")  # the least exponent is -1074
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)


def _inside(df: DataFrame, cols: list[str], spans: list[tuple]) -> DataFrame:
    """(s, b, v) of the values in each span (column, lo, hi, below) with their bins; one scan for all."""
    values = df.select(*[_raw(c).alias(f"v{i}") for i, c in enumerate(cols)])
    cells = []
    for j, (i, lo, hi, _) in enumerate(spans):
        v = F.col(f"v{i}")
        cells.append(F.when(v.between(lo, hi), F.struct(F.lit(j).alias("s"), _place(v, lo, hi).alias("b"), v.alias("v"))))
    return values.select(F.inline_outer(F.array(*cells))).where(F.col("s").isNotNull())


def _bin_counts(df: DataFrame, cols: list[str], spans: list[tuple]) -> dict[tuple, list[tuple]]:
    """Per span: (count, min, max) of its non-empty bins in order."""
    counted = _inside(df, cols, spans).groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    out: dict[tuple, list[tuple]] = {s: [] for s in spans}
    for r in sorted(counted.collect(), key=lambda r: (r["s"], r["b"])):
        out[spans[r["s"]]].append((r["n"], r["lo"], r["hi"]))
    return out


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max of each numeric column."""
    q = exact_quantiles(df, cols, QUARTILES)
    aggs, records = [], []
    for i, c in enumerate(cols):
        v = known(F.col(f"`{c}`"))
        aggs.append(
            F.struct(
                F.lit(c).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"), *[F.lit(x).alias(f"p{round(p * 100)}") for p, x in zip(QUARTILES, q[c])], F.max(v).alias("max"),
            ).alias(f"r{i}")
        )
        records.append(F.col(f"r{i}"))
    return _long(df.agg(*aggs), records)


def null_count(df: DataFrame) -> DataFrame:
    """Missing values per column, NaN included, and their total as column ``*``."""
    kinds = dict(df.dtypes)

    def missing(c):
        col = F.col(f"`{c}`")
        return col.isNull() | F.isnan(col) if kinds[c] in ("double", "float") else col.isNull()

    row = df.agg(*[F.count_if(missing(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    n = [F.col(f"n{i}") for i in range(len(df.columns))]
    records = [F.struct(F.lit(c).alias("column"), x.alias("nulls")) for c, x in zip(df.columns, n)]
    everything = F.struct(F.lit("*").alias("column"), sum(n[1:], n[0]).alias("nulls"))
    return _long(row, [*records, everything])


PIVOT_ROWS = 1000
PAIR_CELLS = 1 << 20
FLAT = 1e-13


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of all column pairs in long form (a, b, corr), over the rows that have both; NaN if undefined.

    One pass: each task adds up matrix products of its rows and of the mask of known cells, and leaves one row per pair.
    Values are taken from a pivot, a value of the column itself, so that large means do not
    swallow small deviations. The plan grows with the columns, not with their pairs.
    """
    d = len(cols)
    x = df.select(*[known(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(cols)])
    pivot = x.limit(PIVOT_ROWS).agg(*[F.first(c, ignorenulls=True).alias(c) for c in x.columns]).first()
    pivot = [v if v is not None and math.isfinite(v) else 0.0 for v in pivot]
    rows = x.select(F.array(*[F.col(c) - F.lit(v) for c, v in zip(x.columns, pivot)]).alias("v"))
    i, j = np.triu_indices(d)

    def run(batches):
        sums = np.zeros((4, d, d))
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            for v in np.array_split(flat.reshape(-1, d), 1 + len(flat) // PAIR_CELLS):
                mask = ~np.isnan(v)
                v, m = np.where(mask, v, 0.0), mask.astype(np.float64)
                sums += m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v
        n, s, q, p = sums
        values = [n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], p[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (i.astype(np.int32), j.astype(np.int32), *values)], names=["i", "j", *names])

    names = ["n", "x", "y", "xx", "yy", "xy"]
    cells = rows.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in names))
    cells = cells.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names])
    vx, vy = F.col("xx") - F.col("x") * F.col("x") / F.col("n"), F.col("yy") - F.col("y") * F.col("y") / F.col("n")
    level = (vx <= F.col("xx") * FLAT) | (vy <= F.col("yy") * FLAT)  # rounding alone
    corr = F.when((F.col("n") > 0) & ~level, (F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / F.sqrt(vx * vy)).otherwise(F.lit(math.nan))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    of = F.array(*[F.lit(c) for c in cols])
    pairs = cells.select(F.explode(both).alias("c"), corr.alias("corr"))
    return pairs.select(F.element_at(of, F.col("c.i") + 1).alias("a"), F.element_at(of, F.col("c.j") + 1).alias("b"), "corr")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_percent(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent of all rows per class."""
    counts = class_counts(df, label)
    total = counts.agg(F.sum("n").cast("double")).scalar()
    return counts.withColumn("percent", F.col("n") * F.lit(100.0) / total)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Inverse class frequency, keyed by the class itself."""
    return class_counts(df, label).select(label, (F.lit(1.0) / F.col("n")).alias("weight"))


def sorted_class_counts(df: DataFrame, label: str) -> DataFrame:
    """Largest class first, equal counts by class."""
    return class_counts(df, label).orderBy(F.desc("n"), label)


def distribution_profile(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Quartiles of one column, repeated beside its histogram of equal-width bins."""
    lo, q1, q2, q3, hi = exact_quantiles(df, [col], [0.0, *QUARTILES, 1.0])[col]
    width = (hi - lo) / bins
    v = known(F.col(f"`{col}`"))
    place = F.floor((v - F.lit(lo)) / F.lit(width)) if width > 0 else F.lit(0)
    return (
        df.where(v.isNotNull()).groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(col).alias("column"), F.lit(q1).alias("q1"), F.lit(q2).alias("median"), F.lit(q3).alias("q3"), "bin", "n")
    )


def max_sequence_length(df: DataFrame, owner: str) -> DataFrame:
    """Most rows of one owner; the sequences themselves are not built."""
    return df.groupBy(owner).count().agg(F.max("count").alias("max_len"))


def class_amount(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.countDistinct(label).alias("classes"))


def list_columns(df: DataFrame) -> DataFrame:
    """Place, name and type of each column, with its number of non-null values."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    records = [
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"n{i}").alias("n"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return _long(row, records)


def epoch_loss(df: DataFrame, epoch: Column, loss: str, per: float = 2000.0) -> DataFrame:
    """Mean and sum of the batch losses of each epoch, and the sum over a fixed number."""
    return df.groupBy(epoch.alias("epoch")).agg(
        F.avg(loss).alias("mean_loss"), F.sum(loss).alias("sum_loss"), (F.sum(loss) / F.lit(per)).alias("scaled_loss")
    )
