"""Moments of vector columns and the Frechet distance between two sets of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.operators.joins import kept

HELD_CELLS = 1 << 25  # sums a task holds before it hands all of them on: 256 MB


def mean_vector(df: DataFrame, vec: str) -> DataFrame:
    """(pos, mean) of a vector column."""
    v = array_to_vector(F.col(vec).cast("array<double>"))
    mean = df.agg(Summarizer.mean(v).alias("m"))
    return mean.select(F.posexplode(vector_to_array("m")).alias("pos", "mean"))


def group_moments(df: DataFrame, vec: str, group: str | None = None) -> DataFrame:
    """(grp, i, j, s, n): sums of centred products for i <= j, centred sums at j = -1, and the
    row count; all relative to the overall mean, whose i-th entry comes as column ``c``.

    Each task adds up one upper triangle per group and hands on only those cells, so the
    shuffle grows with tasks x groups x dimensions squared and not with the rows, as long as
    the groups of a task fit into ``HELD_CELLS``; else it hands on what it holds and goes on.
    """
    key = F.lit("").alias("grp") if group is None else F.col(group).cast("string").alias("grp")
    rows = df.select(key, F.col(vec).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    centre = [r["mean"] for r in mean_vector(rows, "v").orderBy("pos").collect()]
    dim = len(centre)
    c = np.array(centre)

    def cells(name, state):
        n, s, gram = state
        ii, jj = np.triu_indices(dim)
        cell_i = np.concatenate([ii, np.arange(dim)]).astype("int32")
        cell_j = np.concatenate([jj, np.full(dim, -1)]).astype("int32")
        values = pa.array(np.concatenate([gram[ii, jj], s]))
        names, counts = pa.array([name] * len(values), pa.string()), pa.array([n] * len(values), pa.int64())
        return pa.RecordBatch.from_arrays([names, pa.array(cell_i), pa.array(cell_j), values, counts], ["grp", "i", "j", "s", "n"])

    def partial(batches):
        held: dict = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) - c
            codes, names = pd.factorize(batch.column(0).to_pandas(), use_na_sentinel=False)
            for g, name in enumerate(names):
                y = x[codes == g]
                name = None if pd.isna(name) else name
                n, s, gram = held.get(name, (0, 0.0, 0.0))
                held[name] = (n + len(y), s + y.sum(axis=0), gram + y.T @ y)
                if len(held) * dim * (dim + 1) > HELD_CELLS:
                    while held:
                        yield cells(*held.popitem())
        for name, state in held.items():
            yield cells(name, state)

    cells_of = rows.mapInArrow(partial, "grp string, i int, j int, s double, n bigint").groupBy("grp", "i", "j")
    return cells_of.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).withColumn("c", F.get(_constant(centre), F.col("i")))


def _constant(values: list[float]):
    return F.expr("array(" + ", ".join(f"{v!r}D" for v in values) + ")")


def _unpack(cells: pd.DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Cells of one group -> count, mean, sample covariance."""
    i, j, s = (cells[k].to_numpy() for k in ("i", "j", "s"))
    n = float(cells["n"].iloc[0])
    at = j == -1
    order = np.argsort(i[at])
    shift, centre = s[at][order], cells["c"].to_numpy()[at][order]
    gram = np.zeros((len(shift), len(shift)))
    pair = j >= 0
    gram[i[pair], j[pair]] = s[pair]
    gram[j[pair], i[pair]] = s[pair]
    with np.errstate(all="ignore"):
        cov = (gram - np.outer(shift, shift) / n) / (n - 1.0)
    return int(n), centre + shift / n, cov


def covariance_matrix(df: DataFrame, vec: str) -> DataFrame:
    """Sample covariance in long form (i, j, cov) for all i and j; NaN for a single row."""
    sums = group_moments(df, vec).where(F.col("j") >= 0)
    cov = sums.select("i", "j", F.coalesce(F.try_divide(F.col("s"), F.col("n") - F.lit(1.0)), F.lit(float("nan"))).alias("cov"))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j", "cov"))).otherwise(
        F.array(F.struct("i", "j", "cov"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), F.col("cov")))
    )
    return cov.select(F.inline(both))


def frechet(mu1: np.ndarray, cov1: np.ndarray, mu2: np.ndarray, cov2: np.ndarray) -> float:
    """|mu1 - mu2|^2 + tr cov1 + tr cov2 - 2 tr sqrt(cov1 cov2) of two small moment sets.

    With R the symmetric root of cov1, the last trace is that of the root of R cov2 R, which is
    symmetric and has no negative eigenvalues beyond rounding, also for singular covariances.
    """
    gap = np.atleast_1d(mu1) - np.atleast_1d(mu2)
    cov1, cov2 = np.atleast_2d(cov1), np.atleast_2d(cov2)
    if cov1.shape != cov2.shape:
        raise ValueError("the two sets differ in their dimensions")
    if not np.isfinite([cov1, cov2]).all():
        raise ValueError("covariances are not finite: a set has fewer than two rows")
    values, axes = np.linalg.eigh(cov1)
    root = (axes * np.sqrt(np.clip(values, 0.0, None))) @ axes.T
    spectrum = np.linalg.eigvalsh(root @ cov2 @ root)
    return float(gap @ gap + np.trace(cov1) + np.trace(cov2) - 2.0 * np.sqrt(np.clip(spectrum, 0.0, None)).sum())


def frechet_distance(first: DataFrame, second: DataFrame, vec: str) -> DataFrame:
    """One row (n1, n2, distance); only two moment sets reach the driver."""
    both = first.select(F.lit("1").alias("__set"), vec).unionByName(second.select(F.lit("2").alias("__set"), vec))
    cells = group_moments(both, vec, "__set").toPandas()
    (n1, mu1, cov1), (n2, mu2, cov2) = (_unpack(cells[cells["grp"] == g]) for g in ("1", "2"))
    value = frechet(mu1, cov1, mu2, cov2)
    return first.sparkSession.createDataFrame([(n1, n2, value)], "n1 bigint, n2 bigint, distance double")


def frechet_by_class(df: DataFrame, vec: str, group: str) -> DataFrame:
    """(grp, n, distance) of each group to all rows together.

    Moments of all groups in one pass; the small matrices are compared in the tasks, one
    group each, against the moments of the whole, which are the sums over the groups.
    """
    cells = kept(group_moments(df, vec, group))  # used twice
    whole = cells.groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.first("c").alias("c")).toPandas()
    _, mu, cov = _unpack(whole)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        n, m, s = _unpack(pdf)
        value = frechet(m, s, mu, cov) if n > 1 else float("nan")
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "n": [n], "distance": [value]})

    return cells.groupBy("grp").applyInPandas(compare, "grp string, n bigint, distance double")


def frechet_parts(first: DataFrame, second: DataFrame, vec: str) -> DataFrame:
    """Squared distance of the means and both covariance traces, without a driver step."""

    def stats(df, name):
        v = array_to_vector(F.col(vec).cast("array<double>"))
        row = df.agg(Summarizer.metrics("mean", "variance").summary(v).alias("s"))
        return row.select(F.lit(name).alias("set"), F.posexplode(F.arrays_zip(vector_to_array("s.mean").alias("m"), vector_to_array("s.variance").alias("v"))).alias("pos", "z"))

    rows = stats(first, 1).unionByName(stats(second, 2)).groupBy("pos").agg(
        F.sum(F.when(F.col("set") == 1, F.col("z.m")).otherwise(-F.col("z.m"))).alias("gap"),
        F.sum(F.when(F.col("set") == 1, F.col("z.v"))).alias("v1"),
        F.sum(F.when(F.col("set") == 2, F.col("z.v"))).alias("v2"),
    )
    return rows.agg(
        F.sum(F.col("gap") * F.col("gap")).alias("mean_gap"), F.sum("v1").alias("trace_1"), F.sum("v2").alias("trace_2")
    )
