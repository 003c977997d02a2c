"""Linear fits by a few rounds of sums: every round is one aggregate over the rows, solved for a handful of coefficients."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RIDGE = 1e-12


@dataclass(frozen=True)
class Linear:
    """``intercept`` and one coefficient per column."""

    columns: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]

    def value(self) -> Column:
        """The linear form over the columns of a table."""
        out = F.lit(self.intercept)
        for c, b in zip(self.columns, self.coefficients):
            out = out + F.col(f"`{c}`").cast("double") * F.lit(b)
        return out

    def table(self, df: DataFrame) -> DataFrame:
        """(term, value) as rows."""
        rows = [("intercept", self.intercept), *zip(self.columns, self.coefficients)]
        return df.sparkSession.createDataFrame(rows, "term string, value double")


def _sums(rows: DataFrame, width: int, weigh: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Sums of w x x' and of w x z over rows (x as an array, y, weight); ``weigh(x, y, weight)`` gives w and z of a batch.

    A task leaves width x (width + 1) cells, whatever its rows.
    """

    def run(batches):
        gram = np.zeros((width, width + 1))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            y, weight = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            w, z = weigh(x, y, weight)
            gram += (x * w[:, None]).T @ np.column_stack([x, z])
        i, j = np.indices(gram.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(gram.ravel())], names=["i", "j", "s"])

    cells = rows.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros((width, width + 1))
    out[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["s"].to_numpy()
    return out[:, :-1], out[:, -1]


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solution of the normal equations; columns without any variation get zero."""
    scale = np.sqrt(np.diag(a))
    scale[scale == 0] = 1.0
    return np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=RIDGE)[0] / scale


def _rows(df: DataFrame, cols: list[str], target: str, weight: str | None) -> DataFrame:
    """(x, y, w) of the rows without gaps; x begins with 1."""
    x = [F.col(f"`{c}`").cast("double") for c in cols]
    y, w = F.col(f"`{target}`").cast("double"), F.lit(1.0) if weight is None else F.col(f"`{weight}`").cast("double")
    there = y.isNotNull() & ~F.isnan(y) & w.isNotNull()
    for c in x:
        there = there & c.isNotNull() & ~F.isnan(c)
    return df.where(there).select(F.array(F.lit(1.0), *x).alias("x"), y.alias("y"), w.alias("w"))


def fit_l1_linear(df: DataFrame, cols: list[str], target: str, weight: str | None = None, rounds: int = 20, least: float = 1e-3) -> Linear:
    """Least absolute deviations: least squares over and over, each row weighted by one over its last error (``least`` at least).

    ``rounds`` passes over ``df`` after a first plain one; persist a costly input. Rows with a gap in any used column
    take no part; without rows all coefficients are zero.
    """
    rows, beta = _rows(df, cols, target, weight), None
    for _ in range(rounds + 1):
        now = beta

        def weigh(x, y, w, now=now):
            return (w if now is None else w / np.maximum(np.abs(y - x @ now), least)), y

        beta = _solve(*_sums(rows, len(cols) + 1, weigh))
    return Linear(tuple(cols), float(beta[0]), tuple(float(b) for b in beta[1:]))


def fit_weighted_logistic(df: DataFrame, cols: list[str], target: str, weight: str | None = None, rounds: int = 8, penalty: float = 0.0) -> Linear:
    """Logistic regression of a 0/1 ``target`` by Newton's method, rows weighted by ``weight``; ``value()`` is the log-odds.

    Every round is one pass; ``penalty`` holds the coefficients (not the intercept) of separable classes down. Gaps as in ``fit_l1_linear``.
    """
    rows, width = _rows(df, cols, target, weight), len(cols) + 1
    beta, hold = np.zeros(width), np.diag([0.0, *[penalty] * len(cols)])
    for _ in range(rounds):

        def weigh(x, y, w, now=beta):
            p = 1.0 / (1.0 + np.exp(-np.clip(x @ now, -30.0, 30.0)))
            v = np.maximum(p * (1.0 - p), 1e-12)
            return w * v, x @ now + (y - p) / v

        a, b = _sums(rows, width, weigh)
        beta = _solve(a + hold, b)
    return Linear(tuple(cols), float(beta[0]), tuple(float(b) for b in beta[1:]))
