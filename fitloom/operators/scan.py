"""Running values over a whole ordered table, without a task that sees all of it.

Rows are cut into ranges of the order; each range gives a few partial values, these are carried from range to
range (one small row per range), and every range is then finished by itself.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.session import shared_dir


def _cut(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with its range as ``__range``, kept by a checkpoint: both readings must see the same ranges."""
    shared_dir(df.sparkSession)
    return df.repartitionByRange(*[F.col(f"`{c}`") for c in order]).withColumn("__range", F.spark_partition_id()).checkpoint()


def _with_carry(cut: DataFrame, carry: list[tuple], kinds: str) -> DataFrame:
    """What comes before each range beside its rows; one row per range is sent."""
    table = cut.sparkSession.createDataFrame(carry, f"__range int, {kinds}")
    return cut.join(F.broadcast(table), "__range", "left")


def running_product(df: DataFrame, col: str, order: str | list[str], out: str = "product") -> DataFrame:
    """Cumulative product in ``order``, which should tell all rows apart (rows that tie come in any order).

    A zero makes all that follows zero and every negative factor turns the sign. Missing factors are passed over; before the first
    known one the product is NULL. Magnitudes are summed as logarithms, so that long products do not
    overflow on the way. An empty table stays empty.
    """
    order = [order] if isinstance(order, str) else order
    cut = _cut(df, order)
    x = F.col(f"`{col}`").cast("double")
    cells = {"__log": F.when(x != 0, F.ln(F.abs(x))), "__zero": (x == 0).cast("int"), "__minus": (x < 0).cast("int"), "__known": x.isNotNull().cast("int")}
    parts = cut.withColumns(cells).groupBy("__range").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in cells])
    carry, before = [], [0.0] * 4
    for r in sorted(parts.collect(), key=lambda r: r["__range"]):  # one row per range
        carry.append((r["__range"], *before))
        before = [a + r[c] for a, c in zip(before, cells)]
    names = [f"{c}_before" for c in cells]
    inside = W.partitionBy("__range").orderBy(*[F.col(f"`{c}`") for c in order]).rowsBetween(W.unboundedPreceding, 0)
    so_far = [F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(n) for v, n in zip(cells.values(), names)]
    log, zeros, minus, known = so_far
    value = F.when(zeros > 0, F.lit(0.0)).otherwise(F.exp(log) * F.when(minus % 2 == 1, -1.0).otherwise(1.0))
    done = _with_carry(cut, carry, ", ".join(f"{n} double" for n in names))
    return done.withColumn(out, F.when(known > 0, value)).drop("__range", *names)


def shift_with_default(df: DataFrame, col: str, order: str | list[str], default: float, out: str = "previous") -> DataFrame:
    """Value of the row before in ``order`` (which should tell all rows apart), ``default`` for the first row.

    A missing value is handed on as it is. An empty table stays empty.
    """
    order = [order] if isinstance(order, str) else order
    cut = _cut(df, order)
    kind = dict(df.dtypes)[col]
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    cell = F.struct(F.col(f"`{col}`").alias("v"))
    lasts = cut.groupBy("__range").agg(F.max_by(cell, place).alias("last"))
    carry, before = [], None
    for r in sorted(lasts.collect(), key=lambda r: r["__range"]):  # one row per range
        carry.append((r["__range"], before))
        before = (r["last"]["v"],)
    inside = W.partitionBy("__range").orderBy(*[F.col(f"`{c}`") for c in order])
    done = _with_carry(cut, carry, f"__before struct<v: {kind}>")
    last = F.coalesce(F.lag(cell).over(inside), F.col("__before"))
    return done.withColumn(out, F.when(last.isNull(), F.lit(default).cast(kind)).otherwise(last["v"])).drop("__range", "__before")
