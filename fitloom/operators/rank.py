"""Exact ranks and cut points without sorting a table in one task.

Rows are ordered by an md5 key of their unique id. The first hex digits of the key
spread rows evenly over at most 65,536 buckets, so that counts per bucket are a small
table whatever the size of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.functions.hashing import order_key
from fitloom.session import shared_dir

DIGITS = 4
BUCKETS = 16**DIGITS
SMALL = 10_000


def shuffled_rank(df: DataFrame, ids: list[str], seed: int, by: tuple[str, ...] = (), out: str = "rank", total: str | None = None) -> DataFrame:
    """Add the 1-based rank of each row in seeded order, per class if ``by`` is given; as ``total`` the row count of the order.

    One shuffle of the data on (class, bucket); a class with a third of all rows is
    spread over all its buckets. The offsets are running sums over bucket counts.
    """
    classes = [f"__c{n}" for n in range(len(by))]
    for name, col in zip(classes, by):
        df = df.withColumn(name, F.coalesce(F.col(col).cast("string"), F.lit("\x00")))
    df = df.withColumn("__key", order_key(seed, ids)).withColumn("__bucket", F.substring("__key", 1, DIGITS))
    place = [*classes, "__bucket"]
    before = W.partitionBy(*classes).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*place).count()
        .select(
            *place, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"),
            *([F.sum("count").over(W.partitionBy(*classes)).alias(total)] if total else []),
        )
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most BUCKETS rows
    inside = F.row_number().over(W.partitionBy(*place).orderBy("__key", *ids))
    return (
        df.withColumn("__inside", inside)
        .join(offsets, place)
        .withColumn(out, (F.col("__before") + F.col("__inside")).cast("bigint"))
        .drop("__key", "__before", "__inside", *place)
    )


def ordered_rank(df: DataFrame, order: list[str], by: tuple[str, ...] = (), out: str = "rank") -> DataFrame:
    """Add the 1-based rank in the natural order of ``order``, per group if ``by`` is given.

    Rows are range-partitioned on (group, order), so a hot group is cut into many
    ranges, and kept by a checkpoint: the ranges must be the same for the counting and
    the numbering. Only groups at the border of a range can have rows in other ranges,
    so the offsets hold at most two rows per range.
    """
    shared_dir(df.sparkSession)
    keys = [*by, *order]
    cut = df.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()).checkpoint()
    group = F.struct(F.lit(0).alias("g"), *by)
    sizes = cut.groupBy("__range", group.alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    # a group that crosses a range border is the first or the last one of each range it is in
    inside = W.partitionBy("__range")
    edges = sizes.withColumns({"__lo": F.min("__g").over(inside), "__hi": F.max("__g").over(inside)}).where(
        (F.col("__g") == F.col("__lo")) | (F.col("__g") == F.col("__hi"))
    )
    earlier = W.partitionBy("__g").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = edges.select("__range", "__g", F.sum("__n").over(earlier).alias("__before"))
    numbered = cut.withColumn("__g", group).withColumn(
        "__inside", F.row_number().over(W.partitionBy("__range", *by).orderBy(*order))
    )
    at = (F.col("a.__range") == F.col("b.__range")) & F.col("a.__g").eqNullSafe(F.col("b.__g"))
    joined = numbered.alias("a").join(F.broadcast(offsets.alias("b")), at, "left")  # two rows per range at most
    rank = F.coalesce(F.col("b.__before"), F.lit(0)) + F.col("a.__inside")
    return joined.select(*[F.col(f"a.`{c}`") for c in df.columns], rank.cast("bigint").alias(out))


@dataclass(frozen=True)
class Cut:
    """The row that is ``k``-th in seeded order; ``k == 0`` lies before all rows."""

    seed: int
    ids: tuple[str, ...]
    k: int
    key: str = ""
    row: tuple = ()
    types: tuple[str, ...] = ()

    def holds(self) -> Column:
        """True for the first ``k`` rows: a plain filter, no shuffle."""
        if self.k <= 0:
            return F.lit(False)
        here = F.struct(order_key(self.seed, list(self.ids)).alias("k"), *[F.col(i) for i in self.ids])
        return here <= F.struct(
            F.lit(self.key).alias("k"), *[F.lit(v).cast(t).alias(i) for i, v, t in zip(self.ids, self.row, self.types)]
        )


def find_cuts(df: DataFrame, ids: list[str], seed: int, sizes) -> tuple[int, list[Cut]]:
    """Row count and the rows at the ranks ``sizes(row count)``.

    A first pass counts rows per key prefix; a bucket that holds a cut is refined by
    further digits until few rows are left. Only counts and single keys reach the driver.
    """
    keyed = df.select(*ids, order_key(seed, ids).alias("__key"))
    types = tuple(dict(keyed.dtypes)[i] for i in ids)
    names, ends = _prefix_counts(keyed, "")
    n = int(ends[-1]) if len(ends) else 0
    cuts = []
    for k in sizes(n):
        k = max(0, min(int(k), n))
        if k == 0:
            cuts.append(Cut(seed, tuple(ids), 0))
            continue
        level, level_ends, left = names, ends, k
        while True:
            at = int(np.searchsorted(level_ends, left))
            held = int(level_ends[at]) - (int(level_ends[at - 1]) if at else 0)
            left -= int(level_ends[at - 1]) if at else 0
            prefix = level[at]
            if held <= SMALL or len(prefix) >= 32:
                break
            level, level_ends = _prefix_counts(keyed, prefix)
        row = (
            keyed.where(F.col("__key").startswith(prefix)).orderBy("__key", *ids).offset(left - 1).limit(1).first()
        )
        cuts.append(Cut(seed, tuple(ids), k, row["__key"], tuple(row[i] for i in ids), types))
    return n, cuts


def _prefix_counts(keyed: DataFrame, prefix: str) -> tuple[list[str], np.ndarray]:
    """Sorted prefixes one level below ``prefix`` and running counts; at most BUCKETS rows."""
    if prefix:
        keyed = keyed.where(F.col("__key").startswith(prefix))
    rows = keyed.groupBy(F.substring("__key", 1, len(prefix) + DIGITS).alias("p")).count().toArrow().sort_by("p")
    return rows["p"].to_pylist(), rows["count"].to_numpy().cumsum()
