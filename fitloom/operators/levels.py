"""One-hot encoding for any number of levels: a table of levels and sparse rows, no column per level."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.operators.joins import attach_by_key, kept
from fitloom.operators.rank import ordered_rank


def _text(df: DataFrame, col: str) -> Column:
    """A cell as text that is the same for equal cells; NaN counts as missing."""
    kind, cell = dict(df.dtypes)[col], F.col(f"`{col}`")
    if kind in ("double", "float"):
        return F.nanvl(cell + F.lit(0.0).cast(kind), F.lit(None).cast(kind)).cast("string")  # the sum has no negative zero
    return F.hex(cell) if kind == "binary" else cell.cast("string")


def _cells(df: DataFrame, cols: list[str], ids: list[str]) -> DataFrame:
    """One row (ids, __place, __level) per column and row of ``df`` that has a value there."""
    cells = F.array(*[F.struct(F.lit(i).alias("place"), _text(df, c).alias("level")) for i, c in enumerate(cols)])
    cell = df.select(*[F.col(f"`{c}`") for c in ids], F.explode(cells).alias("__cell"))
    return cell.select(*[F.col(f"`{c}`") for c in ids], F.col("__cell.place").alias("__place"), F.col("__cell.level").alias("__level")).where("__level is not null")


@dataclass(frozen=True)
class LevelIndex:
    """Fitted encoding: ``table`` (__place, __level, index) without each column's first level; ``widths`` per column.

    Columns follow each other in the vector; an index is 0-based over all of them.
    """

    columns: list[str]
    table: DataFrame
    widths: list[int]

    @property
    def size(self) -> int:
        return sum(self.widths)

    def rows(self, df: DataFrame, ids: list[str], **options) -> DataFrame:
        """(ids, index) for each one in the encoded rows; missing, first and unseen levels have none."""
        found = attach_by_key(_cells(df, self.columns, ids), self.table, ["__place", "__level"], ids, "inner", **options)
        return found.select(*[F.col(f"`{c}`") for c in ids], "index")

    def vectors(self, df: DataFrame, ids: list[str]) -> DataFrame:
        """(ids, size, indices) per row of ``df``, whose ``ids`` are unique: the sorted places of the ones, at most one per column."""
        ones = self.rows(df, ids).groupBy(*ids).agg(F.sort_array(F.collect_list("index")).alias("indices"))
        empty = F.array().cast("array<bigint>")
        return df.select(*[F.col(f"`{c}`") for c in ids]).join(ones, ids, "left").select(
            *[F.col(f"`{c}`") for c in ids], F.lit(self.size).cast("bigint").alias("size"), F.coalesce("indices", empty).alias("indices")
        )

    def names(self) -> DataFrame:
        """(column, level, index) of every place in the vector."""
        column = F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("__place") + 1)
        return self.table.select(column.alias("column"), F.col("__level").alias("level"), "index")


def level_index(df: DataFrame, cols: list[str]) -> LevelIndex:
    """Sorted levels of each column without the first, numbered on the cluster whatever their number.

    Levels sort by their own type, missing cells are none. Equal levels are combined before the shuffle and ranked
    by ranges; only one count per column reaches the driver.
    """
    kinds, found = dict(df.dtypes), None
    for kind in dict.fromkeys(kinds[c] for c in cols):
        each = [F.struct(F.lit(i).alias("place"), F.col(f"`{c}`").alias("value"), _text(df, c).alias("level")) for i, c in enumerate(cols) if kinds[c] == kind]
        cells = df.select(F.inline(F.array(*each))).where("level is not null")
        once = cells.groupBy("place", "level").agg(F.min("value").alias("value"))
        ranked = ordered_rank(once, ["value", "level"], by=("place",)).select("place", "level", "rank")
        found = ranked if found is None else found.unionByName(ranked)
    found = kept(found)
    most = {r["place"]: r["most"] for r in found.groupBy("place").agg(F.max("rank").alias("most")).collect()}
    widths = [max(most.get(i, 0) - 1, 0) for i in range(len(cols))]
    before = F.element_at(F.array(*[F.lit(sum(widths[:i])).cast("bigint") for i in range(len(cols))]), F.col("place") + 1)
    table = found.where("rank > 1").select(F.col("place").alias("__place"), F.col("level").alias("__level"), (F.col("rank") - 2 + before).alias("index"))
    return LevelIndex(list(cols), table, widths)
