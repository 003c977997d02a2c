"""Column selection, one-hot encoding, scaling and assembling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.functions.classes import known

MAX_LEVELS = 10_000


def select_target_features(df: DataFrame, target: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Target first, then all predictors but the dropped ones."""
    keep = [c for c in df.columns if c != target and c not in drop]
    return df.select(F.col(f"`{target}`"), *[F.col(f"`{c}`") for c in keep])


def filter_by_class(df: DataFrame, label: str, value, cols: list[str]) -> DataFrame:
    return df.where(F.col(label) == F.lit(value)).select(*cols)


def one_hot_levels(df: DataFrame, cols: list[str]) -> dict[str, list]:
    """Sorted levels of each column without the first; the fitted state of one-hot encoding.

    Columns of one type are read in one scan; repeated levels are combined before the shuffle.
    """
    kinds = dict(df.dtypes)
    levels: dict[str, list] = {}
    for kind in dict.fromkeys(kinds[c] for c in cols):
        named = [c for c in cols if kinds[c] == kind]
        cell = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("v")) for i, c in enumerate(named)]))
        found = df.select(cell.alias("c")).select("c.i", "c.v").where(F.col("v").isNotNull()).distinct()
        rows = found.limit(len(named) * MAX_LEVELS + 1).collect()
        for i, c in enumerate(named):
            values = sorted(r["v"] for r in rows if r["i"] == i)
            if len(values) > MAX_LEVELS or len(rows) > len(named) * MAX_LEVELS:
                raise ValueError(f"{named} have more than {MAX_LEVELS} levels: use level_index, which has no columns per level")
            levels[c] = values[1:]
    return {c: levels[c] for c in cols}


def one_hot_apply(df: DataFrame, levels: dict[str, list]) -> DataFrame:
    """``<col>_<level>`` columns of 0.0 / 1.0 after the kept ones; NULL or unseen is all 0."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in levels]
    dummies = [
        F.when(F.col(f"`{c}`") == F.lit(v), 1.0).otherwise(0.0).alias(f"{c}_{v}") for c, vs in levels.items() for v in vs
    ]
    return df.select(*kept, *dummies)


@dataclass(frozen=True)
class Scaler:
    """Fitted means and population deviations; a constant column keeps deviation 1."""

    mean: dict[str, float]
    std: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        """Scale the fitted columns, leave all others."""
        scaled = {
            c: (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(self.std[c]) for c, m in self.mean.items()
        }
        return df.withColumns(scaled)


def scale_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, mean, std) of each column, one pass."""
    aggs = []
    for i, c in enumerate(cols):
        v = known(F.col(f"`{c}`"))
        sd = F.stddev_pop(v)
        aggs.append(F.struct(F.lit(c).alias("column"), F.avg(v).alias("mean"), F.when(sd == 0, 1.0).otherwise(sd).alias("std")).alias(f"r{i}"))
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(cols))])))


def standard_scale_fit(df: DataFrame, cols: list[str]) -> Scaler:
    rows = scale_table(df, cols).collect()  # one row per column
    return Scaler({r["column"]: r["mean"] for r in rows}, {r["column"]: r["std"] for r in rows})


def assemble_features(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """All columns in frame order as one array."""
    return df.withColumn(out, _vector(cols))


def split_num_cat(df: DataFrame, num: list[str], cat: list[str]) -> DataFrame:
    """Numeric and encoded categorical columns as two arrays beside the others."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in num and c not in cat]
    return df.select(*rest, _vector(num).alias("num"), _vector(cat).alias("cat"))


def _vector(cols: list[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
