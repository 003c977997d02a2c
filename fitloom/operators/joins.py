"""Lookups and row-identity joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.operators.rank import ordered_rank
from fitloom.session import shared_dir

HOT_KEYS = 4096
BROADCAST_BYTES = 32 << 20
MAX_LOCAL_CLASSES = 100_000


def kept(table: DataFrame) -> DataFrame:
    """A fitted table, computed once and kept in the shared folder."""
    shared_dir(table.sparkSession)
    return table.checkpoint()


def measured_bytes(table: DataFrame) -> int:
    """Size of a kept table as text, counted on the cluster."""
    return table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def hot_keys(df: DataFrame, on: list[str]) -> DataFrame | None:
    """(__hash, __salts) of the keys of ``df`` that hold more rows than an even share of a task, None if there are none.

    One pass with a sketch of the frequent keys: at most ``HOT_KEYS`` of them, or as many as there are shuffle partitions, can
    hold such a share. Each gets as many salts as its rows are shares.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = min(parts, HOT_KEYS)
    hashed = df.select(F.xxhash64(*on).alias("__hash"))
    row = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(__hash, {most}, {8 * most})").alias("top")).first()
    share = max(row["n"] / parts, 1)
    hot = [(r["item"], -int(-r["count"] // share)) for r in row["top"] or [] if r["count"] > share]
    return spark.createDataFrame(hot, "__hash bigint, __salts int") if hot else None


def attach_by_key(
    df: DataFrame, table: DataFrame, on: list[str], spread: list[str], how: str = "inner", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join a lookup table that has one row per key to a large, possibly skewed table.

    The lookup is computed once and measured. Up to ``limit`` bytes it is broadcast and
    the large table stays where it is. Beyond, both are shuffled on the key; the rows of a key that holds more than
    a task's share are split by their identity ``spread`` into as many parts as it has shares, and
    only the lookup rows of such keys are repeated, once per part.
    """
    table = kept(table)
    if measured_bytes(table) <= limit:
        return df.join(F.broadcast(table), on, how)
    hot = hot_keys(df, on)
    if hot is None:
        return df.join(table, on, how)
    salts = F.coalesce("__salts", F.lit(1))

    def placed(rows):
        return rows.withColumn("__hash", F.xxhash64(*on)).join(F.broadcast(hot), "__hash", "left")  # at most HOT_KEYS rows

    split = placed(df).withColumn("__salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("__hash", "__salts")
    salted = placed(table).withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__hash", "__salts")
    return split.join(salted, [*on, "__salt"], how).drop("__salt")


def label_lookup(df: DataFrame, names: DataFrame, code: str, spread: list[str]) -> DataFrame:
    """Attach the class name (and whatever else ``names`` holds) to each class code; NULL for an unknown code."""
    return attach_by_key(df, names, [code], spread, "left")


def align_columns(left: DataFrame, right: DataFrame, ids: list[str], suffix: str = "_r", drop: tuple[str, ...] = ()) -> DataFrame:
    """Two frames side by side by row identity; repeated names on the right get a suffix."""
    for c in right.columns:
        if c in left.columns and c not in ids:
            right = right.withColumnRenamed(c, c + suffix)
    return left.join(right, ids, "inner").drop(*drop)


def class_index(df: DataFrame, col: str, out: str = "class_idx") -> DataFrame:
    """One row per class name with its 0-based place in sorted order."""
    names = kept(df.select(col).where(F.col(col).isNotNull()).distinct())
    if names.limit(MAX_LOCAL_CLASSES + 1).count() <= MAX_LOCAL_CLASSES:
        return names.withColumn(out, (F.row_number().over(W.orderBy(col)) - 1).cast("int"))
    return ordered_rank(names, [col], out=out).withColumn(out, (F.col(out) - 1).cast("int"))
