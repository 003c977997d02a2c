"""Sequences as array records: building, padding, schedule lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.functions.vectors import last_index, pad_right
from fitloom.operators.joins import attach_by_key, kept
from fitloom.operators.rank import ordered_rank
from fitloom.operators.splits import assign_batches

SEGMENT_VALUES = 4096


def sequence_totals(df: DataFrame, owner: str, order: list[str], value: str, extra: str | None = None) -> DataFrame:
    """(owner, length, last) of each owner's values in order; ``extra`` adds that column's first value.

    One aggregate, combined before the shuffle, so a hot owner costs one row per task.
    """
    at = F.struct(*order)
    more = [F.min_by(extra, at).alias(extra)] if extra else []
    last = F.max_by(F.col(value).cast("double"), at).alias("last")
    return df.groupBy(owner).agg(F.count(F.lit(1)).alias("length"), last, *more)


def build_sequences(
    df: DataFrame, owner: str, order: list[str], value: str, extra: str | None = None, segment_values: int = SEGMENT_VALUES
) -> DataFrame:
    """(owner, segment, start, length, last, seq): the values of each owner in order.

    ``length``, ``last`` and ``extra`` (that column's first value) tell of the whole sequence, in
    every record. A sequence of more than ``segment_values`` values is stored as records of equal
    length, at most that, so that a hot owner is no single group; ``start`` is the place of a
    record's first value in the sequence, and no value is left out. The order has to be unique per owner.
    """
    cols = list(dict.fromkeys([owner, *order, value, *([extra] if extra else [])]))
    df = df.select(*cols).withColumn("__owner", F.struct(F.col(owner).alias("o")))  # an owner that is NULL is one, too
    totals = sequence_totals(df, "__owner", order, value, extra)
    long = kept(totals.where(F.col("length") > segment_values).select("__owner", F.struct(*totals.columns[1:]).alias("__of")))
    if long.isEmpty():
        rows = df.withColumns({"__of": F.lit(None).cast(long.schema["__of"].dataType), "segment": F.lit(0)})
    else:
        held = attach_by_key(df, long, ["__owner"], order, "left")
        ranked = ordered_rank(held.where("__of is not null"), order, (owner,), "__rank")
        pieces = F.ceil(F.col("__of.length") / F.lit(segment_values))
        segment = F.floor((F.col("__rank") - 1) * pieces / F.col("__of.length")).cast("int")
        ranked = ranked.withColumn("segment", segment).drop("__rank")
        rows = ranked.unionByName(held.where("__of is null").withColumn("segment", F.lit(0)))

    place = [F.col(o).alias(f"o{i}") for i, o in enumerate(order)]
    place = F.struct(*place, F.col(value).cast("double").alias("v"), *([F.col(extra).alias("x")] if extra else []))
    grouped = rows.groupBy(owner, "segment").agg(F.sort_array(F.collect_list(place)).alias("__p"), F.first("__of").alias("__of"))

    long, final = F.col("__of").isNotNull(), F.element_at("__p", -1)
    # the first place p with floor(p * pieces / length) = segment
    pieces = F.ceil(F.col("__of.length") / F.lit(segment_values))
    start = F.ceil(F.col("segment") * F.col("__of.length") / pieces)
    out = [
        owner, "segment",
        F.when(long, start).otherwise(F.lit(0)).cast("bigint").alias("start"),
        F.when(long, F.col("__of.length")).otherwise(F.size("__p")).cast("bigint").alias("length"),
        F.when(long, F.col("__of.last")).otherwise(final["v"]).alias("last"),
        F.transform("__p", lambda p: p["v"]).alias("seq"),
    ]
    if extra:
        out.append(F.when(long, F.col("__of")[extra]).otherwise(F.get("__p", F.lit(0))["x"]).alias(extra))
    return grouped.select(*out)


def _pad_ends(df: DataFrame, seq: str, longest: Column, segments: bool) -> DataFrame:
    """Pad whole sequences, or the last record of each stored sequence, to ``longest``."""
    if not segments:
        return df.withColumn("last_idx", last_index(F.col(seq))).withColumn(seq, pad_right(F.col(seq), longest))
    ends = F.col("start") + F.size(seq) == F.col("length")
    padded = F.when(ends, pad_right(F.col(seq), (longest - F.col("start")).cast("int"))).otherwise(F.col(seq))
    return df.withColumn("last_idx", (F.col("length") - 1).cast("int")).withColumn(seq, padded)


def pad_to_max(df: DataFrame, seq: str, segments: bool = False) -> DataFrame:
    """Right-pad every sequence with 0 to the longest one; keeps the last true index.

    ``segments`` is for the records of ``build_sequences``.
    """
    longest = df.agg(F.max("length" if segments else F.size(seq))).scalar()
    return _pad_ends(df, seq, longest, segments)


def pad_batch(
    df: DataFrame, ids: list[str], seq: str, size: int, seed: int = 42, drop_last: bool = False, segments: bool = False
) -> DataFrame:
    """Right-pad every sequence to the longest one of its batch of ``size`` sequences.

    ``segments`` is for the records of ``build_sequences``; all records of an owner are in its batch.
    """
    longest = W.partitionBy("batch")  # at most ``size`` rows each
    if not segments:
        batched = assign_batches(df, ids, size, seed, drop_last).withColumn("__len", F.max(F.size(seq)).over(longest))
    else:
        heads = assign_batches(df.where("start = 0").select(*ids, "length"), ids, size, seed, drop_last)
        batched = df.join(heads.select(*ids, "batch", F.max("length").over(longest).alias("__len")), ids)
    return _pad_ends(batched, seq, F.col("__len"), segments).drop("__len")


def gather_by_step(df: DataFrame, schedule: DataFrame, step: str, terms: list[str]) -> DataFrame:
    """Schedule values of each row's step; the schedule has one row per step.

    A row whose step is not in the schedule stays, with NULL terms.
    """
    table = schedule.select(F.col("t").alias(step), *terms)
    return df.join(table, step, "left")


def interleave(df: DataFrame, ids: list[str], first: str, second: str) -> DataFrame:
    """Two rows per row: slot 0 holds the first vector, slot 1 the second."""
    pair = F.posexplode(F.array(F.col(first), F.col(second))).alias("slot", "vec")
    return df.select(*ids, pair)
