"""Writing predictions, labelled lines, reports and split folders.

Every writer lets each task write its own part files; nothing is gathered first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitloom.functions.text import escape_line, label_prefix
from fitloom.operators.joins import attach_by_key, kept
from fitloom.operators.rank import ordered_rank


def write_predictions_fixed(df: DataFrame, value: Column, path: str, order: list[str]) -> None:
    """One value per line with six decimals, no header, in the order of ``order``.

    The order should tell all rows apart, for line k is then the k-th row: rows are cut into ranges of it, and the numbered part
    files follow each other as the ranges do. A missing value is the line ``null``.
    """
    keys = [F.col(f"`{c}`") for c in order]
    line = F.when(value.isNull(), F.lit("null")).otherwise(F.format_string("%.6f", value.cast("double")))
    df.select(line.alias("value"), *keys).orderBy(*keys).select("value").write.text(path)


def read_predictions_fixed(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of files written by ``write_predictions_fixed``, lines from 0 over all parts in the order of their names.

    Within a block of a file lines are numbered as they are read; blocks are then ranked like any ordered rows.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"),
        F.expr("try_cast(value AS double)").alias("value"),
    )
    ranked = ordered_rank(lines, ["file", "block", "place"], out="line")
    return ranked.select((F.col("line") - 1).alias("line"), "value")


def write_predictions_csv(df: DataFrame, cols: list[str], path: str) -> None:
    """The given columns (an id and the class) without header."""
    df.select(*cols).write.csv(path, header=False)


def write_labelled_text(df: DataFrame, label: str, text: str, path: str) -> None:
    """``__label__<label> <text>`` lines, unquoted, with the escapes of ``escape_line``."""
    df.select(escape_line(label_prefix(F.col(label), F.col(text))).alias("value")).write.text(path)


def write_experiment_report(df: DataFrame, path: str, append: bool = False) -> None:
    """Start a report afresh or add rows to it."""
    df.write.mode("append" if append else "overwrite").parquet(path)


FILE_BYTES = 128 << 20


def split_files(df: DataFrame, split: str, label: str, size: Column, file_bytes: int = FILE_BYTES) -> DataFrame:
    """(split, label, rows, bytes, files): what each folder holds and in how many files, one per ``file_bytes`` of ``size``."""
    held = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("bytes"))
    return held.withColumn("files", F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes)).cast("int"))


def write_split_folders(
    df: DataFrame, split: str, label: str, path: str, ids: list[str], size: Column | None = None, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """A folder per split and class, below it the rows; returns the plan of ``split_files``.

    The rows of a folder are measured (``size`` in bytes, by default as text) and dealt by their ``ids`` to so many tasks that each
    writes one file of about ``file_bytes`` (pieces that meet in one task are one file). So there are never more files than planned, whatever the
    number of tasks before, and a folder with a third of all rows is written by many tasks.
    """
    size = F.octet_length(F.to_json(F.struct("*"))) if size is None else size
    plan = kept(split_files(df, split, label, size, file_bytes))
    total = plan.agg(F.sum("files")).first()[0] or 1
    files = plan.select(F.col(split).alias("__split"), F.col(label).alias("__label"), F.col("files").alias("__files"))
    keyed = df.withColumns({"__split": F.col(split), "__label": F.col(label)})
    dealt = attach_by_key(keyed, files, ["__split", "__label"], ids, "left")
    piece = F.pmod(F.xxhash64(*ids), F.coalesce("__files", F.lit(1))).cast("int")
    tasks = dealt.withColumn("__piece", piece).repartition(int(total), "__split", "__label", "__piece")
    tasks.drop("__split", "__label", "__files", "__piece").write.partitionBy(split, label).parquet(path)
    return plan
