"""Reading tables, labelled folders, images and schedules."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from fitloom.functions.hashing import gaussian_vector
from fitloom.operators.joins import attach_by_key, class_index

TASKS_A_CORE = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def csv_scan(
    spark: SparkSession, path: str, schema: StructType | str, drop: tuple[str, ...] = (), multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    """CSV with a header line under an explicit schema; a stray index column can be dropped.

    Quoted values may hold line breaks; then each file is read by one task, so large tables should
    come as many files, or without line breaks and ``multi_line=False``. A header with other names
    and a cell of another type are errors; ``mode="PERMISSIVE"`` makes such cells NULL.
    """
    read = spark.read.options(header=True, escape='"', multiLine=multi_line, enforceSchema=False, mode=mode)
    return read.schema(schema).csv(path).drop(*drop)


def read_sequences(spark: SparkSession, path: str, seq: str = "seq", label: str | None = "label") -> DataFrame:
    """Ragged numeric records from Parquet: an array column and, unless for scoring, a class code."""
    schema = f"`{seq}` array<double>" + (f", `{label}` int" if label else "")
    return spark.read.schema(schema).parquet(path)


def labelled_folder_scan(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, class_name, class_idx) of the files below ``root/<class>/``; contents stay unread."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        .select("path", F.element_at(F.split("path", "/"), -2).alias("class_name"))
    )
    return with_class_index(files, "class_name", ["path"])


def with_class_index(df: DataFrame, col: str, ids: list[str], out: str = "class_idx") -> DataFrame:
    """Attach the 0-based place of each row's class among the sorted class names."""
    return attach_by_key(df, class_index(df, col, out), [col], ids, "left")


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` as struct ``image``; what cannot be decoded has height -1.

    Spark counts every small file as 4 MB and would start a task for some thirty of them; a few tasks a core read them all in turn.
    """
    files = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(root)
    return files.coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)


@F.pandas_udf(ArrayType(DoubleType()))
def _rgb(data: pd.Series, channels: pd.Series) -> pd.Series:
    """Stored blue-green-red (or grey) bytes -> interleaved red-green-blue; NULL if there are none."""

    def one(raw, c):
        if c <= 0:
            return None
        px = np.frombuffer(raw, np.uint8).reshape(-1, c)
        px = np.repeat(px, 3, axis=1) if c == 1 else px[:, 2::-1]
        return px.astype("float64").ravel()

    return pd.Series([one(raw, c) for raw, c in zip(data, channels)])


def decode_images(images: DataFrame) -> DataFrame:
    """(path, readable, height, width, pixels) of every file, from one scan.

    Files that cannot be decoded stay in as rows that are not readable, so that they can
    be skipped and reported.
    """
    good = F.col("image.height") > 0
    return images.select(
        F.col("image.origin").alias("path"), good.alias("readable"),
        F.when(good, F.col("image.height")).alias("height"), F.when(good, F.col("image.width")).alias("width"),
        _rgb("image.data", "image.nChannels").alias("pixels"),
    )


def gaussian_latents(rows: DataFrame, row_id: Column, dim: int, seed: int = 42) -> DataFrame:
    """One standard normal vector of ``dim`` entries beside each row."""
    return rows.withColumn("latent", gaussian_vector(row_id, dim, seed))


def noise_schedule(spark: SparkSession, steps: int, start: float = 1e-4, end: float = 0.02) -> DataFrame:
    """Linear noise levels of ``steps`` steps and every term derived from them."""
    t = spark.range(steps).select(F.col("id").cast("int").alias("t"))
    beta = F.lit(start) + F.col("t") * F.lit((end - start) / max(steps - 1, 1))
    terms = t.withColumn("beta", beta).withColumn("alpha", F.lit(1.0) - F.col("beta"))
    # ``steps`` rows made here; tables of any length go through operators.scan
    upto = W.orderBy("t")
    terms = terms.withColumn("alpha_bar", F.exp(F.sum(F.ln("alpha")).over(upto)))
    terms = terms.withColumn("alpha_bar_prev", F.lag("alpha_bar", 1, 1.0).over(upto))
    rest = F.lit(1.0) - F.col("alpha_bar")
    return terms.withColumns({
        "sqrt_recip_alpha": F.sqrt(F.lit(1.0) / F.col("alpha")),
        "sqrt_alpha_bar": F.sqrt("alpha_bar"),
        "sqrt_one_minus_alpha_bar": F.sqrt(rest),
        "posterior_variance": F.col("beta") * (F.lit(1.0) - F.col("alpha_bar_prev")) / rest,
    })
