"""Intermediate tables, computed once and kept in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fitloom.session import scratch_path


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back, so that no later step computes it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
