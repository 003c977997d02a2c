"""Errors, accuracies and losses of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.functions.vectors import cross_entropy, kl_to_unit_normal, l1_sum, l2_sum
from fitloom.operators.joins import attach_by_key
from fitloom.operators.profile import class_weights
from fitloom.operators.splits import assign_batches


def mae(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    return df.agg(F.avg(F.abs(truth - guess)).alias("mae"))


def mse(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    return df.agg(F.avg((truth - guess) * (truth - guess)).alias("mse"))


def _hit(truth: Column, guess: Column) -> Column:
    return (truth == guess).cast("double")


def accuracy(df: DataFrame, truth: Column, guess: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows, share of matches and the truncated percent form."""
    share = F.avg(_hit(truth, guess))
    percent = F.floor(F.count_if(truth == guess) * F.lit(100.0) / F.count(F.lit(1))).cast("int")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), share.alias("accuracy"), percent.alias("percent"))


def batch_mean_accuracy(df: DataFrame, ids: list[str], truth: Column, guess: Column, size: int, seed: int = 42) -> DataFrame:
    """Mean of the accuracies of all full batches."""
    rows = df.select(*ids, _hit(truth, guess).alias("__hit"))
    batches = assign_batches(rows, ids, size, seed, drop_last=True)
    return batches.groupBy("batch").agg(F.avg("__hit").alias("a")).agg(
        F.count(F.lit(1)).alias("batches"), F.avg("a").alias("accuracy")
    )


def confusion(df: DataFrame, truth: Column, guess: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per (group, truth, guess): one combining pass, after which all else is small."""
    return df.groupBy(*by, truth.alias("truth"), guess.alias("guess")).agg(F.count(F.lit(1)).alias("n"))


def precision_per_class(df: DataFrame, truth: Column, guess: Column, classes: list[int]) -> DataFrame:
    """TP / (TP + FP) of each listed class, 0 where the class is never predicted."""
    named = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias("label"))
    scored = (
        confusion(df, truth, guess).groupBy(F.col("guess").alias("label"))
        .agg(F.sum(F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)).alias("tp"), F.sum("n").alias("all"))
    )
    share = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("all")), F.lit(0.0))
    return named.join(scored, "label", "left").select("label", share.alias("precision"))


def precision_at_1(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(_hit(truth, guess)).alias("p_at_1"))


def bias_variance(df: DataFrame, truth: Column, guess: Column, split: str, train: str, valid: str) -> DataFrame:
    """|100 - 100 acc(train)| and 100 |acc(train) - acc(valid)|, one pass."""
    hit = _hit(truth, guess)
    row = df.agg(
        F.avg(F.when(F.col(split) == train, hit)).alias("t"), F.avg(F.when(F.col(split) == valid, hit)).alias("v")
    )
    return row.select(
        F.abs(F.lit(100.0) - F.col("t") * 100.0).alias("bias"), (F.abs(F.col("t") - F.col("v")) * 100.0).alias("variance")
    )


def experiment_table(scored: DataFrame, config: str, split: str, train: str, valid: str, classes: list[int]) -> DataFrame:
    """One row per configuration from columns ``truth`` and ``guess``.

    Accuracies and per-class precisions of both splits, bias and variance, all from the
    confusion counts, which are as small as configurations x splits x classes squared.
    """
    counts = confusion(scored, F.col("truth"), F.col("guess"), (config, split))

    def part(cond):
        return F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("double")

    hit = F.col("truth") == F.col("guess")
    aggs = []
    for name, value in (("train", train), ("valid", valid)):
        here = F.col(split) == value
        aggs.append(F.try_divide(part(here & hit), part(here)).alias(f"acc_{name}"))
        for c in classes:
            said = here & (F.col("guess") == c)
            aggs.append(F.coalesce(F.try_divide(part(said & hit), part(said)), F.lit(0.0)).alias(f"prec_{name}_{c}"))
    table = counts.groupBy(config).agg(*aggs)
    return table.withColumns({
        "bias": F.abs(F.lit(100.0) - F.col("acc_train") * 100.0),
        "variance": F.abs(F.col("acc_train") - F.col("acc_valid")) * 100.0,
    })


def mean_l1_vectors(df: DataFrame, ids: list[str], a: str, b: str, size: int, seed: int = 42) -> DataFrame:
    """Mean |a - b| over the entries of each batch, then over the batches."""
    rows = df.select(*ids, l1_sum(F.col(a), F.col(b)).alias("__l1"), F.size(a).alias("__n"))
    per_batch = assign_batches(rows, ids, size, seed).groupBy("batch").agg((F.sum("__l1") / F.sum("__n")).alias("m"))
    return per_batch.agg(F.count(F.lit(1)).alias("batches"), F.avg("m").alias("mean_l1"))


def weighted_cross_entropy(df: DataFrame, ids: list[str], logits: str, label: str, weights: DataFrame | None = None) -> DataFrame:
    """Weighted and plain mean of -log softmax(logits)[label]; weights default to 1 / class count.

    A label outside the logits has no loss and counts in neither sum; a label without a weight counts in the plain mean alone.
    """
    rows = df.select(*ids, label, cross_entropy(F.col(logits), F.col(label)).alias("__ce"))
    w = weights if weights is not None else class_weights(df, label)
    joined = attach_by_key(rows, w, [label], ids, "left")
    return joined.agg(
        (F.sum(F.col("__ce") * F.col("weight")) / F.sum(F.when(F.col("__ce").isNotNull(), F.col("weight")))).alias("weighted"), F.avg("__ce").alias("plain")
    )


def vae_loss_terms(df: DataFrame, x: str, x_hat: str, mean: str, log_var: str) -> DataFrame:
    """Summed squared error and divergence from the unit normal, and their total."""
    row = df.agg(
        F.sum(l2_sum(F.col(x_hat), F.col(x))).alias("squared_error"),
        F.sum(kl_to_unit_normal(F.col(mean), F.col(log_var))).alias("divergence"),
    )
    return row.withColumn("loss", F.col("squared_error") + F.col("divergence"))
