"""Fitting with Spark ML and scoring of whole tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from fitloom.operators.distributions import covariance_matrix, mean_vector
from fitloom.operators.joins import attach_by_key, kept
from fitloom.operators.metrics import experiment_table
from fitloom.operators.profile import class_weights
from fitloom.operators.words import bow_vector, bow_vocabulary, vocabulary_words


def with_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """array<double> -> the vector type Spark ML asks for."""
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def with_class_weight(df: DataFrame, label: str, spread: list[str]) -> DataFrame:
    """Inverse class frequency as column ``weight``, scaled to mean 1."""
    weights = kept(class_weights(df, label))
    total = weights.agg(F.count(F.lit(1)).alias("classes"), F.sum(F.lit(1.0) / F.col("weight")).alias("rows")).first()
    scaled = weights.withColumn("weight", F.col("weight") * F.lit(total["rows"] / total["classes"]))
    return attach_by_key(df, scaled, [label], spread, "left")  # a missing label keeps its row, without a weight


def _fit_kept(estimator: Estimator, rows: DataFrame) -> Model:
    """Fit with the training rows kept on the executors, since every round reads them again."""
    rows = rows.persist()
    try:
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def fit_l1_regressor(df: DataFrame, cols: list[str], target: str, rounds: int = 10, depth: int = 4, seed: int = 42) -> PipelineModel:
    """Boosted trees under absolute error."""
    gbt = GBTRegressor(labelCol=target, lossType="absolute", maxIter=rounds, maxDepth=depth, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), gbt]).fit(df.select(*cols, target))


def _mlp(df: DataFrame, features: str, label: str, classes: int, hidden: tuple[int, ...], rounds: int, seed: int) -> MultilayerPerceptronClassifier:
    """Dense network for ``df``; the input width is read from the first row."""
    width = df.select(features).first()[0].size
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=[width, *hidden, classes], maxIter=rounds, seed=seed)


def fit_mlp_classifier(df: DataFrame, features: str, label: str, classes: int, hidden: tuple[int, ...] = (100, 100), rounds: int = 100, seed: int = 42) -> Model:
    return _fit_kept(_mlp(df, features, label, classes, hidden, rounds, seed), df.select(features, label))


def fit_weighted_classifier(df: DataFrame, features: str, label: str, ids: list[str], penalty: float = 0.001, rounds: int = 100) -> Model:
    """Multi-class logistic regression with inverse class frequencies and an L2 penalty; rows without a label are not fitted on."""
    weighted = with_class_weight(df.select(*ids, features, label), label, ids).where(F.col("weight").isNotNull())
    lr = LogisticRegression(
        featuresCol=features, labelCol=label, weightCol="weight", regParam=penalty, maxIter=rounds, family="multinomial"
    )
    return _fit_kept(lr, weighted)


def fit_bow_classifier(df: DataFrame, tokens: Column, label: str, ids: list[str], size: int = 1000, rounds: int = 100) -> tuple[list[str], Model]:
    """Vocabulary of the training rows and the classifier on their word counts."""
    words = vocabulary_words(bow_vocabulary(df, tokens, size))
    counted = bow_vector(df, tokens, words, "features")
    return words, fit_weighted_classifier(counted, "features", label, ids, rounds=rounds)


def _pair_stages(tokens: str, buckets: int) -> list[Transformer]:
    return [NGram(n=2, inputCol=tokens, outputCol="__pairs"), HashingTF(inputCol="__pairs", outputCol="features", numFeatures=buckets)]


def with_word_pairs(df: DataFrame, tokens: str, buckets: int = 1 << 18) -> DataFrame:
    """Counts of hashed word pairs as ``features``, the form that ``fit_text_linear`` fits on."""
    return PipelineModel(_pair_stages(tokens, buckets)).transform(df).drop("__pairs")


def fit_text_linear(df: DataFrame, tokens: str, label: str, buckets: int = 1 << 18, rounds: int = 50) -> PipelineModel:
    """Linear model over hashed word pairs.

    The pairs are counted once, not in every pass of the fit; not at all where ``df`` has them as ``features``.
    """
    counted = df if "features" in df.columns else with_word_pairs(df.select(tokens, label), tokens, buckets)
    linear = _fit_kept(LogisticRegression(labelCol=label, maxIter=rounds, family="multinomial"), counted.select("features", label))
    return PipelineModel([*_pair_stages(tokens, buckets), linear])


def _side_by_side(spark: SparkSession, jobs: list[Callable], at_once: int) -> list:
    """Results of ``jobs`` in their order, at most ``at_once`` running; each in a scheduler pool of its own.

    Under ``spark.scheduler.mode=FAIR`` the pools share the tasks evenly, else earlier jobs go first.
    """

    def run(number: int, job: Callable):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{number % at_once}")
        try:
            return job()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(at_once) as threads:
        return [f.result() for f in [threads.submit(inheritable_thread_target(spark)(run), i, job) for i, job in enumerate(jobs)]]


def config_sweep(
    df: DataFrame, features: str, label: str, classes: int, split: str, train: str, valid: str, configs: dict[str, tuple[int, ...]],
    rounds: int = 100, seed: int = 42, at_once: int = 4,
) -> DataFrame:
    """Fit one dense network per named layer list and report all in one experiment table.

    ``df`` is kept once; up to ``at_once`` networks are fitted at a time on it, which gives the same
    networks as one after another.
    """
    df = kept(df.where(F.col(split).isin(train, valid)))
    fitting = df.where(F.col(split) == train).select(features, label).persist()
    try:
        fitting.count()  # held before the fits begin, so that they do not all compute it
        jobs = [lambda hidden=hidden: _mlp(fitting, features, label, classes, hidden, rounds, seed).fit(fitting) for hidden in configs.values()]
        models = _side_by_side(df.sparkSession, jobs, at_once)
    finally:
        fitting.unpersist()
    rows = df
    for i, model in enumerate(models):  # all models on one scan
        rows = model.setPredictionCol(f"__p{i}").setRawPredictionCol("").setProbabilityCol("").transform(rows)
    guesses = [F.struct(F.lit(name).alias("config"), F.col(f"__p{i}").cast("int").alias("guess")) for i, name in enumerate(configs)]
    scored = rows.select(split, F.col(label).cast("int").alias("truth"), F.inline(F.array(*guesses)))
    return experiment_table(scored, "config", split, train, valid, list(range(classes)))


def score_batch(model: Model, df: DataFrame, ids: list[str]) -> DataFrame:
    """Class of every row, with its id."""
    return model.transform(df).select(*ids, F.col("prediction").cast("int").alias("predicted"))


def score_foreign(df: DataFrame, array_col: str, ids: list[str], weights: np.ndarray, bias: np.ndarray, batch_size: int = 1024, out: str = "predicted") -> DataFrame:
    """Class of every row under a linear model that is not a Spark model, in bounded batches."""

    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            return x @ weights.T + bias

        return predict

    udf = predict_batch_udf(make, return_type=ArrayType(DoubleType()), batch_size=batch_size, input_tensor_shapes=[[weights.shape[1]]])
    scores = df.select(*ids, udf(F.col(array_col).cast("array<double>")).alias("__scores"))
    best = F.array_position("__scores", F.array_max("__scores")) - 1
    return scores.select(*ids, best.cast("int").alias(out))


NARROW = 2048
SPARE = 8


def _signed(axes: np.ndarray) -> np.ndarray:
    """Columns turned so that the entry of largest magnitude is positive."""
    top = np.abs(axes).argmax(axis=0)
    return axes * np.sign(axes[top, np.arange(axes.shape[1])])


def principal_axes(df: DataFrame, array_col: str, k: int, rounds: int = 200, seed: int = 42, narrow: int = NARROW, tolerance: float = 1e-10) -> np.ndarray:
    """The ``k`` leading principal directions (width x k), each with its largest entry positive.

    Up to ``narrow`` dimensions one pass sums the covariance. Beyond, where width squared cells are too many, a block of k + ``SPARE`` directions is
    multiplied by the centred rows until it stands still, one pass a round; tasks and driver
    hold width x block cells.
    """
    rows = df.select(F.col(array_col).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    head = rows.first()
    if head is None:
        raise ValueError("no vectors to fit on")
    width = len(head["v"])
    if width <= narrow:
        cov = np.zeros((width, width))
        cells = covariance_matrix(rows, "v").toArrow()
        cov[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["cov"].to_numpy()
        return _signed(np.linalg.eigh(cov)[1][:, ::-1][:, :k])
    mean = np.array([r["mean"] for r in mean_vector(rows, "v").orderBy("pos").collect()])
    axes = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, min(width, k + SPARE))))[0]
    for _ in range(rounds):

        def run(batches, axes=axes):
            out = np.zeros_like(axes)
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - mean
                out += x.T @ (x @ axes)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(out))], names=["i", "s"])

        parts = rows.mapInArrow(run, "i int, s array<double>").select("i", F.posexplode("s").alias("j", "s"))
        cells = parts.groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
        product = np.zeros_like(axes)
        product[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["s"].to_numpy()
        values, turn = np.linalg.eigh(axes.T @ product)
        axes, before = np.linalg.qr(product @ turn[:, ::-1])[0], axes @ turn[:, ::-1]
        if np.abs(1.0 - np.abs((axes[:, :k] * before[:, :k]).sum(axis=0))).max() < tolerance:
            break
    return _signed(axes[:, :k])


def extract_features(df: DataFrame, array_col: str, k: int, ids: list[str], **options) -> DataFrame:
    """Each vector's products with the k leading principal directions, as an array; a null vector has none."""
    axes = principal_axes(df, array_col, k, **options)
    names = [*ids, "features"]

    def run(batches):
        for batch in batches:
            column = batch.column(len(ids))
            there = column.is_valid().to_numpy(zero_copy_only=False)
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(axes)) @ axes
            ends = np.concatenate(([0], np.cumsum(there * axes.shape[1]))).astype(np.int32)
            features = pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()), mask=None if there.all() else pa.array(~there))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(ids)], features], names=names)

    rows = df.select(*ids, F.col(array_col).cast("array<double>").alias("features"))
    return rows.mapInArrow(run, rows.schema)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
