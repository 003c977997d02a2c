import numpy as np
import pytest
from pyspark.sql import functions as F

from fitloom.operators import distributions as ds
from fitloom.operators import metrics, models
from fitloom.session import scratch_path


def truth():
    return F.col("t")


def guess():
    return F.col("g")


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (2, 2), (1, 0)], "t int, g int")


def test_errors_are_row_wise(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 2.0)], "t double, g double")
    assert metrics.mae(df, truth(), guess()).first()["mae"] == 2.0 and metrics.mse(df, truth(), guess()).first()["mse"] == 5.0


def test_precision_of_a_class_never_predicted(scored):
    got = {r["label"]: r["precision"] for r in metrics.precision_per_class(scored, truth(), guess(), [0, 1, 2, 3]).collect()}
    assert got == pytest.approx({0: 0.5, 1: 1 / 3, 2: 1.0, 3: 0.0})


def test_accuracy_truncates_percent(scored):
    r = metrics.accuracy(scored, truth(), guess()).first()
    assert (r["n"], r["percent"]) == (7, 57) and r["accuracy"] == pytest.approx(4 / 7)
    assert metrics.precision_at_1(scored, truth(), guess()).first()["p_at_1"] == pytest.approx(4 / 7)


def test_batch_accuracy_leaves_out_the_tail(spark):
    df = spark.range(10).select("id", F.lit(1).alias("t"), F.lit(1).alias("g"))
    r = metrics.batch_mean_accuracy(df, ["id"], truth(), guess(), 4).first()
    assert (r["batches"], r["accuracy"]) == (2, 1.0)


def test_experiment_table(scored):
    rows = scored.withColumns({"truth": truth(), "guess": guess(), "config": F.lit("a"), "s": F.when(truth() == 1, "v").otherwise("t")})
    r = metrics.experiment_table(rows, "config", "s", "t", "v", [0, 1, 2]).first()
    assert r["acc_train"] == pytest.approx(3 / 5) and r["acc_valid"] == 0.5
    assert r["bias"] == pytest.approx(40.0) and r["variance"] == pytest.approx(10.0) and r["prec_valid_2"] == 0.0
    b = metrics.bias_variance(rows, truth(), guess(), "s", "t", "v").first()
    assert (b["bias"], b["variance"]) == pytest.approx((r["bias"], r["variance"]))


def test_weighted_cross_entropy(spark):
    rows = [(0, [2.0, 0.0], 0), (1, [0.0, 0.0], 0), (2, [1.0, 3.0], 1)]
    df = spark.createDataFrame(rows, "id int, z array<double>, label int")
    ce = [np.log(np.exp(z).sum()) - z[y] for _, z, y in rows]
    w = [0.5, 0.5, 1.0]
    r = metrics.weighted_cross_entropy(df, ["id"], "z", "label").first()
    assert r["weighted"] == pytest.approx(np.dot(w, ce) / sum(w)) and r["plain"] == pytest.approx(np.mean(ce))


def vectors(spark, x):
    return spark.createDataFrame([(i, int(i % 3), [float(v) for v in row]) for i, row in enumerate(x)], "id int, g int, v array<double>")


def test_moments_match_numpy(spark):
    x = np.random.default_rng(0).normal(size=(200, 5)) @ np.random.default_rng(1).normal(size=(5, 5)) + 1e3
    df = vectors(spark, x).repartition(6)
    cov = np.zeros((5, 5))
    for r in ds.covariance_matrix(df, "v").collect():
        cov[r["i"], r["j"]] = r["cov"]
    assert cov == pytest.approx(np.cov(x, rowvar=False))
    assert [r["mean"] for r in ds.mean_vector(df, "v").orderBy("pos").collect()] == pytest.approx(x.mean(axis=0).tolist())


def brute(a, b):
    """Independent form: the symmetric root by eigenvectors."""
    s1, s2 = np.cov(a, rowvar=False), np.cov(b, rowvar=False)
    w, q = np.linalg.eigh(s1)
    half = q @ np.diag(np.sqrt(np.clip(w, 0, None))) @ q.T
    inner = np.linalg.eigvalsh(half @ s2 @ half)
    gap = a.mean(axis=0) - b.mean(axis=0)
    return gap @ gap + np.trace(s1) + np.trace(s2) - 2 * np.sqrt(np.clip(inner, 0, None)).sum()


def test_frechet_distance(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(150, 6)), rng.normal(size=(120, 6)) @ rng.normal(size=(6, 6)) + 0.5
    r = ds.frechet_distance(vectors(spark, a), vectors(spark, b), "v").first()
    assert (r["n1"], r["n2"]) == (150, 120) and r["distance"] == pytest.approx(brute(a, b))
    assert ds.frechet_distance(vectors(spark, a), vectors(spark, a), "v").first()["distance"] == pytest.approx(0.0, abs=1e-7)
    shifted = ds.frechet_distance(vectors(spark, a), vectors(spark, a + 2.0), "v").first()["distance"]
    assert shifted == pytest.approx(6 * 4.0)


def test_frechet_closed_form_and_errors():
    a, b = np.array([1.0, 4.0, 9.0]), np.array([4.0, 1.0, 16.0])
    zero = np.zeros(3)
    assert ds.frechet(zero, np.diag(a), zero, np.diag(b)) == pytest.approx(((np.sqrt(a) - np.sqrt(b)) ** 2).sum())
    with pytest.raises(ValueError):
        ds.frechet(zero, np.diag(a), np.zeros(2), np.eye(2))
    assert ds.frechet(np.array(1.0), np.array(4.0), np.array(3.0), np.array(1.0)) == pytest.approx(4.0 + 1.0)


def test_frechet_by_class_and_group_flush(spark, monkeypatch):
    monkeypatch.setattr(ds, "HELD_CELLS", 1)
    x = np.random.default_rng(3).normal(size=(180, 4))
    got = {r["grp"]: (r["n"], r["distance"]) for r in ds.frechet_by_class(vectors(spark, x), "v", "g").collect()}
    for g in range(3):
        assert got[str(g)][0] == 60 and got[str(g)][1] == pytest.approx(brute(x[g::3], x))


def test_parts(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(50, 3)), rng.normal(size=(40, 3)) * 2 + 1
    r = ds.frechet_parts(vectors(spark, a), vectors(spark, b), "v").first()
    assert r["mean_gap"] == pytest.approx(((a.mean(0) - b.mean(0)) ** 2).sum())
    assert (r["trace_1"], r["trace_2"]) == pytest.approx((a.var(0, ddof=1).sum(), b.var(0, ddof=1).sum()))


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        label = 0 if i < 200 else 1
        rows.append((i, label, [float(v) for v in rng.normal(size=3) + 4 * label], "a" if i % 4 else "b"))
    return models.with_vector(spark.createDataFrame(rows, "id int, label int, v array<double>, split string"), "v")


def test_weighted_classifier_beats_the_majority(spark, separable):
    model = models.fit_weighted_classifier(separable, "features", "label", ["id"])
    own = models.score_batch(model, separable, ["id"])
    joined = own.join(separable.select("id", "label"), "id")
    assert metrics.accuracy(joined, F.col("label"), F.col("predicted")).first()["accuracy"] > 0.95
    foreign = models.score_foreign(separable, "v", ["id"], model.coefficientMatrix.toArray(), np.asarray(model.interceptVector), batch_size=16)
    assert {tuple(r) for r in foreign.collect()} == {tuple(r) for r in own.collect()}


def test_weights_are_scaled_to_mean_one(separable):
    rows = models.with_class_weight(separable.select("id", "label"), "label", ["id"])
    assert rows.agg(F.avg("weight")).first()[0] == pytest.approx(1.0)
    assert {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.first("weight").alias("w")).collect()} == pytest.approx({0: 0.75, 1: 1.5})


def test_config_sweep(separable):
    out = models.config_sweep(separable, "features", "label", 2, "split", "a", "b", {"none": (), "four": (4,)}, rounds=30)
    got = {r["config"]: r for r in out.collect()}
    assert set(got) == {"none", "four"} and got["none"]["acc_valid"] > 0.9


def test_l1_regressor_beats_a_constant(spark):
    df = spark.range(400).select(((F.col("id") * 37) % 101).cast("double").alias("x")).withColumn("y", F.col("x") * 3.0)
    scored = models.fit_l1_regressor(df, ["x"], "y", rounds=20).transform(df)
    assert metrics.mae(scored, F.col("y"), F.col("prediction")).first()["mae"] < 30.0


def test_save_and_load(spark, separable):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    model = Pipeline(stages=[LogisticRegression(maxIter=10)]).fit(separable)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    again = models.score_batch(models.load_model(path), separable, ["id"])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in models.score_batch(model, separable, ["id"]).collect()}


def test_extract_features(spark, separable):
    out = models.extract_features(separable.drop("features"), "v", 2, ["id"])
    assert out.columns == ["id", "features"] and {len(r["features"]) for r in out.collect()} == {2}
