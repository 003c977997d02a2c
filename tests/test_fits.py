"""Linear fits by rounds of sums, principal directions, sweeps side by side."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fitloom.operators import metrics, models, regression


def frame(spark, x, y, w=None):
    rows = [(*map(float, r), float(t), 1.0 if w is None else float(w[i])) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, [f"x{i}" for i in range(x.shape[1])] + ["y", "w"]).repartition(4)


def test_least_absolute_deviations_shrug_off_outliers(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 2))
    y = 3.0 + x @ [2.0, -1.0]
    y[:60] += 1000.0
    model = regression.fit_l1_linear(frame(spark, x, y), ["x0", "x1"], "y", rounds=40)
    assert model.intercept == pytest.approx(3.0, abs=1e-3) and model.coefficients == pytest.approx((2.0, -1.0), abs=1e-3)
    assert {r["term"] for r in model.table(frame(spark, x[:1], y[:1])).collect()} == {"intercept", "x0", "x1"}


def test_first_round_is_least_squares_and_gaps_are_left_out(spark):
    rng = np.random.default_rng(2)
    x, w = rng.normal(size=(200, 3)) + 50, rng.uniform(0.5, 2, 200)
    y = x @ [1.0, 2.0, 3.0] + rng.normal(size=200)
    df = frame(spark, x, y, w)
    want = np.linalg.lstsq(np.column_stack([np.ones(200), x]) * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
    gaps = spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None, 1.0), (1.0, float("nan"), 1.0, 1.0, 1.0)], df.schema)
    model = regression.fit_l1_linear(df.union(gaps), ["x0", "x1", "x2"], "y", "w", rounds=0)
    assert [model.intercept, *model.coefficients] == pytest.approx(want, rel=1e-6)
    none = regression.fit_l1_linear(df.limit(0), ["x0"], "y")
    assert (none.intercept, none.coefficients) == (0.0, (0.0,))


def test_logistic_finds_the_odds(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 2))
    p = 1 / (1 + np.exp(-(0.5 + x @ [1.5, -2.0])))
    y = (rng.random(4000) < p).astype(float)
    w = np.where(y == 1, 2.0, 1.0)
    df = frame(spark, x, y, w)
    model = regression.fit_weighted_logistic(df, ["x0", "x1"], "y", "w", rounds=12)
    beta = np.array([model.intercept, *model.coefficients])
    z = np.column_stack([np.ones(4000), x])
    gradient = z.T @ (w * (y - 1 / (1 + np.exp(-z @ beta))))
    assert np.abs(gradient).max() < 1e-6  # a maximum of the weighted likelihood
    assert beta[1:] == pytest.approx([1.5, -2.0], abs=0.2)
    scored = df.withColumn("g", (model.value() > 0).cast("double"))
    assert metrics.accuracy(scored, F.col("y"), F.col("g")).first()["accuracy"] > 0.75
    tame = regression.fit_weighted_logistic(frame(spark, x, (x[:, 0] > 0).astype(float)), ["x0", "x1"], "y", rounds=30, penalty=1.0)
    assert np.isfinite(tame.coefficients).all() and tame.coefficients[0] > 1


def test_principal_axes_narrow_and_wide(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 30)) * np.linspace(5, 0.1, 30) @ np.linalg.qr(rng.normal(size=(30, 30)))[0] + 7.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id int, v array<double>").repartition(3)
    vectors = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :3]
    narrow, wide = models.principal_axes(df, "v", 3), models.principal_axes(df, "v", 3, narrow=10)
    assert np.allclose(np.abs((narrow * vectors).sum(axis=0)), 1.0)
    assert np.allclose(narrow, wide, atol=1e-4)
    assert (narrow[np.abs(narrow).argmax(axis=0), range(3)] > 0).all()
    got = {r["id"]: r["features"] for r in models.extract_features(df, "v", 3, ["id"]).collect()}
    assert got[999] is None and np.allclose([got[i] for i in range(300)], x @ narrow)
    with pytest.raises(ValueError):
        models.principal_axes(df.limit(0), "v", 2)


def test_fits_side_by_side_are_those_one_after_another(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, [float(v) for v in rng.normal(size=3) + 3 * (i % 2)], "a" if i % 4 else "b") for i in range(200)]
    df = models.with_vector(spark.createDataFrame(rows, "id int, label int, v array<double>, split string"), "v")
    configs = {"none": (), "two": (2,), "four": (4,), "four-two": (4, 2)}
    tables = [
        {r["config"]: r for r in models.config_sweep(df, "features", "label", 2, "split", "a", "b", configs, rounds=15, at_once=n).collect()} for n in (1, 4)
    ]
    assert tables[0] == tables[1] and len(tables[0]) == 4


def test_side_by_side_keeps_order_and_bound(spark):
    running, most = [], []

    def job(i):
        running.append(i)
        most.append(len(running))
        n = spark.range(1000).selectExpr(f"sum(id + {i})").first()[0]
        running.remove(i)
        return n

    got = models._side_by_side(spark, [lambda i=i: job(i) for i in range(9)], 3)
    assert got == [499_500 + 1000 * i for i in range(9)] and max(most) <= 3


def test_rows_without_a_weight_are_counted_in_the_plain_mean(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [0.5, 0.1], 1), (3, [3.0, 1.0], 1)], "id int, z array<double>, label int")
    weights = spark.createDataFrame([(0, 2.0)], "label int, weight double")
    row = metrics.weighted_cross_entropy(df, ["id"], "z", "label", weights).first()
    ce = [np.log(np.exp(z).sum()) - z[k] for z, k in (([1.0, 2.0], 0), ([0.5, 0.1], 1), ([3.0, 1.0], 1))]
    assert row["weighted"] == pytest.approx(ce[0]) and row["plain"] == pytest.approx(np.mean(ce))


def test_missing_labels_keep_their_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 1)], "id int, label int")
    got = {r["id"]: r["weight"] for r in models.with_class_weight(df, "label", ["id"]).collect()}
    assert set(got) == {1, 2, 3} and got[2] is None
