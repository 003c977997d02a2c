import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fitloom.functions.classes import cast_numeric, price_class_code, price_class_name
from fitloom.operators import encode, profile, scan


def test_price_edges(spark):
    rows = [(0, 99999.99), (1, 100000.0), (2, 349999.99), (3, 350000.0), (4, float("nan")), (5, None)]
    df = spark.createDataFrame(rows, "id int, p double")
    got = {r["id"]: (r["c"], r["n"]) for r in df.select("id", price_class_code(F.col("p")).alias("c"), price_class_name(F.col("p")).alias("n")).collect()}
    assert got == {0: (0, "cheap"), 1: (1, "average"), 2: (1, "average"), 3: (2, "expensive"), 4: (2, "expensive"), 5: (2, "expensive")}


def test_cast_gives_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "s string").select(cast_numeric(F.col("s"), "double").alias("d"))
    assert [r["d"] for r in df.collect()] == [1.5, None]


def test_describe_leaves_out_missing(spark):
    values = [3.0, 1.0, None, float("nan"), 10.0, 4.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    r = profile.describe(df, ["x"]).first()
    clean = np.array([1.0, 3.0, 4.0, 10.0])
    assert (r["count"], r["min"], r["max"]) == (4, 1.0, 10.0)
    assert r["mean"] == pytest.approx(clean.mean()) and r["std"] == pytest.approx(clean.std(ddof=1))
    assert [r["p25"], r["p50"], r["p75"]] == pytest.approx(np.percentile(clean, [25, 50, 75]).tolist())


@pytest.mark.parametrize("kind", ["even", "skewed", "constant", "infinite", "wide"])
def test_quantiles_against_numpy(spark, monkeypatch, kind):
    monkeypatch.setattr(profile, "FEW", 5)
    monkeypatch.setattr(profile, "BINS", 8)
    rng = np.random.default_rng(1)
    x = {
        "even": rng.uniform(-5, 5, 999),
        "skewed": np.where(rng.uniform(size=999) < 0.4, 7.0, rng.lognormal(3, 3, 999)),
        "constant": np.full(10, 2.5),
        "infinite": np.concatenate([[-math.inf] * 30, rng.normal(size=100), [math.inf] * 40]),
        "wide": np.concatenate([[-1.7e308, 1.7e308], rng.normal(size=500)]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    assert profile.exact_quantiles(df, ["x"], probs)["x"] == pytest.approx([by_sorting(x, p) for p in probs])


def by_sorting(x, p):
    """Linear interpolation that survives two equal infinities."""
    x, at = np.sort(x), (len(x) - 1) * p
    lo, hi = float(x[math.floor(at)]), float(x[math.ceil(at)])
    return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))


def test_quantiles_take_few_passes_over_any_doubles(spark, monkeypatch):
    monkeypatch.setattr(profile, "FEW", 2)
    passes = []
    counts = profile._bin_counts
    monkeypatch.setattr(profile, "_bin_counts", lambda *a: passes.append(1) or counts(*a))
    x = [s * 2.0**e * f for e in range(-1074, 1023, 7) for s in (-1, 1) for f in (1, 1.25)] + [0.0, -0.0, 0.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    probs = [0.0, 0.3, 0.5, 0.77, 1.0]
    assert profile.exact_quantiles(df, ["x"], probs)["x"] == pytest.approx([by_sorting(x, p) for p in probs])
    assert len(passes) <= 6


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert math.isnan(profile.exact_quantiles(df, ["x"], [0.5])["x"][0])


def test_correlation_with_gaps_and_constants(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, None, 5.0), (4.0, 9.0, 5.0), (5.0, 3.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["a"], r["b"]): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9
    a, b = np.array([1.0, 2.0, 4.0, 5.0]), np.array([2.0, 1.0, 9.0, 3.0])
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef(a, b)[0, 1])
    assert got["a", "a"] == pytest.approx(1.0) and math.isnan(got["a", "c"]) and math.isnan(got["c", "c"])


def test_null_count_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, None)], "a double, b string")
    assert {r["column"]: r["nulls"] for r in profile.null_count(df).collect()} == {"a": 2, "b": 2, "*": 4}


def test_histogram_keeps_all_rows(spark):
    df = spark.createDataFrame([(float(i % 7),) for i in range(100)], "x double")
    assert sum(r["n"] for r in profile.distribution_profile(df, "x", 5).collect()) == 100
    flat = profile.distribution_profile(spark.createDataFrame([(2.0,)] * 3, "x double"), "x").collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 3)]


def test_one_hot_null_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "c string")
    levels = encode.one_hot_levels(train, ["c"])
    assert levels == {"c": ["b", "c"]}
    test = spark.createDataFrame([(1, "b"), (2, None), (3, "zzz")], "id int, c string")
    got = {r["id"]: (r["c_b"], r["c_c"]) for r in encode.one_hot_apply(test, levels).collect()}
    assert got == {1: (1.0, 0.0), 2: (0.0, 0.0), 3: (0.0, 0.0)}


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0)], "x double, k double")
    scaler = encode.standard_scale_fit(df, ["x", "k"])
    assert scaler.std["k"] == 1.0
    got = sorted((r["x"], r["k"]) for r in scaler.apply(df).collect())
    assert got[0] == pytest.approx((-1.0690449676, 0.0))


def test_running_product_and_shift(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.25), (2, 1.0)], "t int, f double")
    assert [r["product"] for r in scan.running_product(df, "f", "t").orderBy("t").collect()] == pytest.approx([0.5, 0.125, 0.125])
    assert [r["previous"] for r in scan.shift_with_default(df, "f", "t", 1.0).orderBy("t").collect()] == [1.0, 0.5, 0.25]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1.0, "x"), (3.0, "y")], "`Size(sqf)` double, `Hall.Type` string")
    assert profile.describe(df, ["Size(sqf)"]).first()["mean"] == 2.0
    assert encode.one_hot_apply(df, encode.one_hot_levels(df, ["Hall.Type"])).columns == ["Size(sqf)", "Hall.Type_y"]
    assert encode.standard_scale_fit(df, ["Size(sqf)"]).mean == {"Size(sqf)": 2.0}


def test_one_hot_of_mixed_types_and_too_many_levels(spark, monkeypatch):
    df = spark.createDataFrame([(1, "b", "x"), (2, "a", "y"), (3, "a", None)], "n int, s string, t string")
    assert encode.one_hot_levels(df, ["n", "s", "t"]) == {"n": [2, 3], "s": ["b"], "t": ["y"]}
    monkeypatch.setattr(encode, "MAX_LEVELS", 2)
    with pytest.raises(ValueError):
        encode.one_hot_levels(df, ["n"])
    assert encode.one_hot_levels(df, ["s"]) == {"s": ["b"]}
