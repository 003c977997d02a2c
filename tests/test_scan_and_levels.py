"""Running values by ranges, many-level encoding, correlations of many columns and joins on hot keys."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fitloom.operators import encode, joins, profile, scan
from fitloom.operators.levels import level_index


def plan(df):
    return df._jdf.queryExecution().toString()


def product(values):
    out, p, known = [], 1.0, False
    for v in values:
        if v is not None:
            p, known = p * v, True
        out.append(p if known else None)
    return out


@pytest.mark.parametrize("zeros", [(), (300,)])
def test_running_product_with_signs_zeros_and_gaps(spark, zeros):
    rng = random.Random(4)
    f = [rng.choice([-1, 1]) * rng.uniform(0.5, 1.9) for _ in range(500)]
    f[0] = f[77] = None
    for z in zeros:
        f[z] = 0.0
    df = spark.createDataFrame([(i // 2, i % 2, v) for i, v in enumerate(f)], "a int, b int, f double").repartition(7)
    got = scan.running_product(df, "f", ["a", "b"])
    assert got.columns == ["a", "b", "f", "product"] and "SinglePartition" not in plan(got)
    rows = [r["product"] for r in got.orderBy("a", "b").collect()]
    for x, y in zip(rows, product(f), strict=True):
        assert x == y or x == pytest.approx(y, rel=1e-9)


def test_several_ranges_and_no_overflow(spark):
    df = spark.range(2000).select("id", F.lit(1e10).alias("f"), (F.col("id") % 3 == 0).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = scan._cut(df, ["id"])
        assert cut.select("__range").distinct().count() == 8
        falling = df.withColumn("f", F.when(F.col("id") < 1000, 1e10).otherwise(1e-10))
        last = scan.running_product(falling, "f", "id").orderBy(F.desc("id")).first()["product"]
        assert last == pytest.approx(1.0, rel=1e-9)
        shifted = scan.shift_with_default(df, "id", "id", -1)
        assert "SinglePartition" not in plan(shifted)
        assert {(r["id"], r["previous"]) for r in shifted.collect()} == {(i, i - 1) for i in range(2000)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_shift_hands_on_gaps(spark):
    df = spark.createDataFrame([(3, None), (1, 5.0), (2, None), (4, 7.0)], "t int, v double")
    got = {r["t"]: r["previous"] for r in scan.shift_with_default(df, "v", "t", 1.0).collect()}
    assert got == {1: 1.0, 2: 5.0, 3: None, 4: None}
    assert scan.shift_with_default(df.limit(0), "v", "t", 1.0).collect() == []
    assert scan.running_product(df.limit(0), "v", "t").collect() == []


def test_levels_of_every_type(spark):
    rows = [(1, "b", 2.0, b"x"), (2, "a", -0.0, b"y"), (3, None, 0.0, None), (4, "c", float("nan"), b"x"), (5, "b", 10.0, b"z")]
    df = spark.createDataFrame(rows, "id int, `s.t` string, d double, raw binary")
    index = level_index(df, ["s.t", "d", "raw"])
    assert index.widths == [2, 2, 2] and index.size == 6
    assert {tuple(r) for r in index.names().collect()} == {("s.t", "b", 0), ("s.t", "c", 1), ("d", "2.0", 2), ("d", "10.0", 3), ("raw", "79", 4), ("raw", "7A", 5)}
    got = {r["id"]: (r["size"], r["indices"]) for r in index.vectors(df, ["id"]).collect()}
    assert got == {1: (6, [0, 2]), 2: (6, [4]), 3: (6, []), 4: (6, [1]), 5: (6, [0, 3, 5])}
    other = spark.createDataFrame([(7, "unseen", 2.0, None)], df.schema)
    assert [tuple(r) for r in index.rows(other, ["id"]).collect()] == [(7, 2)]
    assert level_index(df.limit(0), ["d"]).size == 0


def test_a_hundred_thousand_levels(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("w"), F.col("id") * 7 % 100_000).alias("w"), (F.col("id") % 3).alias("k"))
    index = level_index(df, ["w", "k"])
    assert index.widths == [99_999, 2]
    for options in ({}, {"limit": 0}):
        ones = index.rows(df, ["id"], **options)
        assert len(plan(ones)) < 20_000
        assert ones.count() == 99_999 + 66_666
    want = {w: i for i, w in enumerate(sorted(f"w{i}" for i in range(100_000)))}
    for r in index.rows(df, ["id"]).where("id < 50 and index < 99999").collect():
        assert r["index"] == want[f"w{r['id'] * 7 % 100_000}"] - 1


def test_sparse_rows_are_the_dense_columns(spark):
    df = spark.createDataFrame([(i, random.Random(i).choice([None, "a", "b", "c"]), i % 4) for i in range(200)], "id int, s string, n int")
    index = level_index(df, ["s", "n"])
    dense = encode.one_hot_apply(df, encode.one_hot_levels(df, ["s", "n"]))
    names = [c for c in dense.columns if c != "id"]
    want = {(r["id"], i) for r in dense.collect() for i, c in enumerate(names) if r[c] == 1.0}
    assert {tuple(r) for r in index.rows(df, ["id"]).collect()} == want


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 40)) + 1e7
    x[:, 1] = 2 * x[:, 0] + rng.normal(size=300)
    x[rng.random(x.shape) < 0.1] = np.nan
    cols = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in x], cols).repartition(5)
    frame = profile.corr_matrix(df, cols)
    assert len(frame._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    got = {(r["a"], r["b"]): r["corr"] for r in frame.collect()}
    assert len(got) == 1600
    for i in range(0, 40, 3):
        for j in range(40):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_correlation_where_nothing_varies(spark):
    df = spark.createDataFrame([(0.1, None, 1.0), (0.1, None, 2.0), (0.1, 3.0, None)], "a double, b double, c double")
    assert all(math.isnan(r["corr"]) for r in profile.corr_matrix(df, ["a", "b", "c"]).collect() if (r["a"], r["b"]) != ("c", "c"))
    assert len(profile.corr_matrix(df.limit(0), ["a", "b"]).collect()) in (0, 4)


def test_only_hot_keys_get_salts(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"))
    hot = joins.hot_keys(df, ["k"]).collect()
    assert len(hot) == 1 and hot[0]["__salts"] == 3  # 3,000 rows in shares of 1,125
    table = df.select("k").distinct().withColumn("v", F.col("k") * 2)
    got = joins.attach_by_key(df, table, ["k"], ["id"], limit=0)
    assert got.count() == 9000 and got.where("v <> 2 * k").count() == 0
    part = joins.attach_by_key(df, table.where("k < 5000"), ["k"], ["id"], "left", limit=0)
    assert part.count() == 9000 and part.where("v is null").count() == 4000
    even = spark.range(100).select("id", F.col("id").alias("k"))
    assert "__salt" not in plan(joins.attach_by_key(even, table, ["k"], ["id"], limit=0))
