import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fitloom.operators import rank, splits
from fitloom.operators.joins import attach_by_key, class_index


def ids(spark, n, parts):
    return spark.range(n).select(F.col("id").alias("k")).repartition(parts)


def expected_order(spark, n, seed):
    rows = spark.range(n).select(F.col("id").alias("k"), F.md5(F.concat_ws(":", "id", F.lit(seed))).alias("m"))
    return [r["k"] for r in sorted(rows.collect(), key=lambda r: (r["m"], r["k"]))]


@pytest.mark.parametrize("parts", [1, 8])
def test_shuffled_rank_is_the_full_sort(spark, parts):
    order = expected_order(spark, 500, 7)
    got = {r["k"]: r["rank"] for r in rank.shuffled_rank(ids(spark, 500, parts), ["k"], 7).collect()}
    assert [got[k] for k in order] == list(range(1, 501))


def test_shuffled_rank_per_class_with_null_class(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("c"))
    rows = rank.shuffled_rank(df, ["id"], 1, by=("c",)).collect()
    assert len(rows) == 300
    for c in (None, "1", "2"):
        assert sorted(r["rank"] for r in rows if r["c"] == c) == list(range(1, 101))


@pytest.mark.parametrize("parts", [1, 7])
def test_ordered_rank_with_one_hot_group(spark, parts):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"), (F.col("id") * 37 % 3001).alias("v")
    ).repartition(parts)
    rows = rank.ordered_rank(df, ["v"], by=("g",)).collect()
    assert len(rows) == 3000
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["g"], []).append((r["rank"], r["v"]))
    for held in groups.values():
        assert [p for p, _ in sorted(held)] == list(range(1, len(held) + 1))
        assert [v for _, v in sorted(held)] == sorted(v for _, v in held)


def test_ordered_rank_without_groups(spark):
    rows = rank.ordered_rank(spark.range(1000).select((F.col("id") * 7 % 1009).alias("v")), ["v"]).collect()
    assert [r["v"] for r in sorted(rows, key=lambda r: r["rank"])] == sorted(r["v"] for r in rows)


def test_cuts_are_refined_below_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(rank, "SMALL", 0)
    monkeypatch.setattr(rank, "DIGITS", 1)
    order = expected_order(spark, 400, 5)
    n, cuts = rank.find_cuts(ids(spark, 400, 3), ["k"], 5, lambda n: [0, 1, 137, 400])
    assert n == 400
    for cut, k in zip(cuts, [0, 1, 137, 400]):
        held = {r["k"] for r in ids(spark, 400, 2).where(cut.holds()).collect()}
        assert held == set(order[:k])


@pytest.mark.parametrize("n", [0, 1, 7, 100])
def test_split_sizes(spark, n):
    df = ids(spark, n, 2)
    count = lambda d, c: Counter(r[c] for r in d.collect())
    held = count(splits.holdout_split(df, ["k"], 0.3), "split")
    assert held["holdout"] == math.ceil(0.3 * n) and held["train"] == n - math.ceil(0.3 * n)
    three = count(splits.three_way_split(df, ["k"]), "split")
    m = math.ceil(0.3 * n)
    assert (three["train"], three["test"], three["validate"]) == (n - m, math.ceil(0.33 * m), m - math.ceil(0.33 * m))
    assert count(splits.train_fraction_split(df, ["k"], 0.8), "split")["train"] == math.floor(0.8 * n)
    parts = count(splits.fraction_split(df, ["k"], [0.5, 0.3, 0.2]), "part")
    assert [parts[i] for i in range(3)] == splits.fraction_sizes(n, [0.5, 0.3, 0.2])


def test_fraction_sizes_give_leftovers_in_turn():
    assert splits.fraction_sizes(7, [0.5, 0.5]) == [4, 3]
    assert splits.fraction_sizes(11, [0.4, 0.3, 0.3]) == [5, 3, 3]


def test_splits_do_not_depend_on_partitions(spark):
    one = {tuple(r) for r in splits.three_way_split(ids(spark, 200, 1), ["k"]).collect()}
    many = {tuple(r) for r in splits.three_way_split(ids(spark, 200, 8), ["k"]).collect()}
    assert one == many


def test_stratified_rounds_half_to_even(spark):
    sizes = {"a": 5, "b": 15, "c": 1, "d": 400}
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id string, c string").repartition(5)
    got = Counter((r["c"], r["split"]) for r in splits.stratified_split(df, ["id"], "c").collect())
    for c, n in sizes.items():
        train, valid = round(n * 0.7), round(n * 0.2)
        assert got[c, "train"] == train and got[c, "validate"] == valid and got[c, "test"] == n - train - valid


def test_stratified_with_shared_buckets(spark, monkeypatch):
    monkeypatch.setattr(splits, "DIGITS", 1)  # all cuts fall inside buckets
    df = spark.range(1000).select("id", (F.col("id") % 2).cast("string").alias("c"))
    rows = splits.stratified_split(df, ["id"], "c").collect()
    assert Counter((r["c"], r["split"]) for r in rows) == {(c, s): n for c in "01" for s, n in [("train", 350), ("validate", 100), ("test", 50)]}
    ranked = {r["id"]: r["rank"] for r in rank.shuffled_rank(df, ["id"], 42, by=("c",)).collect()}
    for r in rows:
        assert r["split"] == ("train" if ranked[r["id"]] <= 350 else "validate" if ranked[r["id"]] <= 450 else "test")


def test_batches(spark):
    full = splits.assign_batches(ids(spark, 70, 3), ["k"], 32)
    assert Counter(r["batch"] for r in full.collect()) == {0: 32, 1: 32, 2: 6}
    assert Counter(r["batch"] for r in splits.assign_batches(ids(spark, 70, 3), ["k"], 32, drop_last=True).collect()) == {0: 32, 1: 32}
    first = {r["k"] for r in splits.first_batch(ids(spark, 70, 3), ["k"], 32).collect()}
    assert first == {r["k"] for r in full.where("batch = 0").collect()}


def test_cap_rows_clamps(spark):
    assert splits.cap_rows(ids(spark, 10, 2), ["k"], -3).count() == 0
    assert splits.cap_rows(ids(spark, 10, 2), ["k"], 99).count() == 10


def test_shuffle_differs_by_epoch(spark):
    a = {tuple(r) for r in splits.shuffle_rows(ids(spark, 50, 1), ["k"], epoch=0).collect()}
    b = {tuple(r) for r in splits.shuffle_rows(ids(spark, 50, 1), ["k"], epoch=1).collect()}
    assert a != b


def test_attach_beyond_the_broadcast_limit(spark):
    df = spark.range(500).select("id", F.when(F.col("id") < 300, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    table = df.select("c").distinct().withColumn("size", F.length("c"))
    small = {tuple(r) for r in attach_by_key(df, table, ["c"], ["id"]).select("id", "size").collect()}
    large = attach_by_key(df, table, ["c"], ["id"], limit=0)
    assert "__salt" in large._jdf.queryExecution().toString()
    assert {tuple(r) for r in large.select("id", "size").collect()} == small and len(small) == 500


def test_class_index_beyond_the_local_limit(spark, monkeypatch):
    from fitloom.operators import joins

    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "c string")
    want = {("a", 0), ("b", 1), ("c", 2)}
    assert {tuple(r) for r in class_index(df, "c").collect()} == want
    monkeypatch.setattr(joins, "MAX_LOCAL_CLASSES", 1)
    assert {tuple(r) for r in class_index(df, "c").collect()} == want


def test_collate_sees_whole_batches(spark):
    def sizes(pdf):
        return pdf.groupby("batch", as_index=False).agg(n=("k", "size"))

    got = splits.collate_batches(ids(spark, 70, 3), ["k"], 32, sizes, "batch bigint, n bigint").collect()
    assert {tuple(r) for r in got} == {(0, 32), (1, 32), (2, 6)}
