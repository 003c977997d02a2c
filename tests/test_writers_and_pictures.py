"""Predictions in order, split folders with a bounded number of files, images of mixed sizes, large dictionaries."""

import random
import tempfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fitloom.functions import pixels as px
from fitloom.functions import text as tx
from fitloom.operators import augment
from fitloom.operators import images as im
from fitloom.sources import readers, writers


def folder(name):
    return f"{tempfile.mkdtemp(prefix='fitloom-')}/{name}"


def test_predictions_keep_the_order(spark):
    df = spark.range(5000).select("id", ((F.col("id") * 37 % 1000) / 8).alias("p")).repartition(13)
    df = df.withColumn("p", F.when(F.col("id") == 4711, None).otherwise(F.col("p")))
    path = folder("fixed")
    writers.write_predictions_fixed(df, F.col("p"), path, ["id"])
    got = {r["line"]: r["value"] for r in writers.read_predictions_fixed(spark, path).collect()}
    assert got == {r["id"]: r["p"] for r in df.collect()}
    assert spark.read.text(path).where("value = 'null'").count() == 1


def test_predictions_of_nothing(spark):
    path = folder("fixed")
    writers.write_predictions_fixed(spark.range(0).withColumn("p", F.lit(1.0)), F.col("p"), path, ["id"])
    assert writers.read_predictions_fixed(spark, path).count() == 0


def test_split_folders_have_the_planned_files(spark):
    df = spark.range(4000).select("id", F.lit("x" * 100).alias("t"), F.when(F.col("id") < 3000, "a").otherwise("b").alias("c"), F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("s")).repartition(50)
    path = folder("splits")
    plan = writers.write_split_folders(df, "s", "c", path, ["id"], F.octet_length("t"), 50_000)
    files = {(r["s"], r["c"]): (r["rows"], r["bytes"], r["files"]) for r in plan.collect()}
    assert files == {("train", "a"): (2250, 225_000, 5), ("test", "a"): (750, 75_000, 2), ("train", "b"): (750, 75_000, 2), ("test", "b"): (250, 25_000, 1)}
    back = spark.read.parquet(path)
    written = Counter((r["s"], r["c"]) for r in back.select("s", "c", F.input_file_name().alias("f")).distinct().collect())
    assert set(written) == set(files) and all(n <= files[k][2] for k, n in written.items()) and written['train', 'a'] > 1
    assert sorted(r["id"] for r in back.collect()) == list(range(4000))


def test_split_folders_with_gaps(spark):
    df = spark.createDataFrame([(1, None, "train"), (2, "a", "train")], "id int, c string, s string")
    path = folder("splits")
    writers.write_split_folders(df, "s", "c", path, ["id"])
    assert {(r["id"], r["c"]) for r in spark.read.parquet(path).collect()} == {(1, None), (2, "a")}


def pictures(spark, shapes, n=60):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        h, w, c = shapes[i % len(shapes)]
        rows.append((i, h, w, c, [float(rng.randrange(256)) for _ in range(h * w * c)]))
    rows.append((1000, None, None, None, None))
    return spark.createDataFrame(rows, "id int, h int, w int, c int, p array<double>")


@pytest.mark.parametrize("step", ["hflip", "vflip", "rotation", "erase"])
def test_each_step_is_that_of_the_columns(spark, step):
    shape = (6, 9, 3)
    df = pictures(spark, [shape]).where("id < 1000")
    one = {
        "hflip": lambda p: px.random_hflip(p, F.col("id"), 0.2, 42, *shape), "vflip": lambda p: px.random_vflip(p, F.col("id"), 0.5, 42, *shape),
        "rotation": lambda p: px.random_rotation(p, F.col("id"), 24.0, 42, *shape), "erase": lambda p: px.random_erase(px.to_unit_chw(p, *shape), F.col("id"), 0.2, 42, *shape),
    }[step]
    steps = ("unit", "erase") if step == "erase" else (step,)
    got = im.transform_images(df, "p", F.col("h"), F.col("w"), F.col("c"), F.col("id"), steps=steps)
    assert [r["p"] for r in got.orderBy("id").collect()] == [r["v"] for r in df.select("id", one(F.col("p")).alias("v")).orderBy("id").collect()]


def test_mixed_shapes_in_one_batch(spark):
    shapes = [(6, 9, 3), (4, 4, 1), (1, 7, 2), (6, 9, 3)]
    df = pictures(spark, shapes).coalesce(1)
    got = {r["id"]: r for r in im.transform_images(df, "p", F.col("h"), F.col("w"), F.col("c"), F.col("id")).collect()}
    assert got[1000]["p"] is None and len(got) == 61
    for shape in set(shapes):
        part = df.where((F.col("h") == shape[0]) & (F.col("w") == shape[1]))
        for r in part.select("id", px.train_augmentation(F.col("p"), F.col("id"), 42, *shape).alias("v")).collect():
            assert got[r["id"]]["p"] == pytest.approx(r["v"], abs=1e-12)
    assert got[0]["h"] == 6


def test_wrong_size_raises(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "id int, p array<double>")
    with pytest.raises(Exception, match="expected, not of 2 values"):
        im.transform_images(df, "p", F.lit(2), F.lit(2), F.lit(1), F.col("id")).collect()
    assert im.transform_images(df.limit(0), "p", F.lit(2), F.lit(2), F.lit(1), F.col("id")).collect() == []


def test_from_files_to_training_arrays(spark):
    from fitloom.plans.exchange import write_image_files

    rows = spark.createDataFrame([(i, i % 4, [(7 * i + k) % 256 for k in range(64)]) for i in range(24)], "vec_id long, label int, p array<int>")
    path = folder("pictures")
    write_image_files(rows, path, [(8, 8), (4, 16)])
    seen = readers.decode_images(readers.read_images(spark, path))
    done = im.transform_images(seen, "pixels", F.col("height"), F.col("width"), F.lit(3), F.col("path"))
    rows = done.collect()
    assert len(rows) == 24 and sum(r["pixels"] is None for r in rows) == 6
    assert all(len(r["pixels"]) == 192 and np.abs(r["pixels"]).max() <= 1 for r in rows if r["readable"])


def test_large_dictionaries_are_joined(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    mapping = {w: w.upper() for w in words[::2]}
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(120)] + [(500, None), (501, ""), (502, "w0  w0 \n w2")]
    df = spark.createDataFrame(texts, "id int, t string")
    plain = augment.augmented(df, "t", "id", "synonym", augment.WordEdits(synonyms=mapping))
    want = {(r["id"], r["t"], r["edit"]) for r in plain.collect()}
    table = spark.createDataFrame(list(mapping.items()), "word string, new string")
    joined = augment.augmented(df, "t", "id", "synonym", augment.WordEdits(synonyms=table))
    assert joined.columns == plain.columns and {tuple(r) for r in joined.collect()} == want
    monkeypatch.setattr(augment, "MAX_LITERAL_WORDS", 10)
    assert {tuple(r) for r in augment.augmented(df, "t", "id", "synonym", augment.WordEdits(synonyms=mapping)).collect()} == want


def test_a_million_words_stay_out_of_the_plan(spark):
    table = spark.range(1_000_000).select(F.concat(F.lit("w"), "id").alias("word"), F.concat(F.lit("v"), "id").alias("new"))
    df = spark.createDataFrame([(1, "w7 x w999999")], "id int, t string")
    got = augment.augmented(df, "t", "id", "antonym", augment.WordEdits(antonyms=table, share=1.0))
    assert len(got._jdf.queryExecution().toString()) < 50_000
    assert got.first()["t"] == "v7 x v999999"
    assert tx.MAX_LITERAL_WORDS < 1_000_000


def test_mixes_with_one_joined_dictionary(spark):
    counts = {0: 2, 1: 3, 2: 4, 3: 5, 4: 8}
    rows = [(c * 100 + i, c, "good day good") for c, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id int, label int, t string")
    plain = augment.WordEdits(synonyms={"good": "fine"}, antonyms={"day": "night"}, share=0.5)
    table = spark.createDataFrame([("good", "fine")], "word string, new string")
    joined = augment.WordEdits(synonyms=table, antonyms={"day": "night"}, share=0.5)
    for make in (augment.augment_minority, augment.augment_full):
        rows = [Counter(tuple(r) for r in make(df, "t", "id", "label", e).select("id", "label", "t", "edit").collect()) for e in (plain, joined)]
        assert rows[0] == rows[1]
