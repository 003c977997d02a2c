import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fitloom.functions import pixels as px
from fitloom.functions import vectors as vx
from fitloom.functions.hashing import coin, gaussian, uniform
from fitloom.operators import joins, profile, sequences
from fitloom.plans.exchange import write_image_files
from fitloom.session import scratch_path
from fitloom.sources import readers


def arr(spark, values, make):
    return spark.createDataFrame([(values,)], "v array<double>").select(make(F.col("v")).alias("o")).first()["o"]


def test_argmax_first_on_ties(spark):
    assert arr(spark, [1.0, 5.0, 5.0], vx.argmax) == 1


def test_softmax_does_not_overflow(spark):
    assert arr(spark, [1000.0, 1000.0], vx.softmax) == pytest.approx([0.5, 0.5])
    x = np.array([0.1, -2.0, 3.0])
    assert arr(spark, x.tolist(), vx.softmax) == pytest.approx((np.exp(x) / np.exp(x).sum()).tolist())


def test_gather_outside_is_null(spark):
    assert arr(spark, [1.0], lambda v: vx.gather(v, F.lit(3))) is None


def test_cross_entropy_and_divergence(spark):
    x = np.array([0.2, 1.0, -1.0])
    assert arr(spark, x.tolist(), lambda v: vx.cross_entropy(v, F.lit(2))) == pytest.approx(-math.log(np.exp(x[2]) / np.exp(x).sum()))
    assert arr(spark, [0.0, 0.0], lambda v: vx.kl_to_unit_normal(v, v)) == 0.0


def test_draws_look_right(spark):
    df = spark.range(20000)
    u = df.select(F.avg(uniform(F.col("id"), 1)).alias("m"), F.avg(coin(0.2, F.col("id"), 1).cast("int")).alias("c")).first()
    assert u["m"] == pytest.approx(0.5, abs=0.01) and u["c"] == pytest.approx(0.2, abs=0.01)
    g = df.select(gaussian(F.col("id"), 1).alias("g")).agg(F.avg("g").alias("m"), F.stddev("g").alias("s")).first()
    assert g["m"] == pytest.approx(0.0, abs=0.03) and g["s"] == pytest.approx(1.0, abs=0.03)
    same = df.select((coin(0.37, F.col("id"), "x") == (uniform(F.col("id"), "x") < 0.37)).alias("e")).where("not e")
    assert same.count() == 0
    assert df.where(coin(1.0, F.col("id"))).count() == 20000 and df.where(coin(0.0, F.col("id"))).count() == 0


def test_schedule(spark):
    rows = readers.noise_schedule(spark, 200).orderBy("t").collect()
    beta = np.linspace(1e-4, 0.02, 200)
    bar = np.cumprod(1 - beta)
    prev = np.concatenate([[1.0], bar[:-1]])
    assert [r["alpha_bar"] for r in rows] == pytest.approx(bar.tolist())
    assert rows[199]["alpha_bar"] == pytest.approx(0.1321827542506)
    assert [r["posterior_variance"] for r in rows] == pytest.approx((beta * (1 - prev) / (1 - bar)).tolist())
    assert readers.noise_schedule(spark, 1).first()["beta"] == pytest.approx(1e-4)


@pytest.mark.parametrize("parts", [1, 6])
def test_sequences_go_on_in_segments(spark, parts):
    rows = [(u, t, float(10 * u + t)) for u, n in [(1, 5), (2, 1), (3, 12)] for t in range(n)]
    df = spark.createDataFrame(rows[::-1], "u int, t int, v double").repartition(parts)
    built = sequences.build_sequences(df, "u", ["t"], "v", "t", segment_values=5)
    got = {(r["u"], r["start"]): (r["length"], r["last"], r["t"], r["seq"]) for r in built.collect()}
    assert got == {
        (1, 0): (5, 14.0, 0, [10.0, 11.0, 12.0, 13.0, 14.0]), (2, 0): (1, 20.0, 0, [20.0]), (3, 0): (12, 41.0, 0, [30.0, 31.0, 32.0, 33.0]),
        (3, 4): (12, 41.0, 0, [34.0, 35.0, 36.0, 37.0]), (3, 8): (12, 41.0, 0, [38.0, 39.0, 40.0, 41.0]),
    }
    totals = sequences.sequence_totals(df, "u", ["t"], "v", "t").collect()
    assert {tuple(r) for r in totals} == {(1, 5, 14.0, 0), (2, 1, 20.0, 0), (3, 12, 41.0, 0)}
    assert profile.max_sequence_length(df, "u").first()["max_len"] == 12


def test_long_sequences_are_cut_by_rows(spark):
    n = 1000
    times = {"far": [0] + [10**9 + t for t in range(n - 2)] + [10**12], "tie": [7] * n, None: [t * t for t in range(n)], "short": [3, 1, 2]}
    rows = [(u, t, i, float(i), f"{u}{i}") for u, ts in times.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows[::-1], "u string, t long, i int, v double, x string").repartition(5)
    built = sequences.build_sequences(df, "u", ["t", "i"], "v", "x", segment_values=64).collect()
    assert max(len(r["seq"]) for r in built) <= 64
    for u, ts in times.items():
        want = [float(i) for _, i in sorted((t, i) for i, t in enumerate(ts))]
        got = []
        for r in sorted((r for r in built if r["u"] == u), key=lambda r: r["segment"]):
            assert (r["start"], r["length"], r["last"], r["x"]) == (len(got), len(ts), want[-1], f"{u}{int(want[0])}")
            got += r["seq"]
        assert got == want


def test_padding_of_stored_records(spark):
    rows = [(u, t, 1.0) for u, n in [(1, 3), (2, 11)] for t in range(n)]
    built = sequences.build_sequences(spark.createDataFrame(rows, "u int, t int, v double"), "u", ["t"], "v", segment_values=4)
    for padded in (sequences.pad_to_max(built, "seq", segments=True), sequences.pad_batch(built, ["u"], "seq", 2, segments=True)):
        whole = {}
        for r in sorted(padded.collect(), key=lambda r: (r["u"], r["start"])):
            assert len(whole.setdefault(r["u"], [])) == r["start"]
            whole[r["u"]] += r["seq"]
            assert r["last_idx"] == {1: 2, 2: 10}[r["u"]]
        assert whole == {1: [1.0] * 3 + [0.0] * 8, 2: [1.0] * 11}


def test_padding(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0, 3.0])], "id int, s array<double>")
    got = {r["id"]: (r["s"], r["last_idx"]) for r in sequences.pad_to_max(df, "s").collect()}
    assert got == {1: ([1.0, 0.0, 0.0], 0), 2: ([1.0, 2.0, 3.0], 2)}
    many = spark.createDataFrame([(i, [1.0] * (i + 1)) for i in range(10)], "id int, s array<double>")
    rows = sequences.pad_batch(many, ["id"], "s", 3).collect()
    for b in {r["batch"] for r in rows}:
        held = [r for r in rows if r["batch"] == b]
        assert {len(r["s"]) for r in held} == {max(r["last_idx"] for r in held) + 1}


H, W, C = 3, 4, 2
IMG = np.arange(H * W * C, dtype=float).reshape(H, W, C)


def test_layouts(spark):
    flat = IMG.ravel().tolist()
    chw = arr(spark, flat, lambda v: px.to_unit_chw(v, H, W, C))
    assert chw == pytest.approx((IMG.transpose(2, 0, 1) / 255.0).ravel().tolist())
    back = arr(spark, IMG.transpose(2, 0, 1).ravel().tolist(), lambda v: px.chw_to_hwc(v, H, W, C))
    assert back == flat


def test_flips(spark):
    flat = IMG.ravel().tolist()
    assert arr(spark, flat, lambda v: px.hflip(v, H, W, C)) == IMG[:, ::-1].ravel().tolist()
    assert arr(spark, flat, lambda v: px.vflip(v, H, W, C)) == IMG[::-1].ravel().tolist()


@pytest.mark.parametrize("degrees, turns", [(0.0, 0), (90.0, 1), (180.0, 2), (-90.0, 3)])
def test_rotation(spark, degrees, turns):
    img = np.arange(32, dtype=float).reshape(4, 4, 2)
    got = arr(spark, img.ravel().tolist(), lambda v: px.rotate(v, F.lit(degrees), 4, 4, 2))
    assert got == np.rot90(img, turns).ravel().tolist()


def test_rotation_fills_with_zeros(spark):
    got = np.array(arr(spark, [1.0] * 64, lambda v: px.rotate(v, F.lit(45.0), 8, 8)))
    assert got[0] == got[7] == got[56] == got[63] == 0.0 and got.reshape(8, 8)[3:5, 3:5].all()


def test_bytes_clamp(spark):
    assert arr(spark, [-0.5, 0.0, 0.5, 1.0, 2.0], px.to_bytes) == [0, 0, 127, 255, 255]
    assert arr(spark, arr(spark, [0.2, 0.9], px.normalize), px.denormalize) == pytest.approx([0.2, 0.9])


def test_erasing_blanks_one_rectangle_in_all_channels(spark):
    df = spark.range(50).withColumn("v", F.array_repeat(F.lit(1.0), 2 * 64))
    rows = df.select(px.random_erase(F.col("v"), F.col("id"), 1.0, 42, 8, 8, 2).alias("o")).collect()
    for r in rows:
        a = np.array(r["o"]).reshape(2, 8, 8)
        assert (a[0] == a[1]).all()
        ys, xs = np.where(a[0] == 0)
        assert len(ys) == 0 or len(ys) == (np.ptp(ys) + 1) * (np.ptp(xs) + 1)
    assert sum((np.array(r["o"]) == 0).any() for r in rows) > 40


def test_image_folder(spark):
    path = scratch_path(spark, "tree")
    pixels = [[float((i + 3 * k) % 256) for i in range(64)] for k in range(3)]
    rows = spark.createDataFrame([(0, 7, pixels[0]), (1, 3, pixels[1]), (2, 8, pixels[2])], "vec_id bigint, label int, p array<double>")
    write_image_files(rows, path)
    scan = {(r["path"].rsplit("/", 1)[1], r["class_name"], r["class_idx"]) for r in readers.labelled_folder_scan(spark, path, "*.png").collect()}
    assert scan == {("0.png", "7", 1), ("1.png", "3", 0), ("2.png", "8", 2)}
    seen = readers.decode_images(readers.read_images(spark, path))
    good, bad = seen.where("readable"), seen.where("not readable")
    assert [r["path"].rsplit("/", 1)[1] for r in bad.collect()] == ["1.png"]
    got = {r["path"].rsplit("/", 1)[1]: np.array(r["pixels"]).reshape(8, 8, 3) for r in good.collect()}
    want = np.array(pixels[2]).reshape(8, 8)
    assert set(got) == {"0.png", "2.png"}
    assert (got["2.png"][..., 0] == want).all() and (got["2.png"][..., 1] == 255 - want).all() and (got["2.png"][..., 2] == want // 2).all()


def test_csv_drops_the_stray_column(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(0, 1.5, 'a "b", c')], "i int, x double, s string").coalesce(1).write.csv(path, header=True, escape='"')
    df = readers.csv_scan(spark, path, "i int, x double, s string", drop=("i",))
    assert df.columns == ["x", "s"] and df.first()["s"] == 'a "b", c'


def test_csv_with_line_breaks_in_quotes(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("two\nlines", 3)], "review string, rating int").write.csv(path, header=True, escape='"')
    assert readers.csv_scan(spark, path, "review string, rating int").first() == ("two\nlines", 3)


def test_csv_errors_are_loud(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("3", "x"), ("bad", "y")], "rating string, review string").coalesce(1).write.csv(path, header=True)
    for schema in ("review string, rating string", "rating int, review string"):
        with pytest.raises(Exception):
            readers.csv_scan(spark, path, schema).collect()
    kept = readers.csv_scan(spark, path, "rating int, review string", mode="PERMISSIVE").collect()
    assert {tuple(r) for r in kept} == {(3, "x"), (None, "y")}


def test_images_of_another_size_are_errors(spark):
    for n in (8, 2):
        with pytest.raises(Exception, match="4 values expected"):
            arr(spark, [1.0] * n, lambda v: px.hflip(v, 2, 2, 1))
    assert arr(spark, None, lambda v: px.hflip(v, 2, 2, 1)) is None


def test_unknown_codes_and_steps_stay(spark):
    names = spark.createDataFrame([(1, "a")], "c int, n string")
    got = joins.label_lookup(spark.createDataFrame([(1, 1), (2, 9)], "i int, c int"), names, "c", ["i"]).select("i", "n").collect()
    assert {tuple(r) for r in got} == {(1, "a"), (2, None)}
    steps = spark.createDataFrame([(0, 0.5)], "t int, beta double")
    got = sequences.gather_by_step(spark.createDataFrame([(1, 0), (2, 7)], "i int, t int"), steps, "t", ["beta"]).collect()
    assert {(r["i"], r["beta"]) for r in got} == {(1, 0.5), (2, None)}


def test_read_sequences(spark):
    path = scratch_path(spark, "sequences")
    spark.createDataFrame([([1.0, 2.0], 3), ([5.0], 0)], "seq array<double>, label int").write.parquet(path)
    assert {(tuple(r["seq"]), r["label"]) for r in readers.read_sequences(spark, path).collect()} == {((1.0, 2.0), 3), ((5.0,), 0)}
    assert readers.read_sequences(spark, path, label=None).columns == ["seq"]
