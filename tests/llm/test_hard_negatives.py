import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fitloom.llm import hard_negatives as hn
from fitloom.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string"


def brute(rows, every=5):
    valid = set()
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(e is not None and math.isfinite(e) for e in v):
            valid.add((i, label, tuple(math.floor(256 * float(np.float32(e))) for e in v)))
    out = Counter()
    for i, label, a in valid:
        if i % every:
            continue
        dot = lambda v: sum(p * q for p, q in zip(a, v))  # noqa: E731,B023
        ranked = sorted(((-dot(v), j, m) for j, m, v in valid))
        for s, j, _ in [r for r in ranked if r[2] == label and r[1] != i][:5]:
            hard = [r for r in ranked if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s]
            out.update((i, j, n + 1, r[1], -s, -r[0]) for n, r in enumerate(hard[:3]))
    return out


def mined(spark, rows, every=5, **options):
    frame = spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA)
    return Counter(tuple(r) for r in hn.mine(frame, F.col("vec_id") % every == 0, **options).collect())


def test_random_rows_with_ties(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randint(-2, 2) / 4 for _ in range(5)], rng.randint(0, 3)) for i in range(400)]
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 500


def test_blocks_do_not_change_the_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], rng.randint(0, 2)) for i in range(500)]
    assert mined(spark, rows, block_rows=30) == mined(spark, rows) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (5, [1.0, 0.5], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.1], 2), (3, [0.8, 0.0, 3.0], 2),
        (4, [0.7], 3), (6, [], 3), (7, None, 1), (8, [1.0, None], 2), (9, [nan, 1.0], 2), (11, [inf, 1.0], 2), (None, [1.0, 1.0], 2),
        (12, [1.0, 1.0], None), (10, [0.0, 0.0], 1), (13, [-1.0, -1.0], 2), (10, [0.2, 0.2], 2), (20, [-1.0, 0.0], 1),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and got
    assert mined(spark, []) == Counter()


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**22 + 128 * i), 1.0], i % 2) for i in range(0, 40)]
    assert mined(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="too big|OverflowError|too large"):
        mined(spark, [(i, [1e30], 1) for i in range(6)])


def test_reading_stops_early():
    """Along one strong direction the threshold falls below the kth score before most rows are met."""
    rng = np.random.default_rng(0)
    x = rng.integers(-3, 4, (5000, 8))
    x[:, 0] = rng.integers(-1000, 1000, 5000)
    order = np.argsort(x, axis=0, kind="stable").T
    block = hn.Block(np.arange(5000), np.zeros(5000), x, order, 1000)
    a = np.array([500, 1, 0, 0, 0, 0, -1, 0])
    best, scored = block.first(a, np.ones(5000, bool), [(None, None), (0, 200_000)], 3)
    s = x @ a
    ranked = sorted(range(5000), key=lambda i: (-s[i], i))
    assert best[0] == [(i, s[i]) for i in ranked[:3]]
    assert best[1] == [(i, s[i]) for i in ranked if s[i] <= 200_000][:3]
    assert len(block.first(a, np.ones(5000, bool), [(None, None)], 3)[0][0]) == 3
    assert block.first(a, np.ones(5000, bool), [(None, None)], 3)[1] < 1000 < scored < 5000


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query(spark, folder):
    assert compare(QUERIES["op13_hard_negatives"](spark, folder), connect(folder), ORACLES["op13_hard_negatives"]) == ""
