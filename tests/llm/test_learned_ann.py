"""Learned partitions: recall against brute force, exact scores and ties, balanced parts."""

import math

import numpy as np

from fitloom.llm import learned_ann as L
from fitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def brute(ids, x, every=20, k=20):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = (x * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(ids[j], s[j]) for j in order]
    return out


def recall(got, want):
    hit = total = 0
    for q, rows in want.items():
        own = {r.vec_id for r in got if r.query_id == q}
        hit, total = hit + sum(i in own for i, _ in rows), total + len(rows)
    return hit / total


def test_query_recall(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = QUERIES["op4_neighbours"](spark, FOLDER).collect()
    want = brute(ids, x)
    assert recall(got, want) >= 0.9
    place = {i: n for n, i in enumerate(ids)}
    for q in want:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21))
        assert all(abs(r.score - float((x[place[q]] * x[place[r.vec_id]]).sum())) < 1e-12 and r.vec_id != q for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)


def test_parts_are_balanced_and_local():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 12)) * 4
    x = centres[rng.integers(0, 8, 1600)] + rng.normal(size=(1600, 12))
    near = L.graph(x, 10)
    part = L.partition(near, 8)
    size = np.bincount(part)
    assert len(size) == 8 and size.max() - size.min() <= 8
    assert (part[near] == part[:, None]).mean() > 0.5


def test_ties_gaps_and_few_rows(spark):
    same = [0.5, -1.0, 2.0, 0.25]
    rows = [(i, same) for i in range(0, 3000)]  # one vector everywhere: ties go to smaller ids
    rows += [(5000, None), (5020, [0.0] * 4), (5040, [1.0, None, 1.0, 1.0]), (5060, [1.0, math.nan, 0.0, 0.0]), (5080, [math.inf, 0.0, 0.0, 0.0]), (5100, [1.0]), (None, same), (20, same)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, part int, rank int")
    got = L.search(frame).collect()
    want = {q: [i for i in range(22) if i != q][:20] for q in range(0, 3000, 20)}
    assert {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 20, 2980)} == {q: want[q] for q in (0, 20, 2980)}
    assert len(got) == 150 * 20
    few = L.search(frame.where("vec_id in (0, 1, 20, 5000)")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in few) == [(0, 1, 1), (0, 2, 20), (20, 1, 0), (20, 2, 1)]
    assert L.search(frame.limit(0)).count() == 0


def test_recall_beyond_the_sample(spark):
    """Ten times the rows that the router is fitted on; the share of rows that a query meets stays below all."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24)) * 2
    x = (centres[rng.integers(0, 40, 10_000)] + rng.normal(size=(10_000, 24))).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(8)
    got = L.search(frame, every=100, sample_rows=1000).collect()
    want = brute(np.arange(10_000), x.astype(float), every=100)
    assert recall(got, want) >= 0.9 and all(sum(r.query_id == q for r in got) == 20 for q in want)
    router = L.fit(x[:1000].astype(float))
    stored = np.bincount(router.odds(x.astype(float)).argmax(axis=1), minlength=router.odds(x[:1].astype(float)).shape[1])
    met = np.mean([stored[r].sum() for r in router.routes(x[:500].astype(float), stored, 21)]) / 10_000
    assert met < 0.7


def test_every_query_gets_its_rows():
    rng = np.random.default_rng(4)
    router = L.Router(1.0, rng.normal(size=(4, 8)), np.zeros(8), rng.normal(size=(8, 6)) * 5, np.zeros(6), 0.01)
    held = np.array([0, 3, 5, 30, 2, 1])
    for own in router.routes(rng.normal(size=(50, 4)), held, 21):
        assert held[own].sum() >= 21 and (held[own] > 0).all()
