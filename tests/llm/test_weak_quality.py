"""Weak labels: EM recovers known labellers; held-out ratings; rows with gaps."""

import math

import numpy as np
from pyspark.sql import functions as F

from fitloom.llm import weak_quality as Q
from fitloom.llm.queries import QUERIES, ratings

FOLDER = "/root/testdata/sf0.1"


def test_em_recovers_rates():
    rng = np.random.default_rng(0)
    n, m = 40000, len(Q.LABELLERS)
    bad = rng.random(n) < 0.25
    right = np.linspace(0.75, 0.95, m)
    correct = rng.random((n, m)) < right
    spoken = rng.random((n, m)) < 0.8
    votes = np.where(spoken, np.where(correct == bad[:, None], Q.BAD, Q.GOOD), Q.NOTHING)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, rate = Q.em(patterns, counts.astype(float))
    assert abs(share[1] - 0.25) < 0.05
    assert (np.diff(rate[:4, 1, Q.BAD]) > 0).all()  # the better labeller is seen as better
    assert ((Q.posterior(votes, share, rate) > 0.5) == bad).mean() > 0.95


def combined(votes):
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    return patterns, counts.astype(float)


def drawn(rng, n, share, labellers):
    """Votes of labellers (how often they speak, how often they are then right), and the truth."""
    bad = rng.random(n) < share
    votes = np.zeros((n, len(Q.LABELLERS)), int)
    for j, (speaks, right) in enumerate(labellers):
        said = rng.random(n) < speaks
        votes[:, j] = np.where(said, np.where((rng.random(n) < right) == bad, Q.BAD, Q.GOOD), Q.NOTHING)
    return votes, bad


CASES = {
    "honest": [(0.8, 0.9)] * 6,
    "silent rater": [(0.0, 0.5)] * 4 + [(0.9, 0.9), (1.0, 0.98)],
    "rare and wrong": [(0.01, 0.11 + 0.02 * j) for j in range(4)] + [(0.9, 0.8), (1.0, 0.98)],
    "all rare": [(0.02, 0.9)] * 6,
    "one speaks": [(0.0, 0.5)] * 5 + [(1.0, 0.9)],
}


def test_likelihood_never_falls():
    rng = np.random.default_rng(1)
    for name, labellers in CASES.items():
        patterns, counts = combined(drawn(rng, 5000, 0.2, labellers)[0])
        prior = Q.start(patterns, counts)
        values = [Q.likelihood(patterns, counts, *Q.em(patterns, counts, rounds, 0.0), prior) for rounds in range(0, 60)]
        assert all(b >= a - 1e-6 * abs(a) * 1e-3 for a, b in zip(values, values[1:])), name


def test_bad_share_stays_and_wrong_labellers_are_seen():
    rng = np.random.default_rng(2)
    for name in ("silent rater", "rare and wrong"):
        votes, bad = drawn(rng, 20_000, 0.2, CASES[name])
        patterns, counts = combined(votes)
        for rounds in (1, 20, 100, 500):
            share, rate = Q.em(patterns, counts, rounds)
            assert abs(share[1] - 0.2) < 0.02, (name, rounds)
        assert rate[5, 1, Q.BAD] > 0.95 and rate[5, 0, Q.GOOD] > 0.95
        if name == "rare and wrong":
            for j in range(4):
                right = rate[j, 1, Q.BAD] / (rate[j, 1, Q.BAD] + rate[j, 1, Q.GOOD])
                assert right < 0.35, j


def plain_em(votes, rounds):
    """The same steps over single documents, in plain Python."""
    n, m = len(votes), len(votes[0])
    patterns, counts = combined(np.array(votes))
    prior, hold = Q.start(patterns, counts).tolist(), Q.strength(patterns, counts)
    share, rate = [0.8, 0.2], [[list(c) for c in r] for r in prior]
    for _ in range(rounds):
        sums = [[[hold[j] * prior[j][c][v] for v in range(3)] for c in (0, 1)] for j in range(m)]
        total = [Q.PSEUDO * 0.8, Q.PSEUDO * 0.2]
        for row in votes:
            p = [share[c] * math.prod(rate[j][c][row[j]] for j in range(m)) for c in (0, 1)]
            for c in (0, 1):
                w = p[c] / sum(p)
                total[c] += w
                for j in range(m):
                    sums[j][c][row[j]] += w
        share = [t / (n + Q.PSEUDO) for t in total]
        rate = [[[x / sum(cell) for x in cell] for cell in row] for row in sums]
    return share, rate


def test_em_against_plain_python():
    rng = np.random.default_rng(3)
    votes = drawn(rng, 300, 0.3, CASES["honest"])[0]
    share, rate = Q.em(*combined(votes), rounds=12, tolerance=0.0)
    want_share, want_rate = plain_em(votes.tolist(), 12)
    assert np.allclose(share, want_share) and np.allclose(rate, want_rate)


def test_ratings_of_other_documents_take_no_places(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    own = ratings(spark, folder)
    foreign = spark.range(10**9, 10**9 + 200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).alias("bad"))
    alone, mixed = Q.fit(docs, own), Q.fit(docs, own.unionByName(foreign))
    assert (mixed.weights != 0).sum() > 20 and np.allclose(alone.weights, mixed.weights)
    assert np.allclose(alone.rate, mixed.rate)
    few = Q.fit(docs, own, sample_rows=50)
    assert np.array_equal(few.weights, Q.fit(docs.repartition(7), own, sample_rows=50).weights)


def test_held_out_ratings(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(5)))
    model = Q.fit(docs, ratings(spark, FOLDER).join(labels.where("part > 0").select("doc_id"), "doc_id"))
    got = Q.score(docs, model).join(labels.where("part = 0"), "doc_id").toPandas()
    clean = (got.quality == 1) & (got.toxic == 0)
    assert got.rejected[clean].mean() < 0.01
    assert got.rejected[got.quality == 0].mean() > 0.95
    assert got.rejected[got.toxic == 1].mean() > 0.75


def test_edge_rows(spark):
    good = "the quick brown fox walks over the small green hill and sees a river with many old stones by the road "
    texts = {1: None, 2: "", 3: good, 4: good * 3000, 5: "Spam " * 80, 6: "BUY!! NOW!! CHEAP!! OFFER!! " * 9, 7: "a### b$$$ c%%% d*** e&&& " * 9, 8: "you idiot"}
    rows = [(k, v, 5.0, True) for k, v in texts.items()] + [(3, good, 5.0, True), (None, good, 5.0, True)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n double, rejected boolean")
    model = Q.fit(frame)
    got = Q.score(frame, model).collect()
    assert len(got) == len(rows) and got[0].n == 5.0
    weak = {r.doc_id: r.weak_score > 0.5 for r in got}
    assert weak.pop(1) == weak.pop(2)  # no votes: the share of all
    weak.pop(8)  # one abusive text among ten: too few to tell the labeller's accuracy from
    assert weak == {3: False, 4: True, 5: True, 6: True, 7: True, None: False}
    assert len({r.quality_score for r in got if r.text == good}) == 1
    none = frame.limit(0)
    assert Q.score(none, Q.fit(none, none.selectExpr("doc_id", "rejected"))).count() == 0


def test_query_covers_all_rows(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op6_quality"](spark, folder)
    assert got.columns == ["doc_id", "quality_score", "weak_score", "rejected"]
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
