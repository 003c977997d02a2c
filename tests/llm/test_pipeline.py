"""Each stage of the pipeline against plain Python on the same input."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from fitloom.llm import secret_crf
from fitloom.llm.store import saved
from fitloom.llm.queries import QUERIES
from tests.llm.test_decontaminate import words
from tests.llm.test_lsh_forest import brute, shingles
from tests.llm.test_packing import check
from tests.llm.test_secret_crf import plain

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    rejected = {r.doc_id for r in QUERIES["op6_quality"](spark, FOLDER).where("rejected").collect()}
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "packing"]
    rows = {r.doc_id: r for r in docs.collect()}
    want, got = dict(rows), docs
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    grams = {tuple(v[i : i + 10]) for v in (words(r.text) for r in items) for i in range(max(1, len(v) - 9) if v else 0)}
    for name, stage in P.STAGES:
        got = saved(stage(spark, got, FOLDER), "test")
        if name == "quality":
            want = {i: r for i, r in want.items() if i not in rejected}
        elif name == "near_dedup":
            own = brute([(i, r.text) for i, r in want.items()], P.NEAR_PERCENT)
            want = {i: r for i, r in want.items() if own[i][1] == i}
        elif name == "decontaminate":
            n = {len(g) for g in grams}
            clean = lambda w: not any(tuple(w[i : i + k]) in grams for k in n for i in range(len(w) - k + 1))  # noqa: E731,B023
            want = {i: r for i, r in want.items() if clean(words(r.text))}
        elif name == "secrets":
            texts = {r.doc_id: r.text for r in got.collect()}
            assert set(texts) == set(want)
            for i, r in want.items():
                assert not plain(texts[i]) and (plain(r.text) or texts[i] == r.text or "[secret]" in texts[i])
            continue
        else:
            assert check(got.drop("ids").collect(), texts) == 0
            continue
        assert got.columns == columns
        assert {r.doc_id: r for r in got.collect()} == want and got.count() == len(want)
    assert len(want) < len(rows)


def test_stages_take_gaps_and_no_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = docs.limit(3).withColumns({"text": F.lit(None).cast("string")}).union(docs.limit(2).withColumn("doc_id", F.lit(None).cast("bigint")))
    for frame, left in ((odd, 5), (docs.limit(0), 0)):
        for _, stage in P.STAGES[:-1]:
            frame = saved(stage(spark, frame, FOLDER), "test")
            assert frame.columns == docs.columns and frame.count() == left
        assert saved(P.STAGES[-1][1](spark, frame, FOLDER), "test").where("start = 0").count() == left


def test_rows_of_one_id_and_clashing_columns(spark):
    long_text = " ".join(f"w{i}" for i in range(300_000))
    rows = [(1, "one two three four five six"), (1, "seven eight nine ten eleven twelve"), (2, "one two three four five six"), (3, ""), (3, ""), (None, "seven eight nine ten eleven twelve"), (None, "a b c d e f"), (4, long_text), (4, long_text)]
    extra = ["n_chars", "quality_score", "weak_score", "rejected", "n_words", "n_hit", "items", "spans", "__scan", "__row", "n", "component_id", "kept", "base", "found"]
    docs = spark.createDataFrame([(*r, *["own"] * len(extra)) for r in rows], ["doc_id", "text", *extra]).withColumn("n_chars", F.length("text"))
    want = {"near_dedup": [0, 1, 3, 4, 6, 7]}
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, docs, FOLDER)
        assert got.columns == docs.columns
        found = sorted((tuple(r) for r in got.collect()), key=str)
        all_rows = [tuple(r) for r in docs.collect()]
        assert found == sorted([all_rows[i] for i in want.get(name, range(len(rows)))], key=str), name


def test_redaction_keeps_the_rest(spark):
    frame = spark.createDataFrame([(1, "a password: abcdefghi b")], "doc_id long, text string")
    assert secret_crf.redact(frame, secret_crf.Field.empty()).first().text == "a [secret] b"


def test_near_dedup_drops_pairs_from_80_percent(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    texts, want = {}, {}
    for k in range(150):
        # n + 4 words have n shingles; an edit at the end takes one from each text for every word changed
        n, lost = [(200, 21), (200, 22), (100, 10), (100, 11), (200, 23), (100, 12)][k % 6]
        base = [word() for _ in range(n + 4)]
        other = base[: n + 4 - lost] + [word() for _ in range(lost)]
        texts[2 * k], texts[2 * k + 1] = " ".join(base), " ".join(other)
        a, b = shingles(texts[2 * k]), shingles(texts[2 * k + 1])
        share = len(a & b) / len(a | b)
        assert 0.77 < share < 0.84
        want[2 * k + 1] = share < 0.8
    assert 40 < sum(want.values()) < 60
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id for r in P.near_dedup(spark, docs, FOLDER).collect()}
    assert got == {2 * k for k in range(150)} | {i for i, stays in want.items() if stays}
