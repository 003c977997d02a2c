import random
import zlib

import pytest
from pyspark.sql import functions as F

from fitloom.llm import spelling_variants as sv
from fitloom.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


def near(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    x, y = sorted((x, y), key=len)
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return any(x == y[:i] + y[i + 1 :] for i in range(len(y)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        out[w] = (best if best is not None and counts[best] >= 2 * n else None, n, len(close))
    return out


def root(table, w):
    while table[w][0] is not None:
        w = table[w][0]
    return w


def check(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n int")
    got = {r.word: r for r in sv.group_variants(words).collect()}
    want = brute(counts)
    assert set(got) == set(want)
    for w, (form, n, n_near) in want.items():
        r = got[w]
        assert (r.form, r.n, r.n_near, r.root, r.form_n) == (form, n, n_near, root(want, w), counts.get(form)), w


def test_random_words_against_all_pairs(spark):
    rng = random.Random(3)
    counts = {}
    for _ in range(900):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(1, 7)))
        counts[w] = rng.choice([1, 1, 2, 3, 4, 9, 20, 41])
    check(spark, counts)


def test_one_edit_at_every_place(spark):
    counts = {"extraordinary": 50, "aaaaaa": 8, "aaaaa": 3, "überÿ": 4, "uberÿ": 9}
    for i in range(13):
        counts["extraordinary"[:i] + "extraordinary"[i + 1 :]] = 5
        counts["extraordinary"[:i] + "x" + "extraordinary"[i:]] = 6
        counts["extraordinary"[:i] + "z" + "extraordinary"[i + 1 :]] = 7
    check(spark, counts)


def test_chain_and_ties(spark):
    check(spark, {"house": 1, "mouse": 2, "moose": 4, "loose": 8, "louse": 8, "loüse": 1})


def test_shared_chunk_makes_few_candidates(spark):
    """2,000 words with one first half meet on longer keys, not in all their pairs."""
    rng = random.Random(5)
    words = {"prefixed" + "".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(2000)}
    words |= {w[:12] + "z" + w[13:] for w in list(words)[:50]}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = {tuple(r) for r in sv.near_pairs(frame).collect()}
    listed = sorted(words)
    assert got == {(a, b) for i, a in enumerate(listed) for b in listed[i + 1 :] if near(a, b)}


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 2), (None, "hello hello", 3), (3, "Hello, HÉLLO 3x" + " word" * 100_000, 4), (3, "hello", 5)],
        "doc_id long, text string, n int",
    )
    found = sv.runs(docs, least=1)
    assert sorted(found.groupBy("run").count().collect()) == [("hello", 4), ("hÉllo", 1), ("word", 100_000), ("x", 1)]
    assert sv.with_slips(found.where("doc_id is null")).distinct().collect() == [("hello",)]
    assert sv.vocabulary(found.select(F.col("run").alias("word"))).collect() == [("hello", 4)]
    none = sv.group_variants(spark.createDataFrame([], "word string, n int"))
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"] and none.count() == 0


def test_slips(spark):
    found = spark.createDataFrame([(i, "straße") for i in range(2000)], "doc_id long, run string")
    want = []
    for i in range(2000):
        h = zlib.crc32(f"{i}:straße".encode())
        want.append("straße"[: h % 6] + "straße"[h % 6 + 1 :] if h % 97 == 0 else "straße")
    assert [r.word for r in sv.with_slips(found).collect()] == want and len(set(want)) > 2


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    assert compare(QUERIES["op11_spelling"](spark, folder), connect(folder), ORACLES["op11_spelling"]) == ""
