import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fitloom.llm import ppm
from fitloom.llm.queries import QUERIES
from fitloom.sources.readers import table

WHITE = " \t\n\v\f\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    for c in WHITE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


class Model:
    """The trie as a plain dictionary of every context."""

    def __init__(self, texts, order):
        self.order, self.trie = order, defaultdict(Counter)
        level = Counter(step for t in texts for step in self.steps(t))
        for _ in range(order + 1):
            for (context, s), n in level.items():
                self.trie[context][s] = n
            level = Counter((context[1:], s) for context, s in level)

    def steps(self, text):
        data = bytes([ppm.BEGIN] * self.order) + lower(text).encode() + bytes([ppm.END])
        return [(data[i - self.order : i], data[i]) for i in range(self.order, len(data))]

    def p(self, context, s):
        out, p = set(), 1.0
        for k in range(self.order, -1, -1):
            here = {c: n for c, n in self.trie.get(context[len(context) - k :], {}).items() if c not in out}
            total = sum(here.values())
            if s in here:
                return p * (2 * here[s] - 1) / (2 * total)
            if here:
                p *= len(here) / (2 * total)
            out |= set(here)
        return p / (256 - len(out))

    def score(self, text):
        return sum(math.log10(self.p(c, s)) for c, s in self.steps(text))


def brute(rows, order):
    train = [t for _, t, learn in rows if learn]
    model = Model(train, order)
    c = Counter(w for t in train for w in words(lower(t)))
    n, ends = sum(c.values()) + len(train), len(train)
    v = len(c) + (ends > 0)
    base = lambda k: math.log10((k + 0.1) / (n + 0.1 * (v + 1)))
    out = []
    for i, t, learn in rows:
        w = words(lower(t))
        known = sum(c[x] > 0 for x in w) + (ends > 0)
        out.append((i, not learn, len(w) + 1, known, n, sum(base(c[x]) for x in w) + base(ends), model.score(t)))
    return out


def key(row):
    return (row[0] is None, row[0] or 0, row[2], round(row[6], 6))


def check(spark, rows, order=ppm.ORDER, **options):
    frame = spark.createDataFrame([(i, t, learn, 1.0, "x") for i, t, learn in rows], "doc_id long, text string, learn boolean, score double, gram string")
    got = sorted((tuple(r) for r in ppm.score(frame.repartition(3), F.col("learn"), order=order, **options).collect()), key=key)
    want = sorted(brute(rows, order), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def sample(n, seed):
    rng = random.Random(seed)
    parts = ["the ", "Ä", "cat", " and", "\n", "straße ", "ing ", "zq", "  ", "日本"]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))), i % 4 > 0) for i in range(n)]


@pytest.mark.parametrize("order", [0, 1, 2, 5, 6])
def test_against_a_dictionary(spark, order):
    check(spark, sample(60, order), order)


def test_many_blocks(spark):
    check(spark, sample(80, 9), block_bytes=200)


def test_probabilities_of_a_context_add_up():
    model = Model(["abracadabra", "abc", ""], 3)
    for context in (b"abr", b"xyz", b"zab", bytes([ppm.BEGIN] * 3)):
        assert sum(model.p(context, s) for s in range(256)) == pytest.approx(1)


def test_edges(spark):
    check(spark, [(1, None, True), (1, None, True), (2, "", False), (None, "word word", False), (4, "a " * 50_000, True), (4, "b", True), (5, "ÿ\x00", False)])
    check(spark, [(1, "nothing learned", False), (2, None, False)])
    assert ppm.score(spark.createDataFrame([], "doc_id long, text string"), F.lit(True)).count() == 0


def test_query_against_a_dictionary(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 10 != 0) for r in table(spark, folder, "documents").collect()]
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_lm_score"](spark, folder).collect()}
    for w in brute(rows, ppm.ORDER):
        assert got[w[0]][:5] == w[:5] and got[w[0]][5:] == pytest.approx(w[5:], rel=1e-9)
    assert any(r[1] for r in got.values())


def test_held_out_texts_are_likelier_than_by_words(spark):
    held = [r for r in QUERIES["op12_lm_score"](spark, "/root/testdata/sf0.1").collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
