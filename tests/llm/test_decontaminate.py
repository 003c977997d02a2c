"""Benchmark passages against a word-by-word comparison."""

import hashlib
import random
import re
import tracemalloc

import pytest

from fitloom.llm.decontaminate import build, find_leaks, normal, scan
from fitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, k=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        v = words(body)
        for i in range(max(1, len(v) - k + 1) if v else 0):
            g = v[i : i + k]
            for j in range(len(w) - len(g) + 1):
                if w[j : j + len(g)] == g:
                    hit |= set(range(j, j + len(g)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_edge_rows(spark):
    items = [(1, "Red-green BLUE"), (2, None), (3, "!!"), (None, "red"), (10, "é one two three four five six seven eight nine ten"), (2, "blue")]
    docs = [(1, "x red, Green\tblue y"), (2, None), (3, ""), (4, "infrared green blue"), (5, "É é ONE two three four-five six seven eight nine ten"),
            (6, "red green red green blue blue"), (6, "red green red green blue blue"), (7, "red " * 20000 + "green blue")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(a, b, 9, "z") for a, b in docs], "doc_id long, text string, n_words int, items string")
    got = find_leaks(frame, bench).collect()
    texts = dict(docs)
    assert len(got) == len(docs)
    for r in got:
        n, hit, found = brute(texts[r.doc_id], [i for i in items if i[0] is not None]) if r.doc_id != 7 else (20002, 3, ["1", "2"])
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, found), r.doc_id
        assert len(words("|".join(texts[r.doc_id][s.start : s.stop] for s in r.spans) if r.spans else "")) == hit
    assert find_leaks(frame.limit(0), bench).count() == 0
    assert find_leaks(frame, bench.limit(0)).where("n_hit > 0").count() == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    windows = {}
    for item, body in items:
        v = words(body)
        for i in range(max(1, len(v) - 9) if v else 0):
            windows.setdefault(tuple(v[i : i + 10]), set()).add(str(item))
    lengths = {len(k) for k in windows}
    got = {r.doc_id: r for r in QUERIES["op10_decontaminate"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for d in docs:
        w, hit, found = words(d.text), set(), set()
        for n in lengths:
            for j in range(len(w) - n + 1):
                ids = windows.get(tuple(w[j : j + n]))
                if ids:
                    hit |= set(range(j, j + n))
                    found |= ids
        r = got[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    assert any(r.contaminated for r in got.values())


@pytest.mark.parametrize("window", [1, 2, 3, 4, 5, 10])
def test_chunks_lose_no_window(window):
    rng = random.Random(window)
    for _ in range(150):
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 14)))) for i in range(rng.randrange(1, 6))]
        text = " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 40)))
        n, hit, found, spans = scan(text.encode(), build(items, window))
        assert (n, hit, found) == brute(text, items, window)
        assert len(words(" ".join(text[s["start"] : s["stop"]] for s in spans))) == hit


def test_megabytes_of_items_stay_small():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(30_000)]
    items = [(str(i), " ".join(rng.choices(vocabulary, k=120))) for i in range(3000)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    automaton = build(items, 10)
    assert tracemalloc.get_traced_memory()[1] < 60 * size  # while it is built; the automaton's own nodes come on top
    tracemalloc.stop()
    assert len(automaton.automaton) <= size / 5 and automaton.automaton.get_stats()["total_size"] < 40 * size
    body = normal(items[7][1])
    n, hit, found, _ = scan(b"x " + b" ".join(body[11:40]) + b" y", automaton)
    assert (n, hit, found) == (31, 29, ["7"])


def test_parts_give_the_same(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.choice([0, 3, 8, 12, 25])))) for i in range(40)]
    docs = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 120)))) for i in range(60)] + [(7, None), (None, "a b c")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    frame = spark.createDataFrame([(a, b, 9, "z") for a, b in docs], "doc_id long, text string, n_words int, item string")
    whole, parts = find_leaks(frame, bench, window=4).collect(), find_leaks(frame, bench, window=4, part_bytes=100)
    assert parts.columns == ["doc_id", "item", "n_words", "n_hit", "items", "spans"]
    assert sorted(map(str, whole)) == sorted(map(str, parts.collect())) and any(r.n_hit for r in whole)
