"""Repeated passages against a dictionary of all windows; the index against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from fitloom.llm import substring_index as S
from fitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(docs, k=20):
    first, words = {}, {}
    for d, t in sorted(docs):
        words[d] = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for i in range(len(words[d]) - k + 1):
            first.setdefault(tuple(words[d][i : i + k]), (d, i))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < (d, i):
                gone |= set(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def agree(rows, docs):
    want = brute(docs)
    assert {(r.doc_id, (r.n_words, r.n_removed, r.kept_sha256)) for r in rows} == set(want.items())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = QUERIES["op3_repeats"](spark, FOLDER).collect()
    assert len(got) == len(docs) and any(r.n_removed for r in got)
    agree(got, docs)


def test_backward_search_counts():
    rng = np.random.default_rng(3)
    text = np.concatenate([np.concatenate((rng.integers(1, 4, 60), [0])) for _ in range(5)])
    index = S.FMIndex(text)
    for _ in range(300):
        a = int(rng.integers(0, 50))
        pattern = text[a : a + int(rng.integers(1, 12))] if rng.random() < 0.7 else rng.integers(1, 4, 5)
        lo, hi = np.array([0]), np.array([len(text)])
        for c in pattern[::-1]:
            lo, hi = index.step(np.array([c]), lo, hi)
        starts = [i for i in range(len(text) - len(pattern) + 1) if (text[i : i + len(pattern)] == pattern).all()]
        if 0 not in pattern:
            assert hi[0] - lo[0] == len(starts)
            assert sorted(index.order[lo[0] : hi[0]]) == starts


@pytest.mark.parametrize("hot", [3, 1000])
def test_planted_passages(spark, hot):
    rng = random.Random(hot)
    vocabulary = [f"w{i}" for i in range(2000)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    line, passage, long = words(12), words(25), words(60)
    docs = [(0, None), (1, ""), (2, " \t\n"), (3, "x " * 19), (4, "x " * 60), (5, "a b " * 40), (6, "É\x85é " * 30)]
    for i in range(60):
        body = words(rng.randrange(0, 80))
        for extra, p in ((line, 0.7), (passage, 0.5), (long, 0.3), (long[5:40], 0.2)):
            if rng.random() < p:
                at = rng.randrange(len(body) + 1)
                body[at:at] = extra
        docs.append((10 + i, " ".join(body)))
    docs += [(100 + i, docs[20][1]) for i in range(30)]
    docs.append((200, " ".join(words(15000) + long)))
    rng.shuffle(docs)
    frame = spark.createDataFrame([(*d, 1, b"x", True) for d in docs], "doc_id long, text string, n int, words binary, hot boolean")
    got = S.remove_repeats(frame.union(frame.where("doc_id in (4, 12)")), shard_words=500, hot_passages=hot).collect()
    assert len(got) == len(docs) + 2
    agree(got, docs)
    none = S.remove_repeats(spark.createDataFrame([(None, " ".join(passage)), (None, " ".join(passage)), (7, "a  b")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept if r.doc_id else "") for r in none) == [(0, 25, 0, ""), (0, 25, 0, ""), (7, 2, 0, "a b")]
    assert S.remove_repeats(frame.limit(0)).count() == 0
