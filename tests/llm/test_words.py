"""Memory of the word arrays, and of workers between tasks."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from fitloom.llm import words
from fitloom.llm.words import LOWER, SAME, WHITE, tidy, worded


def test_words_of_a_large_batch_take_little_beside_it():
    column = pa.array([" ".join(f"Word{i * j % 977}" for j in range(400)) for i in range(1500)])
    sum(len(w.hashes) for w in worded(column.slice(0, 1)))  # the powers are kept
    tracemalloc.start()
    n = sum(len(w.hashes) for w in worded(column, WHITE, LOWER))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1500 * 400
    assert peak < 12 << 20  # 24 MB with slices of 1 MB


@pytest.mark.parametrize("limit", [1, 100, 1 << 20])
def test_words_are_the_same_whatever_the_slices(limit):
    texts = ["", None, "Eins zwei  drei", "x" * 300 + " y", " \t", "größer Ä é", *[f"a{i} b{i % 7} c" for i in range(50)]]
    column = pa.array(texts)
    whole, parts = list(worded(column, WHITE, SAME, limit=1 << 30)), list(worded(column, WHITE, SAME, limit=limit))
    assert np.concatenate([p.hashes for p in parts]).tolist() == whole[0].hashes.tolist()
    assert np.concatenate([p.counts() for p in parts]).tolist() == whole[0].counts().tolist()


def test_memory_is_given_back_at_the_end_of_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(words, "trimmed", lambda: calls.append(1))

    @tidy
    def run(batches):
        yield from batches

    assert list(run(iter([1, 2]))) == [1, 2]
    assert len(calls) == 1
    begun = run(iter([1, 2]))
    next(begun)
    begun.close()  # a task that ends early, as under a limit
    assert len(calls) == 2
