"""Near-duplicate components against all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from fitloom.llm.components import components
from fitloom.llm import lsh_forest as L
from fitloom.llm.lsh_forest import MISS, Forest, forest, near_duplicates
from fitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4) if w else 0)}


def brute(docs, percent=85):
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    seen = set()
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    x = len(sets[a] & sets[b])
                    if 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                        p, q = sorted((find(a), find(b)))
                        root[q] = p
    return {d: (len(sets[d]), find(d)) for d in sets}


def agree(got, docs, percent=85):
    want = brute(docs, percent)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = QUERIES["op8_near_dedup"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    agree(got, docs)


def test_dense_groups_and_edge_rows(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    docs = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  two"), (6, "a b c d e"), (7, "A b\tc d E")]
    base = [word() for _ in range(80)]
    for i in range(150):  # one dense group with copies further apart than the threshold
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(80)] = word()
        docs.append((100 + i, " ".join(w)))
    chain = [word() for _ in range(200)]
    for i in range(12):  # a chain whose ends are far apart
        chain[10 * i] = word()
        docs.append((500 + i, " ".join(chain)))
    docs.append((900, " ".join(word() for _ in range(30000))))
    frame = spark.createDataFrame([(d, t, 1, b"x") for d, t in docs], "doc_id long, text string, n int, digest binary")
    repeated = frame.union(frame.where("doc_id in (4, 100)")).union(spark.createDataFrame([(None, "one two", 1, b"x")], frame.schema))
    got = near_duplicates(repeated).collect()
    assert len(got) == len(docs) + 3
    assert [tuple(r) for r in got if r.doc_id is None] == [(None, 1, None, False)]
    agree([r for r in got if r.doc_id is not None], docs)
    assert near_duplicates(frame.limit(0)).count() == 0


def test_components_of_a_path(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "a long, b long")
    for local in (0, 1000):
        got = {r.node: r.root for r in components(links, local).collect()}
        assert got == dict.fromkeys(range(1, n), 0)


def test_forest_misses_no_more_at_any_threshold():
    assert forest(85) == Forest(16, 4, 64)
    for percent in (5, 20, 50, 70, 80, 85, 95, 99):
        f = forest(percent)
        assert (1 - (percent / 100) ** f.depth) ** f.trees <= MISS * (1 + 1e-6) and f.trees * f.depth <= f.hashes
    assert forest(100).trees >= 1


def test_depth_adapts_to_dense_prefixes():
    rng = np.random.default_rng(1)
    rows = sorted((0, *(int(v) for v in rng.integers(0, 3, 9))) for _ in range(400)) + sorted((1, *(int(v) for v in rng.integers(0, 3, 9))) for _ in range(20))
    paths = np.array(rows)[:, 1:]
    region = np.array(rows)[:, 0]
    new = np.concatenate(([True], region[1:] != region[:-1]))
    got = L.deeper_firsts(new, paths, 0)
    for i in range(len(rows)):
        for depth in range(min(L.DEEPER, 9) + 1):
            same = [j for j in range(len(rows)) if rows[j][: depth + 1] == rows[i][: depth + 1]]
            if len(same) <= L.DENSE or depth == min(L.DEEPER, 9):
                assert got[i] == same[0]
                break
    assert (got[400:] == 400).all()


@pytest.mark.parametrize("percent", [80, 85])
def test_a_dense_group_makes_few_candidates(spark, monkeypatch, percent):
    """1,500 near copies, many of them too far from each other: candidates stay in proportion to the copies."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(70)]
    common = word()
    docs = []
    for i in range(1500):
        w = list(base)
        w[30] = common  # a difference that all but the first share
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            w[rng.randrange(70)] = word()
        docs.append((i, " ".join(w if i else base)))
    seen = []
    sharing = L._sharing

    def counted(diffs, percent):
        out = sharing(diffs, percent)
        seen.append(out.count())
        return out

    monkeypatch.setattr(L, "_sharing", counted)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = near_duplicates(frame, percent=percent).collect()
    assert seen[0] < 7_500
    agree(got, docs, percent)
