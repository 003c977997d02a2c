"""Pattern spans by plain regular expressions, decoding by brute force, pruning without effect."""

import hashlib
import itertools
import re

import numpy as np

from fitloom.llm import secret_crf as S
from fitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    kinds = [
        [m for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[2]) >= 6],
        [m for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        [m for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24],
    ]
    return sorted((m.start(), k, m.end()) for k, found in enumerate(kinds) for m in found)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op7_secrets"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        line = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
    assert any(r.n_assign for r in got)


def random_field(rng):
    f = S.Field.empty()
    for w in f.parts():
        w += rng.normal(0, 1, w.shape)
    return f


def test_viterbi_and_pruning():
    rng = np.random.default_rng(5)
    for turn in range(30):
        f = random_field(rng)
        f.shape[:, 1:] -= 5 + turn % 3
        step, first = f.steps()
        for _ in range(20):
            n = int(rng.integers(1, 6))
            shape, cues, file = rng.integers(0, S.N_SHAPES, n), np.concatenate(([0, 0], rng.integers(0, 4, n), [0])), int(rng.integers(0, S.N_FILES))
            score = f.scores(shape, cues, file)
            value = lambda p: first[p[0]] + sum(score[i, y] for i, y in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:]))  # noqa: E731,B023
            best = max(itertools.product(range(3), repeat=n), key=value)
            tags = f.decode(shape, cues, file)
            assert abs(value(tags) - value(best)) < 1e-9
            able = int((cues % 2 == 1).any()) + 2 * int((cues == 2).any())
            if not f.hopeful()[file, able][shape].any():
                assert not any(tags)


def test_field_learns_and_rows_with_gaps(spark):
    rng = np.random.default_rng(2)
    key = lambda: "".join(rng.choice(list("ABCDEFGHJKMNPQ23456789xyzuvw"), 28))
    docs = [(i, f"some plain words here token = {key()} and more plain words é follow") for i in range(300)]
    docs += [(1000 + i, "only plain words stand in this text, nothing else to see " * 3) for i in range(300)]
    model = S.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    secret = key()
    cases = [(1, f"ümlaut  the token is {secret} here"), (2, None), (3, ""), (4, "plain words stand in this text"), (5, f"token = {secret}"),
             (5, f"token = {secret}"), (6, "plain words " * 20000 + f'PASSWD: "{secret}"'), (7, "ſecret=abcdefgh toKen=abcdefgh AKIA" + "Z" * 16)]
    frame = spark.createDataFrame([(a, b, 1, "x") for a, b in cases], "doc_id long, text string, base int, kind string")
    got = S.scan(frame, model).collect()
    assert len(got) == len(cases) and got[0].kind == "x"
    texts = dict(cases)
    for r in got:
        assert [(s.start, S.KINDS.index(s.kind), s.stop) for s in r.base] == plain(texts[r.doc_id])
    assert [(s.kind, texts[1][s.start : s.stop]) for s in got[0].found] == [("field", secret)]
    assert got[3].found == [] == got[1].found
    clean = {r.doc_id: r for r in S.redact(frame, model).collect()}
    assert clean[2].text is None and clean[1].text == "ümlaut  the token is [secret] here" and clean[4].text == texts[4]
    assert secret not in clean[5].text and clean[5].base == 1
    assert S.scan(frame.limit(0), S.fit(frame.limit(0))).count() == 0


def test_copies_take_no_places(spark, monkeypatch):
    docs = [(i, "some plain words here token = ABCDEFGHJKMNPQRSTUVWXYZ23456 and more") for i in range(3000)]
    docs += [(5000 + i, f"other words stand {'here ' * i} password: abcdefgh{i}xyz then") for i in range(40)]
    rows = []
    monkeypatch.setattr(S, "train", lambda got: rows.extend(got) or S.Field.empty())
    S.fit(spark.createDataFrame(docs, "doc_id long, text string"), windows=30)
    counts = sorted(r["count"] for r in rows)
    assert len(rows) == len({(tuple(r["shape"]), tuple(r["cue"]), r["file"]) for r in rows}) > 1
    assert counts[-1] >= 3000 and counts[0] < 3000
