"""Patience alignment: against brute force on short sequences, and planted notices in whole texts."""

import random
from itertools import combinations

from fitloom.llm import license_align as L
from fitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_longest_increasing():
    rng = random.Random(1)
    for _ in range(200):
        v = rng.sample(range(20), rng.randrange(0, 9))
        got = [v[i] for i in L.increasing(v)]
        best = max((k for k in range(len(v) + 1) for c in combinations(v, k) if list(c) == sorted(c)), default=0)
        assert got == sorted(got) and len(got) == best


def test_alignment_is_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice([b"x", b"y", b"z", b"u", b"v", b"w"]) for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        if len(set(a)) == len(a) and len(set(b)) == len(b):  # all words are anchors: the longest is found
            best = max(k for k in range(len(a) + 1) for c in combinations(a, k) if all(w in b for w in c) and [b.index(w) for w in c] == sorted(b.index(w) for w in c))
            assert len(pairs) == best
    same = [str(i % 7).encode() for i in range(3000)]
    assert len(L.align(same, same)) == 3000


def test_rows(spark):
    notice = L.TEMPLATES["Apache-2.0-text"]
    edited = notice.replace("compliance with the License", "full compliance with this License").replace("obtain", "get")
    rows = [(1, None), (2, ""), (3, "é ü " + notice + " tail"), (4, edited), (5, "released the license under mit rain " * 3 + "of the under license " * 4000),
            (6, "word " * 20000 + "Released under the MIT License. " + "word " * 50 + "RELEASED under the mit license!"), (7, "the of is under to a"), (3, "é ü " + notice + " tail")]
    frame = spark.createDataFrame([(*r, 7, "l") for r in rows], "doc_id long, text string, start int, license string")
    got = L.scan(frame).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[3].license == "Apache-2.0-text" and by[3].coverage == 1.0 and rows[2][1][by[3].start : by[3].stop] == notice
    assert "Apache-2.0-text" in by[4].licenses and "MIT" in by[6].licenses and by[6].coverage == 1.0
    for i in (1, 2, 7):
        assert by[i].license is None and by[i].licenses == []
    assert L.scan(frame.limit(0)).count() == 0


def test_query_finds_every_notice(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_licenses"](spark, FOLDER).collect()}
    assert len(got) == len(texts)
    lines = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    for i, t in texts.items():
        have = {k for k, v in lines.items() if v in t}
        assert have <= set(got[i].licenses)
        assert bool(have) == bool(got[i].licenses)


def test_adjacent_copies():
    matcher = L.Matcher(L.TEMPLATES, L.COVERAGE)
    for name, notice in L.TEMPLATES.items():
        n = len(L.normal(notice.encode()))
        for text, first in (
            (f"word {notice} {notice} word", 1),
            (f"{notice} {notice} {notice}", 0),
            (f"word {notice} a few words between {notice}", 1),
            (f"{notice} " * 40 + "word " * 100 + notice, 0),
        ):
            got = {m[0]: m[1:] for m in matcher.best(text.encode())}
            assert got[name] == (1.0, first, first + n), (name, text[:80])
    # rarer words of the template chain two notices, and each copy has a word changed
    notice = L.TEMPLATES["GPL-3.0-text"]
    chain = " as can software version are program published"
    text = (notice.replace("later", "newer") + chain * 30 + " " + notice.replace("hope", "wish").replace("redistribute", "copy")).encode()
    assert "GPL-3.0-text" in {m[0] for m in matcher.best(text)}


def test_best_window_against_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        words = [rng.choice([b"x", b"y", b"z", b"u", b"v"]) for _ in range(rng.randrange(1, 30))]
        template = [rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randrange(1, 4))]
        span, least = 2 * len(template) + L.GAP, rng.randrange(1, len(template) + 1)
        want = None
        for a in range(len(words)):
            for b in range(a + 1, min(len(words), a + span) + 1):
                row = [0] * (len(template) + 1)
                for w in words[a:b]:
                    for j in range(len(template), 0, -1):
                        if w == template[j - 1]:
                            row[j] = max(row[j], row[j - 1] + 1)
                    for j in range(1, len(template) + 1):
                        row[j] = max(row[j], row[j - 1])
                if row[-1] >= least and (want is None or (row[-1], a - b, -a) > (want[0], want[1] - want[2], -want[1])):
                    want = (row[-1], a, b)
        assert L.best_window(words, template, least) == want


def names(text):
    return {L.licence(m[0]) for m in L.Matcher(L.TEMPLATES, L.COVERAGE).best(text.encode())}


def test_sisters_are_told_apart():
    for text, want in {
        "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL-3.0"},
        "This work is licensed under the GNU Affero General Public License, version 3.": {"AGPL-3.0"},
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0"},
        "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0"},
        "This work is licensed under the GNU Library General Public License, version 2.": set(),
        L.TEMPLATES["GPL-3.0-text"].replace("version 3", "version 2"): {"GPL-2.0"},
        "Licensed under CC BY 4.0.": {"CC-BY-4.0"},
        "Licensed under CC BY-NC-ND 4.0.": {"CC-BY-NC-ND-4.0"},
        "CC BY-NC-ND 4.0": set(),  # three quarters of the statement
        "Licensed under CC BY-NC 3.0.": set(),
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": {"CC-BY-NC-4.0"},
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": {"CC-BY-NC-SA-4.0"},
        "Released under the BSD License.": {"BSD"},
        "Released under the Foo License.": set(),
        "Available under the MIT License.": {"MIT"},
        "Licensed under the Apache License, Version 1.1.": set(),
        "Licensed under the Mozilla Public License, Version 2.0.": {"MPL-2.0"},
        L.TEMPLATES["BSD-2-Clause-text"]: {"BSD-2-Clause"},
        L.TEMPLATES["BSD-3-Clause-text"]: {"BSD-3-Clause"},
        L.TEMPLATES["BSD-text"]: {"BSD"},
        "Under the GNU Lesser General Public License version 3. This work is licensed under the GNU General Public License version 2.": {"GPL-2.0"},
    }.items():
        assert names(text) == want, text


def test_every_template_is_found_alone():
    for name, notice in L.TEMPLATES.items():
        assert names(f"some words before {notice} and words after") == {L.licence(name)}, name


def test_two_licences_in_one_text():
    lines = [L.TEMPLATES[k] for k in ("MIT", "CC-BY-4.0", "CC-BY-NC-4.0", "GPL-3.0", "LGPL-3.0")]
    assert names(" ".join(lines)) == {"MIT", "CC-BY-4.0", "CC-BY-NC-4.0", "GPL-3.0", "LGPL-3.0"}
    matcher = L.Matcher({"b": "one two three", "a": "one two three"}, 0.8)
    assert [m[0] for m in matcher.best(b"x one two three")] == ["a"]
