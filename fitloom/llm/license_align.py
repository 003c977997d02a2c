"""License notices in texts by patience alignment with templates.

Words that occur once in a stretch of text and once in the template are anchors; the longest run of anchors
in the same order is kept, and the gaps between them are aligned in the same way. Coverage is the share of
the template's words that are aligned. A text is cut into stretches around the template's rarer words, so
that a second notice elsewhere does not hide the first. Where copies lie so close that they share a stretch, their
words are no anchors; the best window of such a stretch is found by a longest common subsequence.

Sister licences differ in a word or two, so coverage alone does not tell them apart. The words that decide (names,
versions, conditions) must all be aligned, and a deciding word of another licence ends a stretch. Of notices of different
licences on the same words the one with most aligned less unaligned words, of template and text, stays.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fitloom.llm.decontaminate import IS_GAP, NORMAL

COVERAGE = 0.8
GAP = 12

# Usual statements, file notices and texts of common licences.
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met"
)
_BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES"
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": _GRANT,
    "ISC": "Released under the ISC License.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "MPL-2.0-text": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-text": _GNU.format("General", 3),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-text": _GNU.format("General", 2),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-text": _GNU.format("Lesser General", 3),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-text": _GNU.format("Lesser General", "2.1"),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-text": _GNU.format("Affero General", 3),
    "BSD": "Released under the BSD License.",
    "BSD-text": _BSD,
    "BSD-2-Clause-text": f"{_BSD}: {_BSD_CLAUSES} {_BSD_DISCLAIMER}",
    "BSD-3-Clause-text": f"{_BSD}: {_BSD_CLAUSES} {_BSD_NAMES} {_BSD_DISCLAIMER}",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means.",
} | {
    f"CC-BY{short}-4.0{form}": line
    for short, name in (("", ""), ("-NC", "-NonCommercial"), ("-SA", "-ShareAlike"), ("-ND", "-NoDerivatives"),
                        ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"))
    for form, line in (("", f"Licensed under CC BY{short} 4.0."), ("-text", f"This work is licensed under a Creative Commons Attribution{name} 4.0 International License."))
}
# Words that decide between licences. Those of a template must be aligned; others may not stand inside a notice.
DECIDING = frozenset("mit isc apache mozilla gnu lesser library affero bsd cc nc nd sa noncommercial noderivatives sharealike".encode().split())
# Version numbers, which must be aligned where a template has them.
VERSIONS = frozenset("1 2 3 4".encode().split())
# Words too common to point to a notice.
COMMON = frozenset("a an and any at be by following for in is it may not of on or that the this to under use with you".encode().split())


def normal(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence of different values, by patience sorting."""
    tops, at, back = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        tops[k:k + 1], at[k:k + 1] = [v], [i]
        back.append(at[k - 1] if k else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Aligned places (in the text, in the template), in order.

    Where a gap has no anchor, its equal beginnings and ends are aligned. Gaps are kept on a
    list, so depth is no limit.
    """
    pairs, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: j for j, w in enumerate(template[c:d], c) if there[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(text[a:b], a) if here[w] == 1 and w in place]
        anchors = [anchors[k] for k in increasing([j for _, j in anchors])]
        if not anchors:
            while a < b and c < d and text[a] == template[c]:
                pairs.append((a, c))
                a, c = a + 1, c + 1
            while a < b and c < d and text[b - 1] == template[d - 1]:
                b, d = b - 1, d - 1
                pairs.append((b, d))
            continue
        pairs += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(pairs)


def stretches(words: list[bytes], rare: frozenset, margin: int, barred: frozenset = frozenset()) -> Iterator[tuple[int, int]]:
    """Parts of the text with rare words of the template no more than ``GAP`` words apart, and a margin; none holds a barred word."""
    ends = [i for i, w in enumerate(words) if w in barred] if barred else []
    places = [i for i, w in enumerate(words) if w in rare]
    start = 0
    for k in range(1, len(places) + 1):
        here = bisect_left(ends, places[k - 1])
        apart = k == len(places) or places[k] - places[k - 1] > GAP or bisect_left(ends, places[k]) != here
        if apart:
            low = ends[here - 1] + 1 if here else 0
            high = ends[here] if here < len(ends) else len(words)
            yield max(low, places[start] - margin), min(high, places[k - 1] + 1 + margin)
            start = k


def best_window(words: list[bytes], template: list[bytes], least: int) -> tuple[int, int, int] | None:
    """(aligned, first, end) of the window with the longest common subsequence with the template, if ``least`` long.

    A window has at most twice the template's words and ``GAP`` more. Of equally good ones the shortest counts,
    then the first. One pass: for each length and each beginning of the template the latest start is kept.
    """
    n = len(template)
    span = 2 * n + GAP
    places: dict[bytes, list[int]] = {}
    for j in range(n - 1, -1, -1):  # later places first, so that none is used twice by one word
        places.setdefault(template[j], []).append(j + 1)
    starts = np.full((n + 1, n + 1), -span - 1, np.int64)  # [length, words of the template so far]
    best = None
    for i, word in enumerate(words):
        if word not in places:
            continue
        starts[0] = i
        for j in places[word]:
            np.maximum(starts[1:, j:], starts[:-1, j - 1, None], out=starts[1:, j:])
        if starts[least, n] <= i - span:
            continue
        length = int(np.flatnonzero(starts[:, n] > i - span)[-1])
        first = int(starts[length, n])
        if best is None or (length, first - i) > (best[0], best[1] - best[2] + 1):
            best = (length, first, i + 1)
    return best


def licence(template: str) -> str:
    """The licence that a template stands for: its statement and its text are of one licence."""
    return template.removesuffix("-text")


class Matcher:
    def __init__(self, templates: dict[str, str], coverage: float):
        self.templates = []
        for name, text in templates.items():
            words = normal(text.encode())
            rare = frozenset(words) - COMMON
            # a word of the template can be aligned once, so this many different rare words are needed
            spare = len(words) - sum(1 for w in words if w in rare)
            repeats = sum(1 for w in words if w in rare) - len(rare)
            need = max(1, int(np.ceil(coverage * len(words) - 1e-9)) - spare - repeats)
            decide = frozenset(j for j, w in enumerate(words) if w in DECIDING or w in VERSIONS)
            self.templates.append((name, words, rare, need, decide, DECIDING - frozenset(words)))
        self.coverage = coverage
        self.rare = frozenset().union(*[t[2] for t in self.templates]) if self.templates else frozenset()

    def _windows(self, words: list[bytes], template: list[bytes], rare: frozenset, decide: frozenset, barred: frozenset) -> Iterator[tuple[int, int, int]]:
        """(aligned, first word, end word) of the best notice of each stretch that is covered enough and has all deciding words."""
        least, count = max(1, int(np.ceil(self.coverage * len(template) - 1e-9))), Counter(template)
        for a, b in stretches(words, rare, len(template), barred):
            part = words[a:b]
            pairs = align(part, template)
            found = [(len(pairs), pairs[0][0], pairs[-1][0] + 1)] if len(pairs) >= least and decide <= {j for _, j in pairs} else []
            here = Counter(w for w in part if w in count)
            if any(here[w] > count[w] for w in here) and sum(min(here[w], count[w]) for w in here) >= least:
                window = best_window(part, template, least)
                if window and decide <= {j for _, j in align(part[window[1] : window[2]], template)}:
                    found.append(window)
            if found:
                n, first, end = max(found, key=lambda m: (m[0], m[1] - m[2], -m[1]))
                yield n, a + first, a + end

    def best(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """(name, coverage, first word, end word) of each template that is covered enough; most aligned words first, ties by name."""
        words = normal(text)
        present = self.rare.intersection(words)
        found = []
        for name, template, rare, need, decide, barred in self.templates:
            if len(rare & present) >= need:
                found += [(2 * n - len(template) - (end - first - n), n, name, n / len(template), first, end)
                          for n, first, end in self._windows(words, template, rare, decide, barred)]
        kept: list[tuple] = []
        for m in sorted(found, key=lambda m: (-m[0], m[2], m[4])):
            if all(licence(m[2]) == licence(k[2]) or m[5] <= k[4] or k[5] <= m[4] for k in kept):
                kept.append(m)
        top: dict[str, tuple] = {}
        for m in sorted(kept, key=lambda m: (-m[1], m[4])):
            top.setdefault(m[2], m)
        return [m[2:] for m in sorted(top.values(), key=lambda m: (-m[1], m[2]))]


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without ``text``, with the best notice of each row: license, coverage, start, stop; and all ``licenses``.

    Start and stop are code points. A template counts when ``coverage`` of its words are aligned in one
    stretch of the text, or in one window of a stretch in which its words repeat, its deciding words among them. Of equally long notices the first
    by name comes first. Whole texts are read where they are, without a shuffle. A null or empty
    text has no notice (nulls and an empty list); repeated rows get the same.
    Columns with the names of results are replaced.
    """
    names = ["license", "coverage", "start", "stop", "licenses"]
    keep = [c for c in docs.columns if c not in (text, *names)]
    matcher = Matcher(templates, coverage)

    def run(batches):
        kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
        for batch in batches:
            rows = []
            for value in batch.column(0).cast(pa.binary()):
                data = value.as_py() or b""
                found = matcher.best(data)
                if not found:
                    rows.append((None, None, None, None, []))
                    continue
                name, share, first, end = found[0]
                raw = np.frombuffer(data, np.uint8)
                gap = np.concatenate(([True], IS_GAP[raw], [True]))
                start, stop = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
                point = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                rows.append((name, share, int(point[start[first]]), int(point[stop[end - 1]]), [m[0] for m in found]))
            arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], names=[*batch.schema.names[1:], *names])

    inner = docs.select(F.col(text), *[F.col(f"`{c}`") for c in keep])
    extra = docs.sparkSession.createDataFrame([], "license string, coverage double, start bigint, stop bigint, licenses array<string>").schema
    return inner.mapInArrow(run, StructType([*inner.schema.fields[1:], *extra.fields]))
