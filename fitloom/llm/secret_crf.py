"""Secrets in texts: three fixed patterns, and a linear-chain conditional random field for the rest.

Words (runs without white space) are tagged as begin, inside or outside of a secret from their shape,
the cue words beside them and features of the whole text, and decoded by Viterbi. The field is fitted
on windows of a bounded sample of texts, labelled by the patterns; patterns always stand, and the
field adds spans that do not touch them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.llm.words import Words, tidy, worded

SAMPLE_ROWS = 20_000
TRAIN_WINDOWS = 2_000
REACH = 20
STEPS = 60
PENALTY = 0.02

KINDS = ("assign", "access", "hex", "field")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
HEX_BYTES = re.compile(rb"[0-9a-f]{24}")
HINTS = (b"passw", b"secret", b"token", b"api")
EDGE = re.compile(r"^[^A-Za-z0-9+/_.=-]+|[^A-Za-z0-9+/_.=-]+$")

CUES = frozenset("password passwd secret token apikey api_key secret_key access_token auth_token".split())
N_CUES, NO_CUE = 4, 0
N_SHAPES = 6 * 3 * 3 * 2 * 3 * 2
N_FILES = 4
OUT, BEGIN, INSIDE = 0, 1, 2
NEVER = -1e9


def base_spans(data: bytes, text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the fixed patterns, in code points, by start and kind."""
    out = []
    low = data.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if HEX_BYTES.search(data):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _table(pattern: bytes) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(pattern)] = 1
    return out


_DIGIT, _UPPER = _table(b"0123456789"), _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)) + bytes(range(128, 256)))
_HEXES = _table(b"0123456789abcdefABCDEF")


def shapes(words: Words) -> np.ndarray:
    """Shape of each word: length, share of digits, capitals, small letters, other signs, all hexadecimal."""
    n = words.stop - words.start

    def count(table):
        sums = np.concatenate(([0], np.cumsum(table[words.data])))
        return sums[words.stop] - sums[words.start]

    digit, upper, lower, hexes = count(_DIGIT), count(_UPPER), count(_LOWER), count(_HEXES)
    other = n - digit - upper - lower
    out = np.searchsorted([4, 8, 16, 24, 40], n, "right")
    out = out * 3 + np.where(digit == 0, 0, np.where(10 * digit < 3 * n, 1, 2))
    out = out * 3 + np.where(upper == 0, 0, np.where(2 * upper < n, 1, 2))
    out = out * 2 + (lower > 0)
    out = out * 3 + np.where(other == 0, 0, np.where(2 * other < n, 1, 2))
    return out * 2 + (hexes >= n - other) * (hexes > 0)


def cue(word: bytes) -> int:
    """0 none, 1 a cue word, 2 an operator, 3 a cue word with an operator behind it."""
    core = re.sub(rb"[^a-z0-9_]", b"", word.lower())
    if not core:
        return 2 if re.search(rb"[:=]", word) else 0
    if core.decode() in CUES:
        return 3 if re.search(rb"[:=][\"']?$", word) else 1
    return 0


def file_features(data: bytes) -> tuple[int, int]:
    """Features of a text, and which cues it can hold: 1 cue words, 2 operators."""
    low = data.lower()
    signs = low.count(b"=") + low.count(b";") + low.count(b"{")
    cued = any(h in low for h in HINTS)
    return cued + 2 * (signs * 200 > len(low)), cued + 2 * (b"=" in data or b":" in data)


@dataclass
class Field:
    """Weights: shape, cue one and two before, cue behind, file features, transitions, first tag."""

    shape: np.ndarray
    before: np.ndarray
    before2: np.ndarray
    behind: np.ndarray
    file: np.ndarray
    step: np.ndarray
    first: np.ndarray

    @classmethod
    def empty(cls):
        z = lambda n: np.zeros((n, 3))
        return cls(z(N_SHAPES), z(N_CUES), z(N_CUES), z(N_CUES), z(N_FILES), z(3), np.zeros(3))

    def parts(self):
        return [self.shape, self.before, self.before2, self.behind, self.file, self.step, self.first]

    def scores(self, shape, cues, file) -> np.ndarray:
        """Tag scores; ``cues`` has two entries before the first word and one behind the last."""
        return self.shape[shape] + self.before[cues[..., 1:-2]] + self.before2[cues[..., :-3]] + self.behind[cues[..., 3:]] + self.file[file]

    def steps(self):
        step, first = self.step.copy(), self.first.copy()
        step[OUT, INSIDE] = first[INSIDE] = NEVER
        return step, first

    def hopeful(self) -> np.ndarray:
        """[features, possible cues, shape]: shapes of which a secret must hold one.

        Turning a secret's tags to OUT changes the path's score by the sum over its words of at most
        (emission gain + step gain), plus the gain of the step behind it. When that is not
        positive for every word, the secret is never part of a best path; so texts without a hopeful
        shape need no decoding, and their result is the same as with it.
        """
        step, first = self.steps()
        gain = lambda w: (w[..., 1:] - w[..., :1]).max(axis=-1)
        enter = max((step[:, BEGIN] - step[:, OUT]).max(), first[BEGIN] - first[OUT])
        stay = (step[1:, INSIDE] - step[OUT, OUT]).max()
        leave = max(0.0, (step[1:, [OUT, BEGIN]] - step[OUT, [OUT, BEGIN]]).max())
        out = np.zeros((N_FILES, 4, N_SHAPES), bool)
        for f in range(N_FILES):
            for able in range(4):
                cues = [NO_CUE, *[1, 3] * (able & 1), *[2] * (able >> 1)]
                weights = self.shape + self.file[f]
                most = [w[c] for w in (self.before, self.before2, self.behind) for c in [cues]]
                bound = np.max([gain(weights + a + b + c) for a in most[0] for b in most[1] for c in most[2]], axis=0)
                out[f, able] = bound + max(enter, stay) + leave > 1e-9
        return out

    def decode(self, shape: np.ndarray, cues: np.ndarray, file: int) -> list[int]:
        """Best tags; of equal paths the one with OUT."""
        step, first = self.steps()
        scores = self.scores(shape, cues, file).tolist()
        step = step.tolist()
        best = [first[y] + scores[0][y] for y in range(3)]
        came = []
        for s in scores[1:]:
            froms, new = [], []
            for y in range(3):
                options = [best[x] + step[x][y] for x in range(3)]
                x = options.index(max(options))
                froms.append(x)
                new.append(options[x] + s[y])
            best = new
            came.append(froms)
        tags = [best.index(max(best))]
        for froms in reversed(came):
            tags.append(froms[tags[-1]])
        return tags[::-1]


def _cues(data: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    own = [cue(data[a:b]) for a, b in zip(start, stop)]
    return np.array([NO_CUE, NO_CUE, *own, NO_CUE])


def _rows(column: pa.Array) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Text, shapes and byte ranges of the words of each row."""
    for words in worded(column):
        shape = shapes(words)
        data = words.data.tobytes()
        sizes = pc.binary_length(column.slice(words.rows.start, len(words.rows))).fill_null(0).to_numpy()
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        for i in range(len(words.rows)):
            a, b = words.first[i], words.first[i + 1]
            yield data[offsets[i] : offsets[i + 1]], shape[a:b], words.start[a:b] - offsets[i], words.stop[a:b] - offsets[i]


def _points(data: bytes) -> np.ndarray:
    """Code points before each byte."""
    return np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))


def find(data: bytes, shape, start, stop, field: Field, hopeful: np.ndarray) -> tuple[list, list]:
    """Spans of the patterns, and of patterns and field together, as (start, place of the kind, end)."""
    text = data.decode()
    base = base_spans(data, text)
    features, able = file_features(data)
    if not len(shape) or not hopeful[features, able][shape].any():
        return base, base
    tags = field.decode(shape, _cues(data, start, stop), features)
    if not any(tags):
        return base, base
    points, spans = _points(data), list(base)
    i = 0
    while i < len(tags):
        if tags[i] == OUT:
            i += 1
            continue
        j = i + 1
        while j < len(tags) and tags[j] == INSIDE:
            j += 1
        a, b = int(points[start[i]]), int(points[stop[j - 1]])
        lead = EDGE.match(text[a:b])
        a += lead.end() if lead and lead.start() == 0 else 0
        b = a + len(EDGE.sub("", text[a:b]))
        if b > a and not any(s < b and a < e for s, _, e in base):
            spans.append((a, 3, b))
        i = j
    return base, sorted(spans)


def _windows(docs: DataFrame) -> DataFrame:
    """Labelled windows: around each pattern span, and one in about every eighth text without any."""

    @tidy
    def run(batches):
        for batch in batches:
            out = {"shape": [], "cue": [], "file": [], "tag": []}
            for data, shape, start, stop in _rows(batch.column(0)):
                if not len(shape):
                    continue
                spans = base_spans(data, data.decode())
                tags, centres = np.zeros(len(shape), np.int64), []
                if spans:
                    points = _points(data)
                    for a, kind, b in spans:
                        inside = np.flatnonzero((points[start] < b) & (points[stop] > a))
                        if kind == 0:  # of an assignment only the value's word is the secret
                            inside = inside[-1:]
                        tags[inside] = INSIDE
                        tags[inside[0]] = BEGIN
                        centres.append(int(inside[0]))
                elif (pick := int(shape.sum())) % 8 == 0:
                    centres.append(pick // 8 % len(shape))
                if not centres:
                    continue
                cues = _cues(data, start, stop)
                for c in centres:
                    a, b = max(0, c - REACH), min(len(shape), c + REACH + 1)
                    out["shape"].append(shape[a:b].tolist())
                    out["cue"].append(cues[a : b + 3].tolist())
                    out["file"].append(file_features(data)[0])
                    out["tag"].append(np.where((np.arange(a, b) == a) & (tags[a:b] == INSIDE), BEGIN, tags[a:b]).tolist())
            ints = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["shape"], ints), pa.array(out["cue"], ints), pa.array(out["file"], pa.int64()), pa.array(out["tag"], ints)], names=list(out)
            )

    return docs.mapInArrow(run, "shape array<bigint>, cue array<bigint>, file bigint, tag array<bigint>")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS, windows: int = TRAIN_WINDOWS) -> Field:
    """Field fitted on ``windows`` different windows of the ``sample_rows`` texts with the smallest hash of their id.

    Equal windows are one, with their number as weight, so copies take no places. Both bounds hold whatever the size
    of ``docs``; without any window the field finds nothing.
    """
    rows = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(doc_id)).alias("h"))
    top = rows.select("h").orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    if top is None:
        return Field.empty()
    got = _windows(rows.where(F.col("h") <= top).select("text")).groupBy("shape", "cue", "file", "tag").count()
    got = got.orderBy(F.xxhash64("shape", "cue", "file", "tag"), "shape", "cue", "file", "tag").limit(windows).collect()
    return train(got)


def train(rows, steps: int = STEPS, rate: float = 0.1) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adam on all windows at once, each as often as its ``count`` says."""
    field = Field.empty()
    if not rows:
        return field
    n, width = len(rows), max(len(r["shape"]) for r in rows)
    shape, tag, live = (np.zeros((n, width), np.int64) for _ in range(3))
    cues = np.full((n, width + 3), NO_CUE)
    file = np.array([r["file"] for r in rows])[:, None]
    for i, r in enumerate(rows):
        k = len(r["shape"])
        shape[i, :k], tag[i, :k], live[i, :k] = r["shape"], r["tag"], 1
        cues[i, : k + 3] = r["cue"]
    live = live.astype(float)
    weight = np.array([r["count"] for r in rows], float)
    weight /= weight.sum()
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in field.parts()]
    gold = np.eye(3)[tag] * live[..., None]
    gold_step = np.einsum("n,nti,ntj->ij", weight, gold[:, :-1], gold[:, 1:])
    for turn in range(1, steps + 1):
        step, first = field.steps()
        score = field.scores(shape, cues, file)
        forward = np.empty((n, width, 3))
        forward[:, 0] = first + score[:, 0]
        for t in range(1, width):
            new = np.logaddexp.reduce(forward[:, t - 1, :, None] + step, axis=1) + score[:, t]
            forward[:, t] = np.where(live[:, t, None] > 0, new, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        backward = np.zeros((n, 3))
        mass, steps_seen = np.zeros_like(score), np.zeros((3, 3))
        for t in range(width - 1, -1, -1):
            mass[:, t] = np.exp(forward[:, t] + backward - total[:, None]) * live[:, t, None]
            if t:
                pair = forward[:, t - 1, :, None] + step + (score[:, t] + backward)[:, None, :]
                on = live[:, t, None] > 0
                steps_seen += (np.exp(pair - total[:, None, None]) * on[..., None] * weight[:, None, None]).sum(axis=0)
                backward = np.where(on, np.logaddexp.reduce(step + (score[:, t] + backward)[:, None, :], axis=2), backward)
        error = (mass - gold) * weight[:, None, None]
        grads = [np.zeros_like(w) for w in field.parts()]
        for g, index in zip(grads[:4], (shape, cues[:, 1:-2], cues[:, :-3], cues[:, 3:])):
            np.add.at(g, index, error)
        np.add.at(grads[4], file[:, 0], error.sum(axis=1))
        grads[5] += steps_seen - gold_step
        grads[6] += error[:, 0].sum(axis=0)
        for w, g, (m, v) in zip(field.parts(), grads, moments):
            g = g + PENALTY * w / 10
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return field


FOUND = "base array<struct<kind:string,start:bigint,stop:bigint>>, found array<struct<kind:string,start:bigint,stop:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def _mapped(docs: DataFrame, text: str, field: Field, make, extra: str, keep: list[str]) -> DataFrame:
    hopeful = field.hopeful()

    @tidy
    def run(batches):
        for batch in batches:
            arrays = make(_spans(batch.column(0), field, hopeful))
            names = [*batch.schema.names[1:], *[x.split(" ")[0] for x in re.split(r", (?=\w+ )", extra)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], names=names)

    inner = docs.select(F.col(text), *[F.col(f"`{c}`") for c in keep])
    schema = inner.drop(text).schema
    for f in docs.sparkSession.createDataFrame([], extra).schema:
        schema = schema.add(f)
    return inner.mapInArrow(run, schema)


def _spans(column: pa.Array, field: Field, hopeful: np.ndarray):
    for data, shape, start, stop in _rows(column):
        yield data, *find(data, shape, start, stop, field, hopeful)


def scan(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the spans ``base`` (patterns) and ``found`` (with the field's).

    Places are code points, ends exclusive, sorted by start and kind. A null text is empty. Nothing is
    shuffled; each row is judged by itself, repeated ones alike. Columns named base or found are replaced.
    """

    def make(rows):
        named = [[[{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in spans] for spans in pair] for _, *pair in rows]
        return [pa.array([r[i] for r in named], _SPANS) for i in (0, 1)]

    return _mapped(docs, text, field, make, FOUND, [c for c in docs.columns if c not in (text, "base", "found")])


def redact(docs: DataFrame, field: Field, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; null stays null."""

    def make(rows):
        out = []
        for data, _, spans in rows:
            body, parts, at = data.decode(), [], 0
            for a, _, b in spans:
                if b > at:
                    parts += [body[at : max(a, at)], mark if a >= at else ""]
                    at = b
            out.append("".join(parts) + body[at:])
        return [pa.array(out, pa.string())]

    columns = docs.columns
    safe = docs.withColumn("__null", F.col(text).isNull())
    done = _mapped(safe, text, field, make, "__clean string", [c for c in safe.columns if c != text])
    return done.withColumn(text, F.when(~F.col("__null"), F.col("__clean"))).select(*[F.col(f"`{c}`") for c in columns])
