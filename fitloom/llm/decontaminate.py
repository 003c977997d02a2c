"""Benchmark passages in documents: one Aho-Corasick automaton over the normalised test items.

Normal form: A-Z in lower case, then words of digits, a-z and non-ASCII characters; everything else
only separates. A window is ``window`` consecutive words of an item; an item with fewer words, but
not none, is one window. Each text is scanned once, and hits are mapped to its own code points.

The automaton reads word numbers and holds the chunks of half a window that begin at every half window of an item, one
node per word of the items: every window contains such a chunk whole. Where a chunk is met, the windows around it are looked up
among all windows of the items by hash and compared word by word.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.llm.store import saved
from fitloom.llm.words import mix
from fitloom.llm.words import numbers as hash_numbers
from fitloom.llm.words import tidy

WINDOW = 10
PART_BYTES = 8 << 20

NORMAL = bytearray(b" " * 128 + bytes(range(128, 256)))
NORMAL[48:58] = b"0123456789"
NORMAL[65:91] = NORMAL[97:123] = b"abcdefghijklmnopqrstuvwxyz"
NORMAL = bytes(NORMAL)
IS_GAP = np.frombuffer(NORMAL, np.uint8) == 32

SCHEMA = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,stop:bigint>>"
SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def normal(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


class Windows:
    """The windows of some items: an automaton over their chunks, and all windows in the order of their hashes."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window, self.number = window, {}
        self.items = [item for item, _ in items]
        number = self.number
        chunk = (window + 1) // 2  # any window holds a whole chunk of those at multiples of this
        flat, starts, owners = [], [], []
        patterns: dict[tuple, list] = {}  # whether it is a chunk, and the short items that it is
        for i, (_, text) in enumerate(items):
            words = [number.setdefault(w, len(number) + 1) for w in normal(text)]
            if 0 < len(words) < window:
                patterns.setdefault(tuple(words), [False, []])[1].append(i)
            elif words:
                at = len(flat)
                flat += words
                starts.append(np.arange(at, at + len(words) - window + 1))
                owners.append(np.full(len(words) - window + 1, i))
                for p in range(0, len(words) - chunk + 1, chunk):
                    patterns.setdefault(tuple(words[p : p + chunk]), [False, []])[0] = True
        self.flat = np.array(flat, np.int64)
        starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        hashes = self._hashes(self.flat, starts)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.owners = hashes[order], starts[order].astype(np.int32), owners[order].astype(np.int32)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, (whole, short) in patterns.items():
            self.automaton.add_word(words, (len(words), whole, tuple(short)))
        self.automaton.make_automaton()
        self.empty = not patterns

    def _hashes(self, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        factors = hash_numbers(31, self.window) | np.uint64(1)
        out = np.zeros(len(starts), np.uint64)
        for j in range(self.window):
            out += mix(numbers[starts + j].astype(np.uint64)) * factors[j]
        return out

    def found(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """(first word, end word) of every window met in ``words``, and the places of the items that have them."""
        get = self.number.get
        numbers = [get(w, 0) for w in words]
        spans, items, chunks = [], set(), []
        for end, (n, whole, short) in self.automaton.iter(tuple(numbers)):
            if whole:
                chunks.append(end + 1 - n)
            if short:
                spans.append((end + 1 - n, end + 1))
                items.update(short)
        if chunks and len(words) >= self.window:
            reach = self.window - (self.window + 1) // 2
            starts = np.unique(np.array(chunks)[:, None] - np.arange(reach + 1))
            starts = starts[(starts >= 0) & (starts <= len(words) - self.window)]
            numbers = np.array(numbers, np.int64)
            hashes = self._hashes(numbers, starts)
            low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
            met = np.flatnonzero(high > low)
            for start, lo, hi in zip(starts[met].tolist(), low[met].tolist(), high[met].tolist()):
                own = numbers[start : start + self.window]
                same = (self.flat[self.starts[lo:hi, None] + np.arange(self.window)] == own).all(axis=1)
                if same.any():
                    spans.append((start, start + self.window))
                    items.update(self.owners[lo:hi][same].tolist())
        return spans, items


def build(items: list[tuple[str, str | None]], window: int) -> Windows | None:
    out = Windows(items, window)
    return None if out.empty else out


def scan(text: bytes, automaton: Windows | None) -> tuple[int, int, list[str], list[dict]]:
    """Words, words inside a window, sorted items, and the hit stretches in code points."""
    words = text.translate(NORMAL).split()
    if automaton is None or not words:
        return len(words), 0, [], []
    found, owners = automaton.found(words)
    if not found:
        return len(words), 0, [], []
    change = np.zeros(len(words) + 1, np.int64)
    begin, end = np.array(found).T
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    hit = np.cumsum(change[:-1]) > 0
    items = sorted({automaton.items[i] for i in owners})
    data = np.frombuffer(text, np.uint8)
    gap = np.concatenate(([True], IS_GAP[data], [True]))
    start, stop = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    point = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    spans = [{"start": int(point[start[a]]), "stop": int(point[stop[b - 1]])} for a, b in zip(edge[::2], edge[1::2])]
    return len(words), int(hit.sum()), items, spans


def _scanned(docs: DataFrame, items: list[tuple[str, str | None]], text: str, keep: list[str], window: int) -> DataFrame:
    """Columns ``keep`` and the results of ``scan`` for each row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(items)
    names = ["n_words", "n_hit", "items", "spans"]

    @tidy
    def run(batches):
        automaton = build(shared.value, window)
        for batch in batches:
            rows = [scan(t.as_py() or b"", automaton) for t in batch.column(0).cast(pa.binary())]
            got = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), SPAN]
            arrays = [pa.array(list(v), k) for v, k in zip(got, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], names=[*batch.schema.names[1:], *names])

    inner = docs.select(F.col(text), *[F.col(f"`{c}`") for c in keep])
    schema = inner.drop(text).schema
    for field in spark.createDataFrame([], SCHEMA).schema:
        schema = schema.add(field)
    return inner.mapInArrow(run, schema)


def _parts(items: DataFrame, part_bytes: int) -> list[list[tuple[str, str | None]]]:
    """The items in parts of about ``part_bytes``, read one part at a time by the hash of their text."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + size // part_bytes
    place = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return [[(r[0], r[1]) for r in items.where(place == i).collect()] for i in range(count)]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``docs`` without ``text``, with n_words, n_hit, items (sorted as strings) and spans.

    The test items are measured and sent to the tasks in parts of about ``part_bytes`` of text. With one part nothing is
    shuffled; with more, each part is one pass over the texts, and what rows were hit by, as
    word places, is put together per row. A null text has no words and no hits; an item without id or words takes no part; repeated
    items and repeated documents count like others. Columns of ``docs`` with the names of results are replaced.
    """
    items = benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    keep = [c for c in docs.columns if c not in (text, "n_words", "n_hit", "items", "spans")]
    parts = _parts(items, part_bytes)
    if len(parts) == 1:
        return _scanned(docs, parts[0], text, keep, window)
    names = {c: f"__column_{i}" for i, c in enumerate(keep)}
    rows = saved(docs.select(F.monotonically_increasing_id().alias("__row"), F.col(text).alias("__text"), *[F.col(f"`{c}`").alias(n) for c, n in names.items()]), "scanned")
    each = None
    for part in parts:
        hits = _scanned(rows.select("__row", "__text"), part, "__text", ["__row"], window).where("n_hit > 0").select("__row", "items", "spans")
        each = hits if each is None else each.unionByName(hits)
    met = each.groupBy("__row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("__spans")
    )
    joined = rows.join(met, "__row", "left")
    return _united(joined, names)


def _united(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Counts and stretches of rows from the spans that the parts found, which may overlap."""
    spark = rows.sparkSession
    results = ["n_words", "n_hit", "items", "spans"]

    @tidy
    def run(batches):
        for batch in batches:
            out = []
            for text, items, spans in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = np.frombuffer(text.as_py() or b"", np.uint8)
                gap = np.concatenate(([True], IS_GAP[data], [True]))
                start, stop = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
                if not spans:
                    out.append((len(start), 0, [], []))
                    continue
                point = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                first, last = point[start], point[stop]
                hit = np.zeros(len(start), bool)
                for s in spans:
                    hit[np.searchsorted(first, s["start"]) : np.searchsorted(last, s["stop"]) + 1] = True
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                places = [{"start": int(first[a]), "stop": int(last[b - 1])} for a, b in zip(edge[::2], edge[1::2])]
                out.append((len(start), int(hit.sum()), items, places))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), SPAN]
            arrays = [pa.array(list(v), k) for v, k in zip(zip(*out) if out else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], *arrays], names=[*batch.schema.names[3:], *results])

    inner = rows.select("__text", "items", "__spans", *names.values())
    schema = inner.select(*names.values()).schema
    for field in spark.createDataFrame([], SCHEMA).schema:
        schema = schema.add(field)
    done = inner.mapInArrow(run, schema)
    return done.select(*[F.col(n).alias(c) for c, n in names.items()], *results)
