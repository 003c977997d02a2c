"""Token sequences of one length, packed online by the sum-of-squares rule.

Each task packs the documents it reads. A document's full windows are sequences of their own; its
rest goes to the open window whose choice makes the sum of squared counts of open windows per fill
level smallest. At the end of a task, and whenever very many windows are open, the open ones are
filled up from each other by cutting pieces, so that at most one window stays partly filled; it is
cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.llm.words import LOWER, WHITE, tidy, worded

CAPACITY = 2048
MAX_OPEN = 1024
SLOTS = 1 << 20  # for segments whose ids are kept
ROOM = 1 << 22  # for their ids
JOINED = 1000  # words tokenized as one text
OUT_BYTES = 4 << 20
TASK_SEQUENCES = 1 << 32

# Bytes of different kinds are always in different pre-tokens: letters, ASCII marks but the apostrophe, digits.
KINDS = np.zeros(256, np.uint8)
KINDS[33:48] = KINDS[58:65] = KINDS[91:97] = KINDS[123:127] = 2
KINDS[39] = 0
KINDS[48:58] = 3
KINDS[65:91] = KINDS[97:123] = 1

LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
MARK = "."

_known: dict[str, Known] = {}  # per tokenizer


def runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``begin``, ``begin + 1``, ... of each run of ``size``, one run after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


class Known:
    """Ids of the segments met lately, by the segments' hashes.

    ``SLOTS`` segments and ``ROOM`` ids at most, 36 MB: a segment takes the older of two slots, and the room is written
    round and round.
    """

    def __init__(self):
        self.keys = np.zeros(SLOTS, np.uint64)
        self.size = np.zeros(SLOTS, np.int32)
        self.place = np.zeros(SLOTS, np.int64)  # counted in all ids ever written
        self.ids = np.zeros(ROOM, np.int32)
        self.written = ROOM + 1  # so that a place of 0 is one written over

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the keys are known, the number of ids of each that is, and their ids."""
        one, two = self._slots(keys)
        slot = np.where(self.keys[one] == keys, one, two)
        known = (self.keys[slot] == keys) & (self.place[slot] >= self.written - ROOM)
        slot = slot[known]
        return known, self.size[slot], self.ids[runs(self.place[slot], self.size[slot]) % ROOM]

    def add(self, keys: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Ids of unknown keys."""
        if len(ids) > ROOM:
            return
        one, two = self._slots(keys)
        slot = np.where(self.place[one] <= self.place[two], one, two)
        self.keys[slot], self.size[slot], self.place[slot] = keys, size, self.written + np.cumsum(size) - size
        self.ids[np.arange(self.written, self.written + len(ids)) % ROOM] = ids
        self.written += len(ids)

    @staticmethod
    def _slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (keys % SLOTS).astype(np.int64), ((keys >> np.uint64(32)) % SLOTS).astype(np.int64)


class Segments:
    """A tokenizer that drops white space, lower-cases and splits between letters, digits and marks, for segments without a gap.

    Words of Latin letters alone are one pre-token whose normal form is its lower case, so they skip the steps
    before the model and go many to a text, parted by a mark that no word's ids hold.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.whole.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        (self.mark,) = self.letters.encode(MARK, add_special_tokens=False).ids
        self.special = {t.content.encode() for t in self.whole.get_added_tokens_decoder().values()}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the texts in the order in which they are returned, the number of ids of each, and their ids."""
        plain = np.fromiter((LETTERS(t) is not None for t in texts), bool, len(texts))
        words, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        size, ids = [], []
        for at in range(0, len(words), JOINED):
            text = "".join(f"{texts[i]} {MARK} " for i in words[at : at + JOINED].tolist()).lower()
            found = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            marks = found == self.mark
            size.append(np.diff(np.flatnonzero(marks), prepend=-1) - 1)
            ids.append(found[~marks])
        if len(others):
            found = [e.ids for e in self.whole.encode_batch_fast([texts[i] for i in others.tolist()], add_special_tokens=False)]
            size.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.int32))
        return np.concatenate((words, others)), np.concatenate(size), np.concatenate(ids)


def token_ids(column: pa.Array, path: str, last: int, segments: Segments | None = None) -> Iterator[np.ndarray]:
    """Ids of each text, then ``last``; a null text is empty.

    A text's ids are those of its segments in turn, and a segment met lately is not tokenized again.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    segments = segments or Segments(path)
    if path not in _known:
        _known[path] = Known()
    held = _known[path]
    end = np.array([last], np.int32)
    for part in worded(column, WHITE, LOWER, KINDS):
        data = part.data.tobytes()
        plain = not any(s in data for s in segments.special)
        unique, at, back = np.unique(part.hashes, return_index=True, return_inverse=True)
        known, old, flat = held.find(unique)
        size = np.zeros(len(unique), np.int64)
        order = np.flatnonzero(known)
        size[order] = old
        new = np.flatnonzero(~known)
        if len(new):
            texts = [data[i:j].decode() for i, j in zip(part.start[at[new]].tolist(), part.stop[at[new]].tolist())]
            turn, fresh, ids = segments.encode(texts)
            new = new[turn]
            held.add(unique[new], fresh, ids)
            size[new] = fresh
            order, flat = np.concatenate((order, new)), np.concatenate((flat, ids))
        begin = np.zeros(len(unique), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        lengths = size[back]
        out = flat[runs(begin[back], lengths)]
        bounds = np.concatenate(([0], np.cumsum(lengths)))[part.first]
        offset = part.rows.start
        for row in part.rows:
            if plain:
                yield np.concatenate((out[bounds[row - offset] : bounds[row - offset + 1]], end))
            else:  # a special token's own string crosses the segments
                yield np.concatenate((segments.ids(column[row].as_py() or ""), end))


class Packer:
    """Fill levels of one task's open windows; ``emit(pieces)`` gets each finished sequence."""

    def __init__(self, emit: Callable[[list], None], capacity: int = CAPACITY, max_open: int = MAX_OPEN):
        self.emit, self.capacity, self.max_open = emit, capacity, max_open
        self.levels: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.count = np.zeros(capacity + 1, np.int64)  # open windows per level; full and new ones count nothing
        self.open = 0

    def add(self, doc, ids: np.ndarray) -> None:
        """A document's ids; pieces are (doc, start, ids)."""
        at = 0
        while len(ids) - at >= self.capacity:
            self.emit([(doc, at, ids[at : at + self.capacity])])
            at += self.capacity
        if at < len(ids):
            self._place((doc, at, ids[at:].copy()))
        if self.open > self.max_open:
            self.settle(last=False)

    def _place(self, piece) -> None:
        size = len(piece[2])
        room = self.capacity - size
        # change of the sum of squares: level h loses a window, level h + size gets one
        change = 2 * self.count[size:] - 2 * self.count[: room + 1] + 2
        change[0] = 2 * self.count[size] + 1  # a new window
        change[room] -= 2 * self.count[self.capacity] + 1
        usable = self.count[: room + 1] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        # the highest of equally good levels, so that windows get full
        level = room - int(np.argmin(change[::-1]))
        window = self._take(level) if level else []
        window.append(piece)
        self._put(window, level + size)

    def _take(self, level: int) -> list:
        self.count[level] -= 1
        self.open -= 1
        return self.levels[level].pop()

    def _put(self, window: list, level: int) -> None:
        if level == self.capacity:
            self.emit(window)
        else:
            self.levels[level].append(window)
            self.count[level] += 1
            self.open += 1

    def settle(self, last: bool = True) -> None:
        """Fill the open windows from each other; with ``last`` nothing stays open."""
        rest = []
        for level in range(self.capacity - 1, 0, -1):
            while self.levels[level]:
                window = self._take(level)
                if last and level & (level - 1) == 0:
                    self.emit(window)
                else:
                    rest.append((window, level))
        low = len(rest) - 1
        for i in range(len(rest)):
            if i > low:
                break
            window, level = rest[i]
            while level < self.capacity and low > i:
                donor, held = rest[low]
                doc, start, ids = donor.pop()
                need = self.capacity - level
                if len(ids) > need:  # the end of the piece moves, its start stays
                    donor.append((doc, start, ids[: len(ids) - need]))
                    start, ids = start + len(ids) - need, ids[len(ids) - need :]
                window.append((doc, start, ids))
                level, held = level + len(ids), held - len(ids)
                rest[low] = (donor, held)
                if not donor:
                    low -= 1
            if level == self.capacity or not last:
                self._put(window, level)
            else:
                self._powers(window, level)

    def _powers(self, window: list, level: int) -> None:
        part = []
        room = 1 << (level.bit_length() - 1)
        for doc, start, ids in window:
            while len(ids):
                n = min(room, len(ids))
                part.append((doc, start, ids[:n]))
                start, ids, level, room = start + n, ids[n:], level - n, room - n
                if not room:
                    self.emit(part)
                    part, room = [], 1 << (level.bit_length() - 1) if level else 0


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, last: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Every id of every document is in exactly one piece; a null or empty text is the one id ``last``.
    Rows with equal ids are packed apiece. Documents are packed where they are read, without a
    shuffle; a task's sequences are numbered from its own block of ids, so a task that runs
    again on the same input gives the same rows. A task holds ``MAX_OPEN`` open windows at most, ``OUT_BYTES``
    of finished ids and the segments of one ``Known``, or what one longest text needs beyond them.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    @tidy
    def run(batches):
        number = TaskContext.get().partitionId() * TASK_SEQUENCES
        rows: list[tuple] = []
        held = 0  # bytes of ids in rows

        def emit(pieces):
            nonlocal number, held
            at = 0
            for (doc, total), start, ids in pieces:
                rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, number, at, ids))
                at += len(ids)
            held += 4 * at
            number += 1

        def out(schema):
            nonlocal held
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            kinds = [schema, *[pa.int64()] * 6]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            flat = np.concatenate(columns[7]) if rows else np.zeros(0, np.int32)
            ends = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            rows.clear()
            held = 0
            return pa.RecordBatch.from_arrays(arrays, names=names)

        packer, schema, segments = Packer(emit, capacity), None, None
        for batch in batches:
            schema, segments = batch.schema.field(0).type, segments or Segments(path)
            for doc, ids in zip(batch.column(0).to_pylist(), token_ids(batch.column(1), path, last, segments)):
                packer.add((doc, len(ids)), ids)
                if held >= OUT_BYTES:
                    yield out(schema)
        if schema is not None:
            packer.settle()
            yield out(schema)

    schema = docs.sparkSession.createDataFrame(
        [], "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids array<int>"
    ).schema
    fields = docs.select(F.col(doc_id).alias("doc_id")).schema
    for f in schema:
        fields = fields.add(f)
    return inner.mapInArrow(run, fields)
