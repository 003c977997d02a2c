"""Words of whole texts as arrays: split, hash and group without a loop over words.

An Arrow column of texts is cut into slices of a few megabytes of whole rows, so memory stays
level however many rows a batch has; one text larger than a slice is a slice of its own. The arrays
made of its words take many times its bytes, in each of an executor's workers.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WORDED_BYTES = 1 << 18  # of the slices whose words are all held


def numbers(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; different numbers stay different."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = numbers(11, 256)
GRAM_FACTOR = numbers(12, 64) | np.uint64(1)
BASE = np.uint64(0xD6E8FEB86659FD93)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32

_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """At least ``n`` powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, WORDED_BYTES + 1)
        out = []
        for base in (BASE, BASE_INVERSE):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        if n > SLICE_BYTES + 1:
            return out  # for one very long text; not kept
        _powers[:] = out
    return _powers


@dataclass
class Words:
    """Words of the rows ``rows`` of a batch: byte range, hash, and where each row's words begin."""

    rows: range
    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each word on, and how many words its row still has there."""
        total = len(self.hashes)
        left = np.repeat(self.first[1:], self.counts()) - np.arange(total)
        out = np.zeros(total, np.uint64)
        for j in range(min(n, total)):
            out[: total - j] += self.hashes[j:] * GRAM_FACTOR[j]
        return mix(out), left

    def whole(self, row: int) -> int:
        """Hash of all words of a row together; differs from any n-gram of another length."""
        h = self.hashes[self.first[row] : self.first[row + 1]]
        factors = GRAM_FACTOR[: len(h)] if len(h) <= len(GRAM_FACTOR) else numbers(12, len(h)) | np.uint64(1)
        return int(mix(np.array([np.add.reduce(h * factors) + np.uint64(len(h))], np.uint64))[0])


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets of the rows in the bytes) per slice; a null text has no bytes."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    before = 0
    for chunk in chunks:
        chunk = chunk.cast(pa.large_string()).fill_null("")
        n = len(chunk)
        _, places, bytes_ = chunk.buffers()
        if n:
            offsets = np.frombuffer(places, np.int64)[chunk.offset : chunk.offset + n + 1]
            data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None else np.zeros(0, np.uint8)
            at = 0
            while at < n:
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
                yield range(before + at, before + to), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
                at = to
        before += n


def split(
    rows: range, data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = WHITE, fold: np.ndarray = SAME,
    kinds: np.ndarray | None = None,
) -> Words:
    """Maximal runs of bytes outside ``gaps`` within each row, hashed after ``fold``.

    With ``kinds`` a run also ends between two bytes of different kinds above zero.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(rows, data, none, none, np.zeros(0, np.uint64), np.zeros(len(rows) + 1, np.int64))
    gap = gaps[data]
    begin, end = ~gap, ~gap
    begin[1:] &= gap[:-1]
    end[:-1] &= gap[1:]
    if kinds is not None:
        kind = kinds[data]
        cut = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        begin[1:] |= cut
        end[:-1] |= cut
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    begin[filled] = ~gap[filled]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    end[last] = ~gap[last]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[fold][data] * power[: len(data)], out=sums[1:])
    hashes = mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))
    return Words(rows, data, start, stop, hashes, np.searchsorted(start, offsets))


def worded(
    column: pa.Array, gaps: np.ndarray = WHITE, fold: np.ndarray = SAME, kinds: np.ndarray | None = None, limit: int = WORDED_BYTES
) -> Iterator[Words]:
    for part in slices(column, limit):
        yield split(*part, gaps, fold, kinds)


def released() -> None:
    """Give freed memory back to the system at the end of a task: the worker lives on and may stand idle beside others."""
    gc.collect()
    trimmed()


def trimmed() -> None:
    """``released`` without a search for cycles, for tasks that leave none."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of a mapInArrow; at the end of each task its worker gives freed memory back."""

    @wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            trimmed()

    return tidied
