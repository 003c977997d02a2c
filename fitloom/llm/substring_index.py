"""Repeated passages by matching statistics over FM-indexes, one per shard of the corpus.

Words stand for symbols. A window is ``WINDOW`` consecutive words of one document; it is repeated when its
words also start earlier (smaller document id, or earlier in the same document).

Windows that are equal must meet in one shard, and most windows occur once. Both follow from the window's
minimizer, the smallest hash of its ``GRAM``-word sequences: consecutive windows with one minimizer form a
passage, passages whose minimizer occurs once in the corpus are left out, and the others are dealt to
shards by it. Equal passages are counted first: of them only the earliest is indexed, and all windows of the
others are repeated. In a shard, the passages' words are sorted into a Burrows-Wheeler transform that is kept
as a wavelet matrix of packed bits; every passage is then streamed from its end by backward search, which
gives for each place the range of its next ``WINDOW`` words in suffix order, hence the earliest one.

A minimizer with very many different passages (a common line among other text) would make a shard
without bound; its windows are met one by one on the hash of their words instead.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.llm.store import saved
from fitloom.llm.words import Words, mix, powers, worded

WINDOW = 20
GRAM = 8
SHARD_WORDS = 150_000
HOT_PASSAGES = 400


SPAN = WINDOW - GRAM + 1  # sequences per window


def window_keys(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer and hash of the window at each word, whether there is one, and the hashes of the sequences."""
    grams, left = words.grams(GRAM)
    whole, _ = words.grams(WINDOW)
    least, width = grams, 1
    while 2 * width <= SPAN:
        least = np.minimum(least, np.concatenate((least[width:], least[-1:].repeat(width)))[: len(least)])
        width *= 2
    if width < SPAN:
        step = SPAN - width
        least = np.minimum(least, np.concatenate((least[step:], least[-1:].repeat(step)))[: len(least)])
    return least, whole, left >= WINDOW, grams


def passages(words: Words):
    """(row, first word in the row, windows, minimizer, hash of all words, recurs) of the passages of a slice.

    ``recurs`` says that the minimizer occurs at several places of the passage, so that the passage alone
    may repeat a window.
    """
    if not len(words.hashes):
        return [np.zeros(0, np.int64)] * 6
    least, whole, valid, grams = window_keys(words)
    row = np.repeat(np.arange(len(words.rows)), words.counts())
    at = np.flatnonzero(valid)
    if not len(at):
        return [at] * 6
    fresh = np.concatenate(([True], (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])))
    start = at[fresh]
    place = np.flatnonzero(fresh)
    n = np.diff(np.concatenate((place, [len(at)])))
    power, inverse = powers(len(whole) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(whole * power[: len(whole)])))
    content = mix((sums[start + n] - sums[start]) * inverse[start] + n.astype(np.uint64))
    seen = np.zeros(len(start), np.int64)
    for k in range(2 * SPAN - 1):
        seen += (k < n + SPAN - 1) & (grams[np.minimum(start + k, len(grams) - 1)] == least[start])
    recurs = (seen > 1) | (n > SPAN)
    return row[start], start - words.first[row[start]], n, least[start].astype(np.int64), content.astype(np.int64), recurs


RUN = "doc bigint, first int, n int, least bigint, content bigint"


def _runs(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for words in worded(batch.column(1)):
                row, first, n, least, content, _ = passages(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[words.rows.start + row]), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(least), pa.array(content)],
                    names=["doc", "first", "n", "least", "content"],
                )

    return docs.mapInArrow(run, RUN)


def _counts(docs: DataFrame) -> DataFrame:
    """(least, n): passages per minimizer, recurring ones twice, added up per slice before they move."""

    def run(batches):
        for batch in batches:
            for words in worded(batch.column(0)):
                *_, keys, _, recurs = passages(words)
                least, at, n = np.unique(keys, return_inverse=True, return_counts=True)
                n += np.bincount(at, recurs, len(least)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(least), pa.array(n.astype(np.int32))], names=["least", "n"])

    return docs.select("text").mapInArrow(run, "least bigint, n int")


class Bits:
    """Packed bits with counts of ones before each 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1]
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class FMIndex:
    """Backward search over texts whose order of suffixes is known for their first ``depth`` symbols.

    ``symbols`` are 0 (end of a text) to sigma - 1. Ranges of patterns shorter than ``depth`` are exact.
    """

    def __init__(self, symbols: np.ndarray, depth: int = 32):
        rank, width = symbols.astype(np.int64), 1
        n = len(rank)
        self.ranks = {1: rank}
        while width < depth:
            ahead = np.concatenate((rank[width:], np.zeros(min(width, n), np.int64)))[:n]
            rank = np.unique(rank * (int(ahead.max(initial=0)) + 1) + ahead, return_inverse=True)[1]
            width *= 2
            self.ranks[width] = rank
        self.order = np.argsort(rank, kind="stable")
        transform = symbols[self.order - 1]
        self.levels = max(1, int(symbols.max(initial=1)).bit_length())
        self.bits = []
        column = transform
        for level in range(self.levels - 1, -1, -1):
            bit = (column >> level) & 1
            self.bits.append(Bits(bit.astype(bool)))
            column = np.concatenate((column[bit == 0], column[bit == 1]))
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=1 << self.levels))))[:-1]
        # where each symbol's run of the last level begins, by the same steps as a rank
        self.base = self._descend(np.arange(1 << self.levels), np.zeros(1 << self.levels, np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits in enumerate(self.bits):
            one = (symbol >> (self.levels - 1 - k)) & 1
            ones = bits.ones(i)
            i = np.where(one == 1, bits.zeros + ones, i - ones)
        return i

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the patterns with one more symbol in front."""
        begin = self.smaller[symbol] - self.base[symbol]
        return begin + self._descend(symbol, lo), begin + self._descend(symbol, hi)


def repeated_windows(texts: list[np.ndarray], doc: np.ndarray, first: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """Per text, whether each of its windows also starts earlier in one of the texts.

    ``texts`` are word hashes; text i begins at word ``first[i]`` of document ``doc[i]``.
    """
    sizes = np.array([len(t) for t in texts])
    joined = np.concatenate(texts)
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int64)
    inside = np.ones(len(symbols), bool)
    inside[starts + sizes] = False
    symbols[inside] = np.unique(joined, return_inverse=True)[1] + 1
    index = FMIndex(symbols)
    # ranges of suffixes with the same first ``window`` words
    near = index.ranks[16]
    ahead = np.concatenate((near[window - 16 :], np.zeros(window - 16, np.int64)))[: len(near)]
    same = np.concatenate(([True], (np.diff(near[index.order]) != 0) | (np.diff(ahead[index.order]) != 0)))
    group = np.cumsum(same) - 1
    begin = np.concatenate((np.flatnonzero(same), [len(symbols)]))
    # place of each word in the order of the corpus
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    word = first[text_of] + np.arange(len(symbols)) - starts[text_of]
    by_age = np.lexsort((word, doc[text_of]))
    d, w = doc[text_of][by_age], word[by_age]
    age = np.empty(len(symbols), np.int64)
    age[by_age] = np.cumsum(np.concatenate(([0], (np.diff(d) != 0) | (np.diff(w) != 0))))
    earliest = np.minimum.reduceat(age[index.order], begin[:-1])
    # all texts at once, each from its end: one more word in front, then back to ``window`` words
    out = [np.zeros(max(0, s - window + 1), bool) for s in sizes]
    flat = np.zeros(len(symbols), bool)
    live = np.arange(len(texts))
    lo, hi = np.zeros(len(texts), np.int64), np.full(len(texts), len(symbols))
    for back in range(1, int(sizes.max(initial=0)) + 1):
        keep = sizes[live] >= back
        live, lo, hi = live[keep], lo[keep], hi[keep]
        at = starts[live] + sizes[live] - back
        lo, hi = index.step(symbols[at], lo, hi)
        if back >= window:
            g = group[lo]
            lo, hi = begin[g], begin[g + 1]
            flat[at] = earliest[g] < age[at]
    for i, s in enumerate(starts):
        out[i] = flat[s : s + len(out[i])]
    return out


def _intervals(flags: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Word ranges covered by the flagged windows."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(int(a), int(b) - 1 + window) for a, b in zip(edge[::2], edge[1::2])]


INTERVAL = "doc bigint, begin int, stop int"


def _search(shard: pd.DataFrame) -> pd.DataFrame:
    texts = [np.frombuffer(w, np.uint32) for w in shard["words"]]
    doc, first = shard["doc"].to_numpy(), shard["first"].to_numpy().astype(np.int64)
    rows = []
    for d, f, flags in zip(doc, first, repeated_windows(texts, doc, first)):
        rows += [(d, f + a, f + b) for a, b in _intervals(flags, WINDOW)]
    return pd.DataFrame(rows, columns=["doc", "begin", "stop"]).astype({"doc": "int64", "begin": "int32", "stop": "int32"})


def _spelled(rows: DataFrame) -> DataFrame:
    """The indexed passages' words, and the windows of the hot ones, from (doc, text, parts)."""

    def run(batches):
        for batch in batches:
            parts = batch.column(2).to_pylist()
            ids = batch.column(0).to_pylist()
            for words in worded(batch.column(1)):
                out: list[tuple] = []
                short = (words.hashes >> np.uint64(32)).astype(np.uint32)
                whole = words.grams(WINDOW)[0].astype(np.int64)
                for i, r in enumerate(words.rows):
                    at = words.first[i]
                    for p in parts[r]:
                        a = at + p["first"]
                        if p["hot"]:
                            out += [(ids[r], p["first"] + j, None, None, int(whole[a + j])) for j in range(p["n"])]
                        else:
                            out.append((ids[r], p["first"], p["least"], short[a : a + p["n"] + WINDOW - 1].tobytes(), None))
                columns = list(zip(*out)) if out else [[]] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["doc", "first", "least", "words", "window"])

    return rows.mapInArrow(run, "doc bigint, first int, least bigint, words binary, window bigint")


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS, hot_passages: int = HOT_PASSAGES) -> DataFrame:
    """(doc, begin, stop): word ranges of the documents that are covered by repeated windows."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).where("doc is not null and text is not null")
    again = saved(_counts(rows).groupBy("least").agg(F.sum("n").alias("n")).where("n > 1").select("least"), "minimizers")
    runs = saved(_runs(rows).join(again, "least"), "passages")
    earliest = runs.groupBy("least", "content", "n").agg(F.min(F.struct("doc", "first")).alias("e"))
    leaders = saved(earliest.select("least", "content", "n", F.col("e.doc").alias("doc0"), F.col("e.first").alias("first0")), "leaders")
    # all windows of a passage that came before as a whole are repeated
    later = runs.join(leaders, ["least", "content", "n"]).where("doc <> doc0 or first <> first0")
    later = later.select("doc", F.col("first").alias("begin"), (F.col("first") + F.col("n") + WINDOW - 1).alias("stop"))
    # the earliest ones are compared in shards
    many = saved(leaders.groupBy("least").count().where(F.col("count") > hot_passages).select("least", F.lit(True).alias("hot")), "hot")
    words = leaders.agg(F.sum(F.col("n") + WINDOW - 1)).first()[0] or 0
    shards = 1 + words // shard_words
    part = F.struct(F.col("first0").alias("first"), "n", "least", F.coalesce("hot", F.lit(False)).alias("hot"))
    wanted = leaders.join(many, "least", "left").groupBy(F.col("doc0").alias("doc")).agg(F.collect_list(part).alias("parts"))
    spelled = saved(_spelled(rows.join(saved(wanted, "wanted"), "doc").select("doc", "text", "parts")), "words")
    dealt = spelled.where("words is not null").withColumn("shard", F.pmod(F.xxhash64("least"), F.lit(shards)))
    found = dealt.distinct().groupBy("shard").applyInPandas(_search, INTERVAL)
    single = spelled.where("window is not null").select("doc", "first", "window")
    least = saved(single.groupBy("window").agg(F.min(F.struct("doc", "first")).alias("e")), "windows")
    hot = single.join(least, "window").where("doc <> e.doc or first <> e.first")
    hot = hot.select("doc", F.col("first").alias("begin"), (F.col("first") + WINDOW).alias("stop"))
    return found.union(later).union(hot)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) per row of ``docs``.

    Words are runs of anything but space and tab to carriage return, unchanged; each word in a repeated window
    goes, and the kept ones are joined by one blank. Windows are judged on the input. A null text
    has no words. A row without an id keeps all its words and repeats nothing. Rows with one id are one
    document: where they differ, a place of any counts for all.
    """
    spans = saved(repeats(docs, doc_id, text, **sizes), "repeats")
    spans = spans.groupBy("doc").agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))  # no more than the document has words
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            spans = batch.column(2).to_pylist()
            n, removed, kept = [], [], []
            for value, own in zip(batch.column(1).cast(pa.binary()), spans):
                words = (value.as_py() or b"").split()
                n.append(len(words))
                if own:
                    change = np.zeros(len(words) + 1, np.int64)
                    places = np.array([(s["begin"], s["stop"]) for s in own]).clip(0, len(words))
                    np.add.at(change, places[:, 0], 1)
                    np.add.at(change, places[:, 1], -1)
                    stays = np.cumsum(change[:-1]) == 0
                    words = [w for w, k in zip(words, stays.tolist()) if k]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    joined = rows.join(saved(spans, "spans"), "doc", "left").select("doc", "text", "spans")
    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
