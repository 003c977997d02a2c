"""Prediction by partial matching over bytes, trained on all training texts and never held in one place.

The trie of byte contexts is a set of tables, one per order: (gram, n), where a gram is a context and the byte after
it; n counts its uses for the longest contexts, and for shorter ones the different contexts, a byte longer, after which the same byte came
(update exclusion). A symbol seen after its longest context has probability (2n - 1) / 2N there, N being the uses of the context
and n those with this symbol; with t different symbols the rest, t / 2N, is the escape to the context without its
oldest byte. There all symbols of the longer context are excluded. Since whatever follows a context also follows its
shorter ones, the excluded symbols are always those of the context just left, so two numbers of each node, how many
symbols it has and how often the shorter context met these (its shadow), exclude them exactly. Below order 0 the bytes not yet excluded are
equally likely. Text begins after bytes that no text holds, and ends in another such byte, so that the probabilities
of all texts add up to one.

Texts are dealt into blocks. A block names each of its different grams and words once with its training count;
counts are added up, probabilities worked out per gram and sent back to the blocks that have it, and each
block scores its texts. Neither the trie nor the vocabulary is ever broadcast or collected. What a block names is
sent in pieces, packed arrays of one bucket of the keys' hash, so that Spark moves rows of some kilobytes and not one per gram.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.llm.store import saved
from fitloom.llm.words import LOWER, SAME, WHITE, Words, released, slices, split

ORDER = 5
BLOCK_BYTES = 32 << 20
BEGIN, END = 0xFE, 0xFF  # bytes that UTF-8 never uses
SYMBOLS = 256
PENDING = 1 << 21
PIECE = 512
MAX_BUCKETS = 4096
ROWS = 50_000
ALPHA = 0.1
GRAM, WORD, TEXT = 0, 1, 2
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def spread(keys: np.ndarray) -> np.ndarray:
    """Even 64-bit hashes of 64-bit keys; what comes of them begins with the highest bits."""
    return keys.view(np.uint64) * SPREAD


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key; ``buckets`` is a power of two."""
    return (spread(keys) >> np.uint64(33)).astype(np.int64) & (buckets - 1)


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Per text its bytes in A-Z lower case and then the end, each with the ``order`` bytes before it; the symbol is the lowest byte."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    buffer = np.full(len(data) + rows * (order + 1), BEGIN, np.uint8)
    shift = np.arange(rows) * (order + 1) + order
    buffer[np.arange(len(data)) + np.repeat(shift, size)] = LOWER[data]
    buffer[offsets[1:] + shift] = END
    b = buffer.astype(np.int64)
    out = b.copy()
    for j in range(1, order + 1):
        out[j:] |= b[:-j] << (8 * j)
    return out[buffer != BEGIN]


class Tally:
    """Sums per 64-bit key, in sorted runs that are merged now and then."""

    def __init__(self):
        self.runs, self.pending = [], 0

    def add_flags(self, keys: np.ndarray, flags: np.ndarray) -> None:
        """Keys below 2**62 with weights of 0 or 1, which are sorted as one number."""
        both = np.sort(keys * 2 + flags)
        first = np.flatnonzero(np.concatenate(([True], both[1:] >> 1 != both[:-1] >> 1)))
        self._keep(both[first] >> 1, np.add.reduceat(both & 1, first))

    def add(self, keys: np.ndarray, weights: np.ndarray) -> None:
        """``weights`` are whole numbers of at least zero."""
        self._keep(*self._summed(keys, weights))

    def _keep(self, keys: np.ndarray, weights: np.ndarray) -> None:
        self.runs.append((keys, weights))
        self.pending += len(self.runs[-1][0])
        if self.pending > PENDING and len(self.runs) > 1:
            self.total()

    @staticmethod
    def _summed(keys, weights):
        if not len(keys):
            return keys, weights
        at = np.argsort(keys, kind="stable")  # they come as sorted runs, which this only merges
        keys, weights = keys[at], weights[at]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.add.reduceat(weights, first)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.runs) > 1:
            self.runs = [self._summed(*(np.concatenate(c) for c in zip(*self.runs)))]
        self.pending = 0
        return self.runs[0] if self.runs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Lookup:
    """Values of 64-bit keys, all of them known: keys lie in the order of a hash, and a search begins where its hash begins."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(8, len(keys).bit_length()))
        at = self._place(keys)
        order = np.argsort(at)
        self.keys, self.values = keys[order], values[order]
        self.first = np.cumsum(np.bincount(at, minlength=1 << (64 - int(self.shift)))) - 1
        self.first[1:] = self.first[:-1] + 1
        self.first[0] = 0

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (spread(keys) >> self.shift).astype(np.int64)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        at = self.first[self._place(wanted)]
        open_ = np.flatnonzero(self.keys[at] != wanted) if len(wanted) else at
        while len(open_):
            at[open_] += 1
            open_ = open_[self.keys[at[open_]] != wanted[open_]]
        return self.values[at]


def _blocks(batches, names):
    """(block, part of a batch) for each run of rows of one block."""
    for batch in batches:
        at = np.asarray(batch.column("block"))
        cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
            if hi > lo:
                yield int(at[lo]), batch.slice(lo, hi - lo).select(names)


def _text(words: Words, i: int) -> bytes:
    return LOWER[words.data[words.start[i] : words.stop[i]]].tobytes()


def _tallied(order: int, buckets: int):
    """Task code: (block, kind, bucket, keys, n) for the different grams and words of each block, in packed pieces.

    Keys are 64-bit grams as differences from each other, or words with line ends between them.
    """

    def pieces(block, tallies, known):
        for kind, tally in ((GRAM, tallies[0]), (WORD, tallies[1])):
            keys, n = tally.total()
            bucket = buckets_of(keys, buckets)
            order = np.argsort(bucket.astype(np.uint16), kind="stable")  # by counting; keys are in order already
            keys, n, bucket = keys[order], n[order].astype(np.int32), bucket[order]
            edges = np.concatenate((np.searchsorted(bucket, np.arange(buckets)), [len(keys)]))
            for b in range(buckets):
                for i in range(edges[b], edges[b + 1], PIECE):
                    j = min(i + PIECE, edges[b + 1])
                    part = np.diff(keys[i:j], prepend=np.int64(0)).tobytes() if kind == GRAM else b"\n".join([known[k] for k in keys[i:j].tolist()])
                    yield block, kind, b, part, n[i:j].tobytes()

    def out(rows):
        names, kinds = ["block", "kind", "bucket", "keys", "n"], [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        while part := list(itertools.islice(rows, 2000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names=names)

    def run(batches):
        current, tallies, known = None, (Tally(), Tally()), {}
        for block, part in _blocks(batches, ["train", "text"]):
            if block != current:
                if current is not None:
                    yield from out(pieces(current, tallies, known))
                current, tallies, known = block, (Tally(), Tally()), {}
            train = part.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
            for rows, data, offsets in slices(part.column("text")):
                learned = train[rows.start : rows.stop]
                tallies[0].add_flags(grams(data, offsets, order), np.repeat(learned, np.diff(offsets) + 1))
                words = split(rows, data, offsets, WHITE, LOWER)
                keys, at, back = np.unique(words.hashes.view(np.int64), return_index=True, return_inverse=True)
                weight = np.bincount(back, np.repeat(learned, words.counts()), len(keys)).astype(np.int64)
                tallies[1].add(keys, weight)
                known.update((k, _text(words, i)) for k, i in zip(keys.tolist(), at.tolist()) if k not in known)
        if current is not None:
            yield from out(pieces(current, tallies, known))
        del tallies, known
        released()

    return run


def _words(piece: bytes) -> pa.Array:
    return pa.array(piece.split(b"\n"), pa.binary())


def _grams(piece: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(piece, np.int64))


def _groups(batches, names):
    """((kind, bucket), part of a batch) for each run of rows of one kind and bucket."""
    for batch in batches:
        kind, bucket = (np.asarray(batch.column(c)) for c in ("kind", "bucket"))
        cuts = np.flatnonzero((kind[1:] != kind[:-1]) | (bucket[1:] != bucket[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(kind)]):
            if hi > lo:
                yield (int(kind[lo]), int(bucket[lo])), batch.slice(lo, hi - lo).select(names)


class WordTally:
    """Sums per word, merged now and then."""

    def __init__(self):
        self.parts, self.pending = [], 0

    def add(self, words: pa.Array, n: np.ndarray) -> None:
        self.parts.append(pa.table({"k": words, "n": pa.array(n, pa.int64())}))
        self.pending += len(words)
        if self.pending > PENDING:
            self.total()

    def total(self) -> pa.Table:
        self.parts = [pa.concat_tables(self.parts).group_by("k").aggregate([("n", "sum")]).rename_columns(["k", "n"])]
        self.pending = 0
        return self.parts[0]


def _summed(batches):
    """Task code: (kind, bucket, gram, word, n) per different gram or word, from all pieces of its bucket."""
    names = ["kind", "bucket", "gram", "word", "n"]

    def out(key, tally):
        if key[0] == GRAM:
            keys, n = tally.total()
            cells = pa.table({"k": keys, "n": n})
        else:
            cells = tally.total()
        for i in range(0, len(cells), ROWS):
            part = cells.slice(i, ROWS)
            k, size = part["k"].combine_chunks(), len(part)
            none = pa.nulls(size, pa.binary() if key[0] == GRAM else pa.int64())
            both = [k, none] if key[0] == GRAM else [none, k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, key[0], np.int32)), pa.array(np.full(size, key[1])), *both, part["n"].combine_chunks()], names=names
            )

    current, tally = None, None
    for key, part in _groups(batches, ["keys", "n"]):
        if key != current:
            if current is not None:
                yield from out(current, tally)
            current, tally = key, Tally() if key[0] == GRAM else WordTally()
        for keys, n in zip(part.column("keys").to_pylist(), part.column("n").to_pylist()):
            tally.add(_grams(keys) if key[0] == GRAM else _words(keys), np.frombuffer(n, np.int32).astype(np.int64))
    if current is not None:
        yield from out(current, tally)


def _valued(batches):
    """Task code: (block, kind, keys, values) per piece, after the values of all grams or words of its bucket.

    Words go on as their hashes.
    """
    current, held, looked = None, [], None
    for key, part in _groups(batches, ["block", "gram", "word", "value", "keys"]):
        if key != current:
            current, held, looked = key, [], None
        own = part.column("block").is_null().to_numpy(zero_copy_only=False)
        n = int(own.sum())
        if n:
            held.append(part.slice(0, n))
        part = part.slice(n)
        if not part.num_rows:
            continue
        if looked is None:
            table = pa.Table.from_batches(held)
            looked = Lookup(table["gram"].to_numpy(), table["value"].to_numpy()) if key[0] == GRAM else (table["word"].combine_chunks(), table["value"].to_numpy())
            held = []
        keys, values = [], []
        for piece in part.column("keys").to_pylist():
            if key[0] == GRAM:
                wanted = _grams(piece)
                keys.append(wanted.tobytes())
                values.append(looked.of(wanted).tobytes())
            else:
                line = np.frombuffer(piece, np.uint8)
                keys.append(split(range(1), line, np.array([0, len(line)]), WHITE, SAME).hashes.tobytes())
                values.append(looked[1][pc.index_in(_words(piece), looked[0]).to_numpy()].tobytes())
        yield pa.RecordBatch.from_arrays(
            [part.column("block"), pa.array(np.full(part.num_rows, key[0], np.int32)), pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
            names=["block", "kind", "keys", "values"],
        )
    del held, looked
    released()


def _mask(order: int) -> int:
    return (1 << (8 * (order + 1))) - 1


def trie(counts: DataFrame, order: int) -> list[DataFrame]:
    """(gram, n) of every order from 0 to ``order``, from the longest grams ``counts``, each once and n above zero.

    A shorter gram counts the longer ones that end in it.
    """
    levels = [counts]
    for k in range(order - 1, -1, -1):
        shorter = levels[0].groupBy(F.col("gram").bitwiseAND(F.lit(_mask(k))).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels.insert(0, saved(shorter, f"order-{k}"))
    return levels


def _symbol(gram: str = "gram") -> Column:
    return F.col(gram).bitwiseAND(F.lit(255)).cast("int")


def nodes(levels: list[DataFrame], k: int) -> DataFrame:
    """(context, total, kinds, shadow, seen) of order ``k``: uses, different symbols, the uses of these symbols after the next
    shorter context, and the count of each symbol, at most ``SYMBOLS`` of them."""
    rows = levels[k].withColumn("under", F.lit(0).cast("bigint"))
    if k:
        short = levels[k - 1].select(F.col("gram").alias("short"), F.col("n").alias("under"))
        # at most SYMBOLS grams share a shorter one
        rows = levels[k].withColumn("short", F.col("gram").bitwiseAND(F.lit(_mask(k - 1)))).join(short, "short")
    return rows.groupBy(F.shiftright("gram", 8).alias("context")).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("under").alias("shadow"),
        F.map_from_entries(F.collect_list(F.struct(_symbol(), "n"))).alias("seen"),
    )


def costs(wanted: DataFrame, order: int) -> DataFrame:
    """(gram, cost) per row of ``wanted`` (gram, n), each gram once: log10 of the symbol's probability after its context.

    ``n`` is the training count, 0 for a gram met in other texts only. Such grams escape from order to order;
    ``out`` symbols are excluded by then, which have ``mass`` uses after the context that comes next.
    """
    zero = F.lit(0).cast("bigint")
    levels = trie(wanted.where("n > 0"), order)
    done = None
    open_ = wanted.select("gram", F.lit(0.0).alias("cost"), zero.alias("out"), zero.alias("mass"), F.col("n").alias("own"))
    for k in range(order, -1, -1):
        own = F.shiftright(F.col("gram").bitwiseAND(F.lit(_mask(k))), 8)
        if k == order:
            node, n = nodes(levels, k).drop("seen"), F.col("own")
        else:
            node, n = saved(nodes(levels, k), f"nodes-{k}"), F.coalesce(F.col("seen")[_symbol()], zero)
        if k < 2:
            node = F.broadcast(node)  # at most SYMBOLS nodes of at most SYMBOLS symbols
        left, kinds = F.col("total") - F.col("mass"), F.col("kinds") - F.col("out")
        step = F.when(n > 0, F.log10((2 * n - 1) / (2 * left))).when(kinds > 0, F.log10(kinds / (2 * left))).otherwise(F.lit(0.0))
        here = open_.withColumn("context", own).join(node, "context", "left").select(
            "gram", (n > 0).alias("met"), (F.col("cost") + step).alias("cost"), F.coalesce("kinds", zero).alias("out"), F.coalesce("shadow", zero).alias("mass")
        )
        here = saved(here, f"placed-{k}")
        met = here.where("met").select("gram", "cost")
        done = met if done is None else done.unionByName(met)
        open_ = here.where("not met").drop("met")
    unseen = open_.select("gram", (F.col("cost") - F.log10(F.lit(SYMBOLS) - F.col("out"))).alias("cost"))
    return done.unionByName(unseen)


def _scored(order: int, train_tokens: int, kinds: int, ends: int):
    """Task code: scores of the texts of a block, after its grams with their costs and its words with their counts."""
    names = ["id", "train", "n_tokens", "n_known", "base_score", "score"]

    def base(c):
        return np.log10((c + ALPHA) / (train_tokens + ALPHA * (kinds + 1)))

    def table(pieces):
        keys, values = (np.frombuffer(b"".join(c), t) for c, t in zip(zip(*pieces), (np.int64, np.float64))) if pieces else (np.zeros(0, np.int64), np.zeros(0))
        return Lookup(keys, values)

    def run(batches):
        current, held, looked = None, ([], []), None
        for block, part in _blocks(batches, ["kind", "keys", "values", "id", "train", "text"]):
            if block != current:
                current, held, looked = block, ([], []), None
            kind = np.asarray(part.column("kind"))
            cuts = np.searchsorted(kind, [GRAM, WORD, TEXT])
            for which in (GRAM, WORD):
                some = part.slice(cuts[which], cuts[which + 1] - cuts[which])
                held[which].extend(zip(some.column("keys").to_pylist(), some.column("values").to_pylist()))
            docs = part.slice(cuts[TEXT])
            if not docs.num_rows:
                continue
            if looked is None:
                looked = table(held[GRAM]), table(held[WORD])
                held = ([], [])
            n_tokens, n_known, low, score = [], [], [], []
            for rows, data, offsets in slices(docs.column("text")):
                found = looked[GRAM].of(grams(data, offsets, order))
                score.append(np.add.reduceat(found, offsets[:-1] + np.arange(len(rows))))
                words = split(rows, data, offsets, WHITE, LOWER)
                counts = words.counts()
                c = looked[WORD].of(words.hashes.view(np.int64))
                before = np.concatenate(([0], np.cumsum(c > 0)))
                n_tokens.append(counts + 1)
                n_known.append(np.diff(before[words.first]) + (ends > 0))
                sums = np.bincount(np.repeat(np.arange(len(rows)), counts), base(c), len(rows)) if len(c) else np.zeros(len(rows))
                low.append(sums + base(ends))
            columns = [np.concatenate(x) for x in (n_tokens, n_known, low, score)]
            yield pa.RecordBatch.from_arrays([docs.column("id"), docs.column("train"), *map(pa.array, columns)], names=names)
        del held, looked
        released()

    return run


def score(
    docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    The model learns from the rows for which ``train`` holds and scores all: ``score`` is its log10 probability of the
    whole text in A-Z lower case, with its end. ``base_score`` is that of words (split at white space) and one end
    each by their training counts, smoothed by ``ALPHA``; ``n_known`` counts those of training, ``train_tokens`` all
    tokens learned from.

    A null text is empty: its end alone is scored. A row for which ``train`` is null is held out. Repeated rows are learned
    and scored as often as they come. Without training rows every byte is equally likely. An empty
    table gives no rows; other columns are ignored. Rows go to blocks by the hash of id and text; a task holds the
    different grams of one block, at most one per byte, and one text.
    """
    if not 0 <= order <= 6:
        raise ValueError("order must be from 0 to 6")
    spark = docs.sparkSession
    inner = docs.select(F.col(doc_id).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    size, ends = inner.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if("train")).first()
    blocks = 1 + size // block_bytes
    buckets = min(MAX_BUCKETS, 1 << int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())
    dealt = inner.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    texts = dealt.repartition("block").sortWithinPartitions("block")
    seen = saved(texts.mapInArrow(_tallied(order, buckets), "block bigint, kind int, bucket bigint, keys binary, n binary"), "tallies", "zstd")

    at = ["kind", "bucket"]
    sums = seen.select(*at, "keys", "n").repartition(*at).sortWithinPartitions(*at)
    sums = saved(sums.mapInArrow(_summed, "kind int, bucket bigint, gram bigint, word binary, n bigint"), "sums")
    tokens, kinds = sums.where((F.col("kind") == WORD) & (F.col("n") > 0)).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, kinds = tokens + ends, kinds + (ends > 0)

    own = sums.where(F.col("kind") == GRAM)
    cost = costs(own.select("gram", "n"), order)
    key = {"kind": "int", "bucket": "bigint", "block": "bigint", "gram": "bigint", "word": "binary", "value": "double", "keys": "binary"}

    def shaped(frame):
        return frame.select(*[(F.col(c) if c in frame.columns else F.lit(None)).cast(t).alias(c) for c, t in key.items()])

    values = shaped(own.select("kind", "bucket", "gram").join(cost.withColumnRenamed("cost", "value"), "gram"))
    values = values.unionByName(shaped(sums.where(F.col("kind") == WORD).withColumn("value", F.col("n"))))
    both = values.unionByName(shaped(seen)).repartition(*at).sortWithinPartitions(*at, F.col("block").isNotNull())
    back = both.mapInArrow(_valued, "block bigint, kind int, keys binary, values binary")

    row = {"block": "bigint", "kind": "int", "keys": "binary", "values": "binary", "id": dict(dealt.dtypes)["id"], "train": "boolean", "text": "string"}

    def laid(frame):
        return frame.select(*[(F.col(c) if c in frame.columns else F.lit(None)).cast(t).alias(c) for c, t in row.items()])

    everything = laid(back).unionByName(laid(dealt.withColumn("kind", F.lit(TEXT))))
    found = everything.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
        _scored(order, tokens, kinds, ends), f"id {row['id']}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return found.select(
        F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
