"""Hard negatives of anchors, by the threshold algorithm over sorted lists of every dimension.

Rows are dealt into blocks of bounded size. A block keeps one list of its rows per dimension, sorted by the
component there. All anchors pass by each block: an anchor reads every list from the end that its own sign
favours, each row met first there is scored by an integer inner product, and the components last read bound
what any row not yet met can score. Reading ends once this threshold is strictly below the kth score of every
window (a tie could still have a smaller id), or below the window itself. The first rows of the blocks are then
merged per anchor. Blocks hold no copies of each other's rows; only the anchors are sent to each block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.llm.store import saved

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
BLOCK_ROWS = 65_536
LEAST_BLOCK = 2_048
FIRST_DEPTH = 64
EXACT = 1 << 53


def _vectors(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros, and so do all up to ``width``."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    out = np.zeros((len(column), max(int(size.max(initial=0)), width or 0)), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out if width is None else out[:, :width]


@dataclass
class Block:
    """Rows and, per dimension, their places in ascending order of the component."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    order: np.ndarray
    most: int

    @classmethod
    def of(cls, batches: list[pa.RecordBatch]) -> Block:
        table = pa.Table.from_batches(batches).combine_chunks()
        x = _vectors(table["v"].chunk(0))
        order = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)
        most = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))))
        return cls(table["id"].to_numpy(), table["label"].to_numpy(), x, np.ascontiguousarray(order), most)

    def __post_init__(self):
        self.real = self.x.astype(np.float64) if self.most < EXACT else None

    def scores(self, rows: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Exact integer inner products: in doubles while every sum stays below 2**53, else in Python's integers."""
        if self.real is not None and self.most * sum(abs(int(v)) for v in a) < EXACT:
            return (self.real[rows] @ a.astype(np.float64)).astype(np.int64)
        return np.array([sum(int(p) * int(q) for p, q in zip(row, a)) for row in self.x[rows]], object)

    def first(self, a: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]], k: int):
        """Per window (low, high) its ``k`` allowed rows of highest score in it, ties by smaller id, as (id, score); and the rows scored."""
        n = len(self.ids)
        used = np.flatnonzero(a)
        rising, falling = used[a[used] < 0], used[a[used] > 0]
        seen = np.zeros(n, bool)
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        open_ = [w for w, (low, high) in enumerate(windows) if low is None or high is None or low <= high]
        depth, step, scored = 0, FIRST_DEPTH, 0
        while open_:
            to = min(n, depth + step) if len(used) else n
            fresh = np.zeros(n, bool)
            if to == n:
                fresh[:] = True
            else:
                fresh[self.order[rising, depth:to]] = True
                fresh[self.order[falling, n - to : n - depth]] = True
            rows = np.flatnonzero(fresh & ~seen & allowed)
            seen |= fresh
            s = self.scores(rows, a)
            scored += len(rows)
            threshold = None
            if to < n:
                last = np.concatenate((self.x[self.order[rising, to - 1], rising], self.x[self.order[falling, n - to], falling]))
                threshold = sum(int(p) * int(q) for p, q in zip(last, np.concatenate((a[rising], a[falling]))))
            for w in list(open_):
                low, high = windows[w]
                inside = np.ones(len(rows), bool)
                if low is not None:
                    inside &= s >= low
                if high is not None:
                    inside &= s <= high
                if len(best[w]) == k:
                    inside &= s >= best[w][-1][1]
                at = np.flatnonzero(inside)
                if len(at) > k:  # none below the kth of these can be among the first
                    at = at[s[at] >= np.sort(s[at])[-k]]
                best[w] = sorted([*best[w], *((int(self.ids[rows[i]]), int(s[i])) for i in at)], key=lambda r: (-r[1], r[0]))[:k]
                if threshold is None or (len(best[w]) == k and threshold < best[w][-1][1]) or (low is not None and threshold < low):
                    open_.remove(w)
            depth, step = to, step * 2
        return best, scored


def _pass(rows: DataFrame, asks: DataFrame, blocks: int, same: bool, k: int, low: int, high: int) -> DataFrame:
    """(ask, place, id, score): each block's first rows for each ask; ``place`` is the window's number.

    ``rows`` (block, id, label, v); ``asks`` (ask, id, label, v, scores): with ``same`` one window over all rows of the
    ask's label, else a window for each of its ``scores`` over the rows of other labels.
    """

    def run(batches):
        current, parts, block = None, [], None
        for batch in batches:
            at, asked = np.asarray(batch.column("block")), batch.column("ask").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (asked[1:] != asked[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
                if lo == hi:
                    continue
                if at[lo] != current:
                    current, parts, block = at[lo], [], None
                part = batch.slice(lo, hi - lo)
                if not asked[lo]:
                    parts.append(part)
                    continue
                if not parts:
                    continue
                block = block or Block.of(parts)
                out = []
                vectors = _vectors(part.column("v"), block.x.shape[1])
                names = [part.column(c).to_pylist() for c in ("ask", "id", "label", "scores")]
                for ask, own, label, scores, a in zip(*names, vectors):
                    if same:
                        allowed, windows = (block.labels == label) & (block.ids != own), [(None, None)]
                    else:
                        allowed, windows = block.labels != label, [(-(-low * p // 100), high * p // 100) for p in scores]
                    for w, found in enumerate(block.first(a, allowed, windows, k)[0]):
                        out += [(ask, w, i, s) for i, s in found]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["ask", "place", "id", "score"]
                )

    none = F.lit(None)
    held = rows.select("block", none.cast("bigint").alias("ask"), "id", "label", "v", none.cast("array<bigint>").alias("scores"))
    sent = asks.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "ask", "id", "label", "v", "scores")
    grid = held.unionByName(sent).repartitionByRange(blocks, "block").sortWithinPartitions("block", F.col("ask").isNotNull())
    found = grid.mapInArrow(run, "ask bigint, place int, id bigint, score bigint")
    order = W.partitionBy("ask", "place").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x); scores are integer inner products with the anchor, higher first, ties by
    smaller id. The positives of each row that ``anchor`` holds for are its first ``positives`` rows of the same label and another id; for
    each, the negatives are the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.

    Rows whose id, label or vector is null, or which hold a null or non-finite component, take no part. Of rows equal
    in id, label and integer vector one counts; rows of one id that differ are rows apart, and each an anchor of its
    own. Of vectors of different lengths the shorter counts as ended by zeros. An empty table gives no rows; other
    columns are ignored. A score beyond 64 bits raises.
    """
    spark = rows.sparkSession
    x = F.col(embedding)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    named = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & fine).select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    named = saved(named.groupBy("id", "label", "v").agg(F.max("anchor").alias("anchor")), "vectors")
    n, parts = named.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-n // block_rows), min(parts, -(-n // LEAST_BLOCK)), 1)  # how rows are dealt changes no result
    held = named.withColumn("block", F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)).cast("int"))
    asks = saved(named.where("anchor").withColumn("ask", F.monotonically_increasing_id()), "anchors")
    first = asks.select("ask", "id", "label", "v", F.lit(None).cast("array<bigint>").alias("scores"))
    found = saved(_pass(held, first, blocks, True, positives, low, high), "positives")
    # the windows of an anchor: one per positive, in rank order
    windows = found.groupBy("ask").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda r: r["score"]).alias("scores"))
    second = asks.join(windows, "ask").select("ask", "id", "label", "v", "scores")
    hard = _pass(held, second, blocks, False, negatives, low, high)
    hard = hard.select("ask", (F.col("place") + 1).alias("window"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    of = found.select("ask", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = hard.join(of, ["ask", "window"]).join(asks.select("ask", F.col("id").alias("anchor_id")), "ask")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
