"""Nearest neighbours with learned partitions.

On a bounded sample the neighbour graph is cut into parts of equal size, and a small network learns to tell
from a vector which parts its neighbours are in. Every row is indexed under its likeliest part; a
query goes to its likeliest parts until their probabilities add up to a share that was found on the sample, and
all rows there are ranked by the exact measure.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.llm.store import saved

SAMPLE_ROWS = 4096
PARTS = 16
GRAPH_NEIGHBOURS = 16
HIDDEN = 128
EPOCHS = 150
TARGET = 0.95
BLOCK_ROWS = 20_000
QUERY_ROWS = 500


def graph(x: np.ndarray, k: int, block: int = 512) -> np.ndarray:
    """The ``k`` rows of largest inner product with each row, itself left out."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), block):
        s = x[a : a + block] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + block] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def partition(near: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Parts of equal size (to one row) that cut few edges: repeated halving, then exchanges.

    A half is the lower side of the graph's slowest vector of a random walk, cut at its median.
    """
    rng = np.random.default_rng(seed)
    n = len(near)
    a = np.concatenate((np.repeat(np.arange(n), near.shape[1]), near.ravel()))
    b = np.concatenate((near.ravel(), np.repeat(np.arange(n), near.shape[1])))
    part = np.zeros(n, np.int64)
    for _ in range(max(0, (parts - 1).bit_length())):
        same = part[a] == part[b]
        u, v = a[same], b[same]
        degree = np.maximum(np.bincount(u, minlength=n), 1)
        x = rng.normal(size=n)
        size = np.bincount(part)
        for _ in range(40):
            x = 0.5 * (x + np.bincount(u, x[v], minlength=n) / degree)
            x -= (np.bincount(part, x) / size)[part]
            x /= np.sqrt(np.bincount(part, x * x) + 1e-300)[part]
        order = np.lexsort((np.arange(n), x, part))
        place = np.arange(n) - np.concatenate(([0], np.cumsum(size)))[part[order]]
        new = np.empty(n, np.int64)
        new[order] = 2 * part[order] + (place >= (size[part[order]] + 1) // 2)
        part = np.unique(new, return_inverse=True)[1]
    count = part.max() + 1
    for _ in range(20):  # exchange rows that both gain by it
        ties = np.zeros((n, count))
        np.add.at(ties, (a, part[b]), 1)
        want = ties.argmax(axis=1)
        gain = ties[np.arange(n), want] - ties[np.arange(n), part]
        moved = 0
        for p in range(count):
            for q in range(p + 1, count):
                go = np.flatnonzero((part == p) & (want == q) & (gain > 0))
                come = np.flatnonzero((part == q) & (want == p) & (gain > 0))
                m = min(len(go), len(come))
                part[go[np.argsort(-gain[go])[:m]]] = q
                part[come[np.argsort(-gain[come])[:m]]] = p
                moved += m
        if not moved:
            break
    return part


@dataclass
class Router:
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    mass: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Probability of each part for each row."""
        h = np.maximum(x / self.scale @ self.w1 + self.b1, 0)
        z = h @ self.w2 + self.b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def routes(self, x: np.ndarray, held: np.ndarray, least: int) -> list[np.ndarray]:
        """Parts of each row, likeliest first, until their odds reach ``mass`` and they hold ``least`` rows (``held``: rows per part)."""
        p = self.odds(x)
        order = np.argsort(-p, axis=1, kind="stable")
        odds, rows = np.take_along_axis(p, order, axis=1), held[order]
        before, rows_before = np.cumsum(odds, axis=1) - odds, np.cumsum(rows, axis=1) - rows
        go = (before < self.mass) | (rows_before < least)
        return [o[g & (held[o] > 0)] for o, g in zip(order, go)]


def fit(x: np.ndarray, parts: int = PARTS, target: float = TARGET, seed: int = 7) -> Router:
    """Router from a sample; ``mass`` is such that ``target`` of the sample's neighbours are reached."""
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    scale = float(np.sqrt((x * x).sum(axis=1).mean() / dim)) or 1.0
    if len(x) < 4 * parts:
        return Router(scale, np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 2.0)
    near = graph(x, GRAPH_NEIGHBOURS)
    part = partition(near, parts)
    count = int(part.max()) + 1
    goal = np.zeros((len(x), count))
    np.add.at(goal, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1 / near.shape[1])
    goal = 0.5 * goal + 0.5 * np.eye(count)[part]
    held = np.arange(len(x)) % 4 == 0
    w = [rng.normal(size=(dim, HIDDEN)) / np.sqrt(dim), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, count)) / np.sqrt(HIDDEN), np.zeros(count)]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    rows, turn = np.flatnonzero(~held), 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(rows), max(1, len(rows) // 512)):
            turn += 1
            xi = x[batch] / scale
            h = np.maximum(xi @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - goal[batch]) / len(batch)
            dh = (dz @ w[2].T) * (h > 0)
            for i, g in enumerate((xi.T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                g = g + (1e-3 * w[i] if i in (0, 2) else 0)
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 0.003 * (m[i] / (1 - 0.9**turn)) / (np.sqrt(v[i] / (1 - 0.999**turn)) + 1e-8)
    router = Router(scale, *w, 1.0)
    odds = router.odds(x)
    stored = odds.argmax(axis=1)  # where the index puts each row
    q = odds[held]
    order = np.argsort(-q, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(q, order, axis=1), axis=1) - np.take_along_axis(q, order, axis=1)
    at = np.argsort(order, axis=1)
    needed = np.sort(np.take_along_axis(np.take_along_axis(before, at, axis=1), stored[near[held]], axis=1).ravel())
    router.mass = float(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) + 1e-9
    return router


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part: finite, not zero, of the most usual length; one per id."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))
    sizes = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1)
    usual = sizes.first()
    return rows.where(F.col("dim") == (usual[0] if usual else 0)).drop("dim").dropDuplicates(["vec_id"])


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def nearest(ids: np.ndarray, x: np.ndarray, own: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the ``k`` rows of largest inner product, ties to the smaller id, without its own id.

    Matrix products round differently by shape; so all rows near the k-th score are measured again, one
    way for all, before ranking.
    """
    out = []
    rough = q @ x.T
    slack = 1e-9 * np.sqrt((q * q).sum(axis=1) * (x * x).sum(axis=1).max())
    for i in range(len(q)):
        s = np.where(ids == own[i], -np.inf, rough[i])
        least = np.partition(s, -k)[-k] if len(s) > k else -np.inf
        pick = np.flatnonzero((s >= least - slack[i]) & (ids != own[i]))
        exact = (x[pick] * q[i]).sum(axis=1)
        order = np.lexsort((ids[pick], -exact))[:k]
        out.append((ids[pick][order], exact[order]))
    return out


def search(
    df: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
    target: float = TARGET, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): neighbours of the rows whose id ``every`` divides, among all other rows.

    The router is fitted on the ``sample_rows`` rows of smallest id hash; all rows are indexed. Rows of a part
    are dealt into blocks of about ``BLOCK_ROWS``, so many equal vectors are never one task's work.
    Null ids, null, zero and non-finite vectors and unusual lengths take no part; of rows with
    one id one does. A query goes on to further parts until they hold ``k`` rows besides itself, so that it gets
    fewer only where there are fewer candidates. Index rows are sent once, to their block; queries pass by each block of their parts.
    """
    rows = saved(usable(df, vec_id, vector), "vectors")
    shown = "query_id bigint, rank int, vec_id bigint, score double"
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow()["v"]
    if not len(sample):
        return df.sparkSession.createDataFrame([], shown)
    router = df.sparkSession.sparkContext.broadcast(fit(_matrix(sample), parts, target))

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                part = router.value.odds(_matrix(batch.column(1))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *batch.columns], names=["part", "vec_id", "v"])

    index = saved(rows.mapInArrow(place, "part int, vec_id bigint, v array<double>"), "index")
    held = {r[0]: r[1] for r in index.groupBy("part").count().collect()}  # one row per part
    blocks = {p: 1 + (n - 1) // BLOCK_ROWS for p, n in held.items()}
    counts = np.array([held.get(p, 0) for p in range(max(held) + 1)] if held else [0])
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)

    def route(batches):
        for batch in batches:
            if batch.num_rows:
                at, part, block = [], [], []
                x = _matrix(batch.column(1))
                odds = router.value.odds(x[:1]).shape[1]
                for i, own in enumerate(router.value.routes(x, np.pad(counts, (0, odds - len(counts))), k + 1)):
                    for p in own:
                        n = blocks[int(p)]
                        at += [i] * n
                        part += [int(p)] * n
                        block += range(n)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(block, pa.int32()), batch.column(0).take(take), batch.column(1).take(take)],
                    names=["part", "block", "vec_id", "v"],
                )

    sizes = F.create_map(*[F.lit(x).cast("int") for p, n in blocks.items() for x in (p, n)])
    stored = index.withColumn("block", F.pmod(F.xxhash64("vec_id"), sizes[F.col("part")]).cast("int"))
    routed = asked.mapInArrow(route, "part int, block int, vec_id bigint, v array<double>")

    def rank(batches):
        current, parts, own = None, [], None
        for batch in batches:
            place = np.stack([np.asarray(batch.column(c)) for c in ("part", "block")])
            asks = batch.column("asked").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(asks)]):
                if lo == hi:
                    continue
                if current != tuple(place[:, lo]):
                    current, parts, own = tuple(place[:, lo]), [], None
                here = batch.slice(lo, hi - lo)
                if not asks[lo]:
                    parts.append(here)
                    continue
                if not parts:
                    continue
                if own is None:
                    block = pa.Table.from_batches(parts)
                    own = block["vec_id"].to_numpy(), _matrix(block["v"])
                for at in range(0, here.num_rows, QUERY_ROWS):
                    some = here.slice(at, QUERY_ROWS)
                    ids = some.column("vec_id").to_numpy()
                    got = nearest(*own, ids, _matrix(some.column("v")), k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids, [len(i) for i, _ in got])), *(pa.array(np.concatenate(c)) for c in zip(*got))], names=["query_id", "vec_id", "score"]
                    )

    grid = stored.withColumn("asked", F.lit(False)).unionByName(routed.withColumn("asked", F.lit(True)))
    grid = grid.repartition("part", "block").sortWithinPartitions("part", "block", "asked")
    found = grid.mapInArrow(rank, "query_id bigint, vec_id bigint, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
