"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Documents with the same set are one class. Tree t orders classes by the signature rotated to its own
place, and classes that agree on the first values there, as many as the forest is deep, share a region. In each order a class is compared with its next neighbours, those of the longest
common prefix, however dense the region is, and with the first class of its region there. Depth adapts to
the region: where more than ``DENSE`` classes share a prefix it is made longer, value by value, and each class is also
compared with the first of its own deeper region; most dense groups get connected by these. A region whose classes are still in
different components takes the class that leads most of them as its pivot; each set is written as its differences from the
pivot's, and only sets that share one of their rarest differences, at places in the order that leave room for as many shared ones as a
link needs, can still be linked and are compared. So no
region is capped, no group is expanded into all its pairs, and a pair is only ever missed when it
shares no region at all. Trees and depth follow from the threshold, so that at the threshold itself this
happens to about 1 in 135,000 whatever it is.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.llm.components import components
from fitloom.llm.store import saved
from fitloom.llm.words import LOWER, WHITE, mix, numbers, tidy, worded

SHINGLE = 5
PERCENT = 85
HASHES = 64
MAX_DEPTH = 4
MISS = (1 - 0.85**MAX_DEPTH) ** 16
NEIGHBOURS = 4
DENSE = 32
DEEPER = 8
SIGMAS = 5.5


@dataclass(frozen=True)
class Forest:
    """Each of ``trees`` trees looks at ``depth`` values of its own, out of ``hashes``."""

    trees: int
    depth: int
    hashes: int


def forest(percent: int) -> Forest:
    """The deepest forest of at most ``HASHES`` values that misses a pair at ``percent`` no more often than ``MISS``.

    Where even depth 1 needs more values than that, the signature gets longer.
    """
    p = min(max(percent, 1), 100) / 100
    for depth in range(MAX_DEPTH, 0, -1):
        trees = 1 if p == 1 else math.ceil(math.log(MISS) / math.log1p(-(p**depth)) - 1e-9)
        if trees * depth <= HASHES:
            return Forest(trees, depth, HASHES)
    return Forest(trees, 1, trees)


def shingle_sets(column: pa.Array, n: int = SHINGLE):
    """Sorted hashes of the distinct ``n``-word shingles of each text; a shorter text is one shingle."""
    for words in worded(column, WHITE, LOWER):
        grams, _ = words.grams(n)
        for i in range(len(words.rows)):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            else:
                yield np.array([words.whole(i)] if b > a else [], np.uint64)


def signature(shingles: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    out = np.full(len(factor), (1 << 32) - 1, np.uint32)
    for at in range(0, len(shingles), 2048):
        part = (shingles[at : at + 2048] * factor + shift) >> np.uint64(32)
        out = np.minimum(out, part.min(axis=1).astype(np.uint32))
    return out


def least_agreement(percent: int, shape: Forest) -> int:
    """Signature values in which a pair at the threshold agrees, less ``SIGMAS`` deviations."""
    p, n = percent / 100, shape.hashes
    return max(shape.depth, int(n * p - SIGMAS * (n * p * (1 - p)) ** 0.5))


def profiles(docs: DataFrame, hashes: int) -> DataFrame:
    """(id, n, digest, sketch) per row of ``docs`` (id, text); digest and sketch are null without words."""

    @tidy
    def run(batches):
        factor, shift = numbers(21, hashes)[:, None] | np.uint64(1), numbers(22, hashes)[:, None]
        for batch in batches:
            n, digest, sketch = [], [], []
            for s in shingle_sets(batch.column(1)):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sketch.append(signature(s, factor, shift).astype(">u4").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketch, pa.binary())],
                names=["id", "n", "digest", "sketch"],
            )

    return docs.select("id", "text").mapInArrow(run, "id bigint, n bigint, digest binary, sketch binary")


def _entries(classes: DataFrame, shape: Forest) -> DataFrame:
    """(region, tree, rep) of each class in each tree; the region is a hash of the tree and the prefix."""

    @tidy
    def run(batches):
        for batch in batches:
            reps = np.asarray(batch.column(0))
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(-1, shape.hashes).astype(np.uint64)
            for t in range(shape.trees):
                h = np.full(len(reps), t, np.uint64)
                for d in range(shape.depth):
                    h = mix(h + values[:, t * shape.depth + d] * np.uint64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.astype(np.int64)), pa.array(np.full(len(reps), t, np.int32)), batch.column(0)], names=["region", "tree", "rep"]
                )

    schema = "region bigint, tree int, rep bigint"
    return classes.select("rep", "sketch").mapInArrow(run, schema)


def deeper_firsts(new: np.ndarray, paths: np.ndarray, depth: int) -> np.ndarray:
    """For each row of sorted ``paths`` the first row that shares its prefix, longer than ``depth`` where more than ``DENSE`` rows do.

    ``new`` tells the rows that begin a region of ``depth`` equal values.
    """
    begins = new.copy()
    for at in range(depth, min(depth + DEEPER, paths.shape[1]) + 1):
        start = np.flatnonzero(begins)
        size = np.diff(np.concatenate((start, [len(new)])))
        here, many = np.repeat(start, size), np.repeat(size, size) > DENSE
        if at == depth:
            first, open_ = here, many
        else:
            first = np.where(open_, here, first)
            open_ &= many
        if not open_.any() or at == paths.shape[1]:
            break
        begins[1:] |= paths[1:, at] != paths[:-1, at]
    return first


def _neighbours(members: DataFrame, shape: Forest, least: int, parts: int) -> DataFrame:
    """(a, b, agree) of classes near each other in a tree's order, or first of their region there.

    Rows are range-partitioned on the order itself, so a region of any size is cut into many tasks.
    """
    at = (F.col("tree") * shape.depth * 4).cast("int")
    order = F.concat(F.substring(F.col("sketch"), at + 1, shape.hashes * 4), F.substring(F.col("sketch"), F.lit(1), at))
    inner = members.select("region", order.alias("path"), "tree", "rep", "n", "sketch")
    keys = ["region", "path", "rep"]

    @tidy
    def run(batches):
        regions, reps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        sketches = paths = np.zeros((0, shape.hashes), ">u4")
        head, pivot = None, None
        for batch in batches:
            regions = np.concatenate((regions, np.asarray(batch.column(0))))
            reps = np.concatenate((reps, np.asarray(batch.column(3))))
            own, path = (np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u4").reshape(-1, shape.hashes) for i in (5, 1))
            sketches, paths = np.concatenate((sketches, own)), np.concatenate((paths, path))
            pairs = []
            for step in range(1, NEIGHBOURS + 1):
                same = np.flatnonzero(regions[step:] == regions[:-step])
                pairs.append((same, same + step))
            new = np.concatenate(([True], regions[1:] != regions[:-1]))
            start = np.flatnonzero(new)
            first = np.repeat(start, np.diff(np.concatenate((start, [len(regions)]))))
            pairs.append((first, np.arange(len(regions))))
            deep = deeper_firsts(new, paths, shape.depth)
            below = np.flatnonzero(deep != first)
            pairs.append((deep[below], below))
            a, b = (np.concatenate(p) for p in zip(*pairs))
            rows = [(reps[a], reps[b], (sketches[a] == sketches[b]).sum(axis=1))]
            if head is not None:  # the first class of a region that began in an earlier batch
                same = np.flatnonzero(regions == head)
                rows.append((np.full(len(same), pivot[0]), reps[same], (sketches[same] == pivot[1]).sum(axis=1)))
            if len(start) and regions[start[-1]] != head:
                head, pivot = regions[start[-1]], (reps[start[-1]], sketches[start[-1]])
            x, y, agree = (np.concatenate(c) for c in zip(*rows))
            ok = (agree >= least) & (x != y)
            x, y, agree = x[ok], y[ok], agree[ok]
            if len(x):
                lo, hi = np.minimum(x, y), np.maximum(x, y)
                _, keep = np.unique(np.stack((lo, hi)), axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lo[keep]), pa.array(hi[keep]), pa.array(agree[keep].astype(np.int32))], names=["a", "b", "agree"]
                )
            regions, reps, sketches, paths = (c[-NEIGHBOURS:] for c in (regions, reps, sketches, paths))

    dealt = inner.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a bigint, b bigint, agree int").groupBy("a", "b").agg(F.max("agree").alias("agree"))


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))

    @tidy
    def run(batches):
        for batch in batches:
            keep = []
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for s, t in zip(shingle_sets(part.column(2)), shingle_sets(part.column(3))):
                    shared = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(s) + len(t) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(run, "a bigint, b bigint")


GROUP_ROWS = 10_000


def _differences(groups: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The shingles in which each class of a group (pivot, rep, root) differs from the pivot's set, one per row.

    For sets i and j that lack d and add a of the pivot's shingles let cost = 100 * d + percent * a and
    room = (100 - percent) * size of the pivot's set. A set is linked with the pivot when cost <= room,
    else it is far; i and j are linked when (100 + percent) * differences they share is at least
    cost(i) + cost(j) - room. So two sets that are not both linked with the pivot share a difference, and
    it is among the first ``reach`` of either in any common order: ``reach`` towards far sets, ``wide``
    towards sets linked with the pivot. A row without element says that the set is linked with the pivot.
    """

    @tidy
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                names = [part.column(i).to_pylist() for i in range(3)]
                out = []
                for pivot, rep, root, base, own in zip(*names, shingle_sets(part.column(3)), shingle_sets(part.column(4))):
                    lost, new = np.setdiff1d(base, own, True), np.setdiff1d(own, base, True)
                    cost, room = 100 * len(lost) + percent * len(new), (100 - percent) * len(base)
                    far = cost > room
                    size = len(lost) + len(new)
                    reach = size + 1 - -(-(cost + 1) // (100 + percent))
                    wide = size + 1 - -(-(cost - room) // (100 + percent)) if far else 0
                    if max(reach, wide) > 0:
                        out.append((pivot, rep, root, len(own), far, reach, wide, size, cost, room, np.concatenate((lost, new)).astype(np.int64)))
                    if not far:
                        out.append((pivot, rep, root, len(own), far, reach, wide, size, cost, room, None))
                if not out:
                    continue
                times = [1 if r[-1] is None else len(r[-1]) for r in out]
                cols = [pa.array(np.repeat(np.array([r[i] for r in out]), times)) for i in range(10)]
                elements = pa.chunked_array([pa.nulls(1, pa.int64()) if r[-1] is None else pa.array(r[-1]) for r in out])
                table = pa.table([*cols, elements], names=["pivot", "rep", "root", "n", "far", "reach", "wide", "size", "cost", "room", "element"])
                yield from table.combine_chunks().to_batches(100_000)

    salts = groups.groupBy("pivot").agg((F.count(F.lit(1)) / GROUP_ROWS + 1).cast("int").alias("salts"))
    bases = salts.join(texts.select(F.col("rep").alias("pivot"), F.col("text").alias("base")), "pivot")
    bases = bases.select("pivot", "base", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    dealt = groups.join(salts, "pivot").withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int"))
    both = dealt.join(texts, "rep").join(bases, ["pivot", "salt"]).select("pivot", "rep", "root", "base", "text")
    schema = "pivot bigint, rep bigint, root bigint, n bigint, far boolean, reach bigint, wide bigint, size bigint, cost bigint, room bigint, element bigint"
    return both.mapInArrow(run, schema)


def _sharing(diffs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of classes of different roots that share one of their rarest differences from a pivot.

    A link needs (cost(i) + cost(j) - room) / (100 + percent) shared differences. At the first that two sets share in the common
    order, at least so many places must be left in both; the pairs of a posting whose sets differ much elsewhere fall by this.
    """
    rows = diffs.where("element is not null")
    often = rows.groupBy("pivot", "element").agg(F.count(F.lit(1)).alias("often"))
    inside = W.partitionBy("pivot", "rep").orderBy("often", "element")
    ranked = rows.join(often, ["pivot", "element"]).withColumn("rank", F.row_number().over(inside))
    first = saved(ranked.where("often > 1 and rank <= greatest(reach, wide)").drop("often"), "rarest")
    x, y = first.where("far").alias("x"), first.alias("y")
    both_far = F.col("y.far") & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.rank") <= F.col("x.reach"))
    one_far = ~F.col("y.far") & (F.col("x.rank") <= F.col("x.wide"))
    close = (
        (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.root") != F.col("y.root"))
        & (F.col("y.rank") <= F.col("y.reach")) & (both_far | one_far)
        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
        & ((F.least(F.col("x.size") - F.col("x.rank"), F.col("y.size") - F.col("y.rank")) + 1) * (100 + percent) >= F.col("x.cost") + F.col("y.cost") - F.col("x.room"))
    )
    pairs = x.join(y, close).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
    return pairs.distinct()


def _place(nodes: DataFrame, roots: DataFrame, node: str, out: str) -> DataFrame:
    at = roots.select(F.col("node").alias(node), F.col("root").alias("__root"))
    return nodes.join(at, node, "left").withColumn(out, F.coalesce("__root", node)).drop("__root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Texts are linked when 100 * intersection >= ``percent`` * union of their sets of five-word
    shingles (A-Z in lower case; fewer words: all of them as one shingle). A text without words, or
    null, is its own component. Repeated rows share a component and its ``kept``. A row without
    an id gets no component and is not kept, and links nothing.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    shape = forest(percent)
    rows = saved(profiles(docs, shape.hashes), "profiles")
    classes = saved(
        rows.where("n > 0 and id is not null").groupBy("digest")
        .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "classes",
    )
    least = least_agreement(percent, shape)
    regions = saved(_entries(classes, shape).groupBy("region").count().where("count > 1").select("region"), "regions")
    members = saved(_entries(classes, shape).join(regions, "region").join(classes.select("rep", "n", "sketch"), "rep"), "members")
    shared = saved(members.select("rep").distinct(), "shared")
    texts = saved(docs.withColumnRenamed("id", "rep").join(shared, "rep").dropDuplicates(["rep"]), "texts")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = saved(_neighbours(members, shape, least, parts), "near")

    # first each class's best pair, then all that still lead elsewhere
    roots = None
    tested = None
    for whole in (False, True):
        open_ = near if roots is None else _crossing(near, roots).join(tested, ["a", "b"], "left_anti")
        if not whole:
            ends = open_.select(F.col("a").alias("node"), "a", "b", "agree").union(open_.select(F.col("b").alias("node"), "a", "b", "agree"))
            best = ends.groupBy("node").agg(F.max(F.struct("agree", (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))).alias("m"))
            open_ = best.select((-F.col("m.a")).alias("a"), (-F.col("m.b")).alias("b")).distinct()
        pairs = saved(open_.select("a", "b"), "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        roots = _joined(roots, saved(_confirmed(pairs, texts, percent), "links"))

    # the rest, exactly: pairs of one region that are still apart
    placed = saved(_place(members.select("region", "rep"), roots, "rep", "root"), "placed")
    held = placed.groupBy("region", "root").count()
    pivots = held.groupBy("region").agg(
        F.max(F.struct("count", (-F.col("root")).alias("least"))).alias("m"), F.count(F.lit(1)).alias("roots")
    )
    pivots = saved(pivots.where("roots > 1").select("region", (-F.col("m.least")).alias("pivot")), "pivots")
    groups = saved(placed.join(pivots, "region").select("pivot", "rep", "root").distinct(), "groups")
    diffs = saved(_differences(groups, texts, percent), "differences")
    rest = saved(_sharing(diffs, percent).join(tested, ["a", "b"], "left_anti"), "rest")
    own = diffs.where("element is null and root <> pivot").select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b"))
    roots = _joined(roots, saved(_confirmed(rest, texts, percent).union(own), "links"))

    named = _place(classes.select("digest", "rep"), roots, "rep", "component_id").select("digest", "component_id")
    out = rows.select("id", "n", "digest").join(saved(named, "named"), "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _crossing(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components so far."""
    return _place(_place(pairs, roots, "a", "ra"), roots, "b", "rb").where("ra <> rb").drop("ra", "rb")


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after further links, over the components so far."""
    if roots is None:
        return saved(components(links), "roots")
    lifted = _place(_place(links, roots, "a", "ra"), roots, "b", "rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    above = components(lifted)
    moved = _place(roots, above.toDF("node", "root"), "root", "top")
    return saved(moved.select("node", F.col("top").alias("root")).union(above), "roots")
