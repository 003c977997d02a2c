"""Connected components of links, by alternating large and small stars, ended in one bounded task."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.llm.store import saved
from fitloom.llm.words import tidy

LOCAL_LINKS = 500_000


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


@tidy
def _merged(batches):
    """(node, root) of all links of a task."""
    parent: dict[int, int] = {}

    def find(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(*[c.to_pylist() for c in batch.columns]):
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    rows = [(x, r) for x in list(parent) if (r := find(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["node", "root"])


def components(links: DataFrame, local_links: int = LOCAL_LINKS) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): the root is the smallest node it reaches.

    A root has no row of its own. Each step replaces links by links to smaller nodes of the same
    component, so no node's links are ever gathered. At most ``local_links`` links are merged by one
    task without further shuffles; more are not, and go through the same steps until they are stars.
    """
    edges = saved(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    state = _state(edges)
    while state[0] > local_links:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = saved(
            both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large"
        )
        least = saved(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        turned = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(turned.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return edges.coalesce(1).mapInArrow(_merged, "node bigint, root bigint")
