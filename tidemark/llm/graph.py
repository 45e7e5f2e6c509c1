"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one task's links: every node with the smallest node it reaches here."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "root"]
    )


def _flat(parents: DataFrame) -> DataFrame:
    """``(node, parent)`` with every parent replaced by the root above it, by path halving."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = parents.join(above, "parent", "left").select(
            "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
        )
        step = stored(step, "paths")
        parents = step.select("node", "parent")
        if step.filter("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``links (a, b)`` that is not the smallest of its component.

    Each task joins the links it holds by union-find; a node with several local roots goes to the
    smallest, and what is left are links between roots, fewer each time. No task or driver holds more
    than its share of the links.
    """
    forest = None
    while True:
        stars = stored(links.mapInArrow(_local_roots, "node bigint, root bigint"), "stars")
        if stars.isEmpty():
            break
        parents = _flat(stars.groupBy("node").agg(F.min("root").alias("parent")))
        up = parents.withColumnRenamed("node", "root").withColumnRenamed("parent", "above")
        ends = stars.join(parents, "node").join(up, "root", "left")
        links = ends.select(F.col("parent").alias("a"), F.coalesce("above", "root").alias("b")).filter("a != b").distinct()
        forest = parents if forest is None else forest.union(parents)
    if forest is None:
        return stars
    return _flat(forest).withColumnRenamed("parent", "root")
