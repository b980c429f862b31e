"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.sources.paths import saved


def _content(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


#: Up to so many edges, 16 bytes each, are the work of one task: rounds over a table cost more than they spread.
FEW = 50_000


def _in_one_task(batches):
    parent: dict[int, int] = {}

    def find(node: int) -> int:
        while parent.setdefault(node, node) != node:
            parent[node] = node = parent[parent[node]]
        return node

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            p, q = sorted((find(u), find(v)))
            parent[q] = p
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (nodes, [find(n) for n in nodes])], names=["node", "component"])


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it reaches.

    Alternates between linking larger and smaller neighbours of a node to its
    smallest neighbour. Every step is a grouped minimum and one join; each is
    written before the next reads it. Ends when the edges form stars.
    """
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    star = saved(ordered, "edges")
    before = _content(star)
    if before[0] <= few:
        return star.coalesce(1).mapInArrow(_in_one_task, "node long, component long")
    while before[0]:
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "u").where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        star = saved(small, "edges")
        now = _content(star)
        if now == before:
            break
        before = now
    linked = star.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return linked.union(star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
