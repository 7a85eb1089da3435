"""Distributed union-find: local forests, merged level by level."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.plans.durable import durable

#: Edges that one task may merge into a single forest; beyond it the merging goes on in parallel rounds.
TASK_EDGES = 500_000


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The union-find forest of this task's edges, as (node, root) with the least node as root."""
    up: dict = {}

    def root(x):
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    if schema is None:
        return
    nodes = list(up)
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, schema.field(0).type), pa.array([root(x) for x in part], schema.field(0).type)], ["a", "b"])


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (two columns of one type): root is the least node it is connected to.

    Null ends and loops are ignored; a node named only in a loop is not returned. Each task first reduces its edges
    to a local forest, so a hub with a third of all edges shrinks before any shuffle. Forests are merged eight to
    one while all of them fit one task of ``task_edges``; larger graphs go through rounds of large-star and
    small-star steps (per-node minima with map-side combining), each written to the shared checkpoint folder.
    """
    a, b = edges.columns[:2]
    kind = edges.schema[a].dataType.simpleString()
    schema = f"a {kind}, b {kind}"
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    links = durable(links.mapInArrow(_local, schema))
    n = links.count()
    parts = links.rdd.getNumPartitions() if n else 1
    while n and n <= task_edges and parts > 1:
        parts = max(1, parts // 8)
        links = links.repartition(parts, "b").mapInArrow(_local, schema)
    if n > task_edges:
        links = _stars(links, schema)
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())


def _stars(links: DataFrame, schema: str) -> DataFrame:
    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    state = None
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = both.join(least(both), "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = durable(large.filter("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        near = least(down)
        small = down.join(near, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(near.select(F.col("u").alias("a"), F.col("m").alias("b")))
        links = durable(small.filter("a <> b").distinct())
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        if now == state:
            return links
        state = now
