"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


#: A graph of at most so many links is one task's work: a bounded size. Larger ones go by rounds.
SMALL = 100_000


def in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links (u, v) of a small graph."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    for batch in batches:
        for x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x, y = find(x), find(y)
            up[max(x, y)] = min(x, y)
    nodes = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "root"])


def settled(links: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller and a larger one."""
    ends = links.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(links.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root for every node of links (a, b: long): root is the smallest node that can be
    reached; the table is scratch's. Alternates large-star and small-star rounds until every node
    has its root as its one neighbour. Both tie nodes to smaller ones, so the rounds end; their
    number grows with the logarithm of the graph's width. Each round is written to the shared
    folder, and so is each node's least neighbour, which is pre-aggregated before its shuffle: what
    is joined then are two plain tables, whose hot nodes adaptive execution can split. Neighbours
    are never collected. Null ends and loops are dropped. links is evaluated more than once, so a table is
    best."""
    links = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    # What repeats is left in a small graph: to find it would take a shuffle.
    for once in (False, True):
        links = scratch(links.distinct(), "links") if once else links
        if links.count() <= SMALL:
            return scratch(links.coalesce(1).mapInArrow(in_one_task, "node long, root long"), "roots")
    while not settled(links):
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")), "least")
        large = scratch(both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        least = scratch(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w"), "least")
        small = large.join(least, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = scratch(small.unionAll(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(), "links")
    return scratch(links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "roots")
