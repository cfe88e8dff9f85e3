"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kindred.llm.common import drop, store

# links that one task contracts: bounds its memory
LINKS_PER_TASK = 250_000


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each node to the smallest node it reaches over the links of this partition."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (above := parent.setdefault(top, top)) != top:
            top = above
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    found = [(x, r) for x in list(parent) if (r := root(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], names=["a", "b"])


def _stars(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours, then its smaller ones, linked to the smallest node known there."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    large = large.union(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return small.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, links_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) reaches.

    Tasks of at most about ``links_per_task`` links contract what they hold to stars.  While there are several tasks,
    each round then links all neighbours of a node to the smallest of them, until nothing changes; long chains need a
    number of rounds that grows with the logarithm of their length.  Rounds are tables in the shared folder.
    Links of a node to itself and null ends are ignored; no links, no rows.
    """
    spark = links.sparkSession
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, path = store(ends, "links")
    mark, n = None, edges.count()
    while True:
        tasks = -(-n // links_per_task)
        contracted = edges.repartition(tasks).mapInArrow(_contract, "a long, b long") if tasks > 1 else edges.coalesce(1).mapInArrow(_contract, "a long, b long")
        edges, later = store(contracted if tasks <= 1 else _stars(contracted), "links")
        drop(spark, path)
        path = later
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tasks <= 1 or row == mark:
            break
        mark, n = row, row[0]
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())
