"""Exact nearest neighbours by inner product without cells: bounds on norms and on the rest of a product.

For vectors that fall into no clusters, where cells would only cost a k-means.  By Cauchy and Schwarz no item of norm
n scores more than |q| n with a query q, so items lie in levels of norm and a query meets only the levels that can
reach its floor, a score it is sure to reach k times.  Queries are dealt into slices of bounded size,
past each of which all items stream (``streams``), and the floors rise with the hits found.  Where both meet, the
products of the first columns of rotated vectors bound the whole: q.x <= q'.x' + |q - q'| |x - x'|.  Pairs below the
floor are dropped, block of columns after block; where that drops few, products in single precision with a bound on
their error do.  What is left is scored in full on the vectors as they are.

The rotation turns the directions in which vectors are longest to the front.  It and the floors come from a seed of
items, chosen by a hash of their ids and bounded by ``limits.seed_rows`` and ``limits.broadcast_bytes``.  They decide
how much is compared, and never what is found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kindred.config import LIMITS, Limits
from kindred.operators import blocks, bounds
from kindred.operators.bounds import BlockHits
from kindred.operators.streams import BestHits, bytes_per_query, hits_schema, past_slices

LEVELS = 16
# levels of norm are at least so many times apart
_APART = 1.02
# items of the seed that a query is compared with for its first floor
_FLOOR_ROWS = 4096


@dataclass(frozen=True)
class BoundedSearch:
    """One row a query, (query_id, hits, met, candidates), hits best first.  Store ``work`` to use it twice."""

    work: DataFrame
    k: int

    @property
    def found(self) -> DataFrame:
        """(query_id, candidate_id, score, rank)"""
        hits = self.work.select("query_id", F.posexplode("hits").alias("pos", "hit"))
        return hits.select("query_id", "hit.candidate_id", "hit.score", (F.col("pos") + 1).alias("rank"))

    @property
    def counts(self) -> DataFrame:
        """(query_id, met, candidates): items whose bounds were looked at, and those whose products were taken in full, without the seed."""
        return self.work.select("query_id", "met", "candidates")


def bounded_topk(
    queries: DataFrame, items: DataFrame, k: int, decimals: int = 6, limits: Limits = LIMITS, levels: int = LEVELS
) -> BoundedSearch:
    """The k best items per query of (query_id, vector) among (candidate_id, vector), equal scores by id.

    Vectors must not be null or hold nulls, and have one length; a table without rows gives no rows.  Repeated and zero
    vectors are items like any other.
    """
    spark = queries.sparkSession
    schema = hits_schema(queries.schema["query_id"].dataType, items.schema["candidate_id"].dataType)
    items = items.select("candidate_id", "vector")
    extent = _extent(items.select("vector", _norm().alias("norm")), levels)
    if not extent.rows:
        return BoundedSearch(spark.createDataFrame([], schema), k)
    seed = _seed(items, extent, limits)
    rotation = _rotation(seed)
    n_queries = queries.count()
    held = max(1, limits.list_bytes // bytes_per_query(extent.dim, k))
    slices = slices_for(n_queries, held, extent.rows, extent.dim, spark.sparkContext.defaultParallelism)
    # copies of a query's vector are anywhere, and so is each query
    slice_of = F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int")
    floored = _floors(queries, seed, k, decimals).select(slice_of.alias("place"), "query_id", "vector", "floor")
    shared = spark.sparkContext.broadcast((rotation, np.sort(np.asarray(extent.edges, dtype=float))))
    arrow_schema = to_arrow_schema(schema)

    def search(asked: pa.Table, parts: Iterable[tuple[int, pa.Table]]) -> Iterator[pa.RecordBatch]:
        query_ids, floors = asked["query_id"].combine_chunks(), asked["floor"].to_numpy()
        held = BestHits(query_ids, blocks.matrix(asked["vector"]), floors, k, decimals, *shared.value)
        for first, part in parts:
            held.add(part["candidate_id"].combine_chunks(), blocks.matrix(part["vector"]), first)
        yield held.batch(arrow_schema, pooled=True)

    return BoundedSearch(past_slices(floored, items, slices, "candidate_id", schema, search), k)


def slices_for(queries: int, held: int, items: int, dim: int, cores: int) -> int:
    """Slices of the queries: as few as bounds on what a task holds allow, but enough to keep all cores busy."""
    busy = min(2 * cores, ceil(float(queries) * max(1, items) * max(1, dim) / 1e9))
    wanted = max(ceil(queries / held), busy, 1)
    return min(max(1, queries), wanted if wanted <= cores else ceil(wanted / cores) * cores)


def _norm() -> Column:
    return F.sqrt(F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))


@dataclass(frozen=True)
class Extent:
    """Rows, vector length, the greatest norm, and norms that part the rows into levels, greatest first."""

    rows: int
    dim: int
    longest: float
    edges: list[float]


def _extent(normed: DataFrame, levels: int) -> Extent:
    """Levels are of like size, but norms that differ by less than ``_APART`` are not parted."""
    shares = [1 - i / levels for i in range(1, levels)] or [0.0]
    found = normed.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim"), F.max("norm").alias("longest"),
        F.percentile_approx("norm", shares, 1000).alias("edges"),
    ).first()
    edges: list[float] = []
    for edge in sorted(found["edges"] or [], reverse=True) if levels > 1 else []:
        if edge * _APART < (edges[-1] if edges else found["longest"]):
            edges.append(edge)
    return Extent(found["n"], max(1, found["dim"] or 1), found["longest"] or 0.0, edges)


def _seed(items: DataFrame, extent: Extent, limits: Limits) -> np.ndarray:
    """About as many items as the bounds allow, by a hash of their ids; all of them if they are few."""
    wanted = max(1, min(limits.seed_rows, limits.broadcast_bytes // (8 * extent.dim)))
    chosen = items
    if extent.rows > wanted:
        parts = 10**9
        chosen = items.where(F.pmod(F.xxhash64(F.col("candidate_id").cast("string")), F.lit(parts)) < int(parts * (wanted / extent.rows)))
    return blocks.matrix(chosen.select("vector").toArrow()["vector"])


def _rotation(seed: np.ndarray) -> np.ndarray:
    """An orthogonal matrix whose first columns are the directions in which the seed is longest."""
    return np.linalg.eigh(seed.T @ seed)[1][:, ::-1] if seed.size else np.zeros((0, 0))


def _floors(queries: DataFrame, seed: np.ndarray, k: int, decimals: int) -> DataFrame:
    """Queries with their norm and the k-th best of their scores with the seed: a score they are sure to reach k times."""
    # floors rise while items stream by, so a few items will do to begin with
    shared = queries.sparkSession.sparkContext.broadcast(seed[: max(_FLOOR_ROWS, 4 * k)])
    source = queries.select("query_id", "vector")
    schema = T.StructType(
        [*source.schema.fields, T.StructField("norm", T.DoubleType()), T.StructField("floor", T.DoubleType())]
    )
    arrow_schema = to_arrow_schema(schema)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = blocks.matrix(batch.column("vector"))
            floors = np.full(len(v), -np.inf)
            if len(held) >= k:
                floors = blocks.best_columns(v, held, k, decimals)[1][:, -1]
            norms = np.sqrt((v * v).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms), pa.array(floors)], schema=arrow_schema)

    return source.mapInArrow(reach, schema)


def block_topk(
    queries: np.ndarray, floors: np.ndarray, items: np.ndarray, rotation: np.ndarray, k: int, decimals: int
) -> BlockHits:
    """The k best items of a block with a score of the floor or more; ``items`` are in order of their ids."""
    return bounds.block_topk(bounds.Asked(queries, rotation), floors, items, k, decimals)
