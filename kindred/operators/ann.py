"""Approximate nearest neighbours (J2): both methods meet in cells and rescore exactly."""

from __future__ import annotations

import bisect
import functools
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kindred.config import FIRST_CELLS, LIMITS, REACH, Limits
from kindred.operators.dense import CellStats, assign_cells, exact_topk, learn_cells, mark_cells, meet_in_cells, nearest_cells, next_cells, route, search_cells
from kindred.operators.topk import top_k
from kindred.session import path_exists, stored

NO_FLOOR = float("-inf")
EMPTY = "candidate_id string, vector array<float>, spread double, cell int"


@dataclass(frozen=True)
class CellIndex:
    """Items partitioned by the k-means cell they fall in.

    A few queries read only the partitions of the cells they probe.
    """

    items: DataFrame
    centers: np.ndarray
    # how far a widening search must look for the recall that the index was calibrated for
    reach: float = REACH

    @staticmethod
    def build(
        items: DataFrame,
        path: str,
        n_cells: int,
        item_id: str = "candidate_id",
        vector: str = "vector",
        seed: int = 42,
        target: float | None = None,
    ) -> "CellIndex":
        """``target`` is the recall to calibrate for; without it the default reach stays."""
        source = items.select(F.col(item_id).alias("candidate_id"), F.col(vector).alias("vector"))
        index = CellIndex.around(source, path, learn_cells(source, n_cells, seed))
        if target is None or not index.n_cells:
            return index
        return index.reaching(path, calibrated_reach(index, target=target, seed=seed))

    def reaching(self, path: str, reach: float) -> "CellIndex":
        """The same index with a calibrated reach, written beside its tables at ``path``."""
        spark = self.items.sparkSession
        spark.createDataFrame([(reach,)], "reach double").coalesce(1).write.mode("overwrite").parquet(f"{path}/reach")
        return CellIndex.read(spark, path)

    @staticmethod
    def around(source: DataFrame, path: str, centers: np.ndarray) -> "CellIndex":
        """Items (candidate_id, vector) in the cells of given centres."""
        spark = source.sparkSession
        # rebalancing keeps a cell's rows in few files and splits a cell too large for one task
        assign_cells(source, centers).hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/items")
        spark.createDataFrame(
            [(i, [float(x) for x in c]) for i, c in enumerate(centers)], "cell int, center array<double>"
        ).write.mode("overwrite").parquet(f"{path}/centers")
        return CellIndex.read(spark, path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> "CellIndex":
        centers = spark.read.parquet(f"{path}/centers").orderBy("cell").collect()
        # without items there is no partition to infer anything from
        items = spark.read.parquet(f"{path}/items") if centers else spark.createDataFrame([], EMPTY)
        reach = spark.read.parquet(f"{path}/reach").first()[0] if path_exists(spark, f"{path}/reach") else REACH
        return CellIndex(items, np.array([r["center"] for r in centers]), reach)

    @property
    def n_cells(self) -> int:
        return len(self.centers)

    @functools.cached_property
    def stats(self) -> CellStats:
        return CellStats.of(self.items, self.n_cells)


def ivf_routes(queries: DataFrame, index: CellIndex, nprobe: int) -> DataFrame:
    """(query_id, vector, floor, cell) for the ``nprobe`` nearest non-empty cells of each query."""
    asked = queries.select("query_id", "vector", F.lit(NO_FLOOR).alias("floor"))
    return route(asked, index.centers, nearest_cells(nprobe, index.stats.rows))


def ivf_topk(
    queries: DataFrame, index: CellIndex, k: int, nprobe: int, decimals: int = 6, limits: Limits = LIMITS
) -> DataFrame:
    """Best k among the items of the ``nprobe`` nearest cells; exact when all cells are probed."""
    celled = index.items.select("candidate_id", "vector", "cell")
    asked = queries.select("query_id", "vector", F.lit(NO_FLOOR).alias("floor"))
    marked = stored(mark_cells(asked, index.centers, nearest_cells(nprobe, index.stats.rows)), "probes")
    return top_k(search_cells(marked, celled, k, decimals, limits), k)


@dataclass(frozen=True)
class Probed:
    """What a widening search found, and the (query_id, cell) pairs it visited."""

    found: DataFrame
    visits: DataFrame


def widening_search(
    queries: DataFrame, index: CellIndex, k: int, nprobe: int, reach: float | None = REACH, decimals: int = 6, limits: Limits = LIMITS
) -> Probed:
    """Best k of each query by visits to cells in order of their bounds, until no further cell is expected to hold a hit.

    The first round visits ``nprobe`` cells, each later one as many as all before.  A query stays open while its list is
    shorter than k or the bound of its next cell (``CellStats.bounds``) reaches its k-th score, so lists are as long as
    those of an exact search however uneven the cells are; with ``reach`` None they are the same.  A round is one
    equi-join of the open queries with the cells they visit next, and a table in the shared folder.

    A first round of many cells is met in two steps: what the first cell holds says which hits of the others can be left out.
    """
    celled = index.items.select("candidate_id", "vector", "cell")
    if not index.n_cells:
        nothing = queries.select("query_id", F.lit(0).alias("cell")).limit(0)
        return Probed(exact_topk(queries, celled, k, decimals=decimals, limits=limits), nothing)
    asked = stored(queries.select("query_id", "vector", F.lit(NO_FLOOR).alias("floor")), "asked")
    everyone, found, visits = asked.drop("floor"), None, None
    first, last = 0, max(1, nprobe)
    rest = last if last > FIRST_CELLS else None
    if rest:
        last = 1
    while True:
        cells = next_cells(first, last, index.stats, reach, 10.0**-decimals)
        if rest and first:
            cells, rest = _whatever_floors(cells), None
        marked = stored(mark_cells(asked, index.centers, cells).where(F.size("cells") > 0), "probes")
        mine = marked.select("query_id", F.explode("cells").alias("cell"))
        visits = mine if visits is None else visits.unionByName(mine)
        if found is not None and marked.isEmpty():
            break
        hits = search_cells(marked, celled, k, decimals, limits)
        found = stored(top_k(hits if found is None else found.drop("rank").unionByName(hits), k), "found")
        if last >= index.n_cells:
            break
        first, last = last, rest or 2 * last
        reached = found.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
        asked = everyone.join(reached, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(NO_FLOOR)))
    return Probed(found, visits)


def _whatever_floors(choose):
    """Cells chosen as if no floor were known."""
    return lambda v, floors, products, c: choose(v, np.full(len(v), NO_FLOOR), products, c)


def calibrated_reach(
    index: CellIndex, k: int = 10, target: float = 0.95, n_queries: int = 256, nprobe: int = FIRST_CELLS, seed: int = 42
) -> float:
    """The least reach with which a widening search from ``nprobe`` cells is expected to find a share ``target`` of the k best.

    ``n_queries`` items, those first by a hash, are searched exactly.  A hit is found if its cell is among the first
    ``nprobe`` or has a bound that reaches the query's k-th score.  The share found must be the target and the error of a
    share over so many queries (one-sided, 95 %).  At most ``n_queries`` times k rows come to the driver.
    """
    items = index.items.select("candidate_id", "vector", "cell")
    order = F.xxhash64(F.col("candidate_id").cast("string"), F.lit(seed))
    sample = stored(items.orderBy(order, "candidate_id").limit(n_queries).select(F.col("candidate_id").alias("query_id"), "vector"), "sample")
    hits = exact_topk(sample, items, k).join(items.select("candidate_id", "cell"), "candidate_id").select("query_id", "cell", "score").toPandas()
    if not len(hits):
        return REACH
    asked = sample.toPandas()
    v = np.stack(asked["vector"]).astype(np.float64)
    place = hits["query_id"].map({q: i for i, q in enumerate(asked["query_id"])}).to_numpy()
    cell, floor = hits["cell"].to_numpy(), hits.groupby("query_id")["score"].transform("min").to_numpy()
    products, stats = v @ index.centers.T, index.stats

    def found(reach: float) -> float:
        bounds = stats.bounds(v, products, reach)
        first = np.argsort(np.argsort(-bounds, axis=1, kind="stable"), axis=1) < nprobe
        return float((first[place, cell] | (bounds[place, cell] >= floor - 1e-6)).mean())

    share = min(1.0, target + 1.645 * (target * (1 - target) / len(asked)) ** 0.5)
    unit = np.sqrt((v * v).sum(axis=1))[place] * stats.spread[cell] / v.shape[1] ** 0.5
    needed = np.where(unit > 0, np.maximum(floor - products[place, cell], 0) / np.where(unit > 0, unit, 1), 0.0)
    choices = np.unique(np.append(needed, 0.0))
    at = bisect.bisect_left(choices, share, key=found)
    return float(choices[min(at, len(choices) - 1)]) * (1 + 1e-6)


def lsh_cells(
    table: DataFrame, dim: int, bucket_length: float, n_tables: int, seed: int = 42
) -> DataFrame:
    """Adds one row per hash table with its bucket as the cell."""
    # the projections depend on the seed and the length alone, so fitting needs no data
    lsh = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=n_tables, seed=seed
    )
    schema = T.StructType([T.StructField("features", VectorUDT())])
    model = lsh.fit(table.sparkSession.createDataFrame([(Vectors.dense([0.0] * dim),)], schema))
    hashed = model.transform(table.withColumn("features", array_to_vector("vector")))
    return hashed.select(
        *table.columns, F.posexplode("hashes").alias("_table", "_bucket")
    ).select(*table.columns, F.xxhash64("_table", F.col("_bucket").cast("string")).alias("cell"))


def lsh_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    dim: int,
    bucket_length: float,
    n_tables: int,
    decimals: int = 6,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Best k among the items that share a bucket with the query in any table."""
    asked = queries.select("query_id", "vector", F.lit(NO_FLOOR).alias("floor"))
    routed = lsh_cells(asked, dim, bucket_length, n_tables)
    celled = lsh_cells(items.select("candidate_id", "vector"), dim, bucket_length, n_tables)
    scored = meet_in_cells(routed, celled, k, decimals, limits)
    return top_k(scored.dropDuplicates(["query_id", "candidate_id"]), k)


def candidate_counts(routed: DataFrame, celled: DataFrame) -> DataFrame:
    """How many items each query is compared with: (query_id, candidates)."""
    sizes = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return routed.join(sizes, "cell").groupBy("query_id").agg(F.sum("n").alias("candidates"))
