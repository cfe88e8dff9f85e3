"""Exact k-nearest-neighbour search by inner product over whole tables.

``exact_topk`` returns the same rows by every plan.  One of three is chosen by measured
sizes:

* items fit the broadcast bound: every task scores its queries against all items
  and emits finished lists, no shuffle of scores;
* queries fit the bound: every task scores its items against all queries, keeps
  its own k best per query, and a window merges those lists;
* neither fits: ``bounded`` has both sides meet in blocks by level of norm and drops
  pairs by bounds on the rest of their products; it needs nothing learned.

A fourth plan, ``routed``, is for vectors known to fall into clusters: both sides are
keyed by the cell of a k-means and a query visits a cell only if the geometry allows
a hit there, so the result stays exact.  Where an index has cells,
``ann.widening_search`` without a reach does the same on those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kindred.config import LIMITS, Limits
from kindred.operators import blocks
from kindred.operators.bounded import bounded_topk, slices_for
from kindred.operators.bounds import BlockHits
from kindred.operators.streams import BestHits, bytes_per_query, hits_schema, past_slices, streamed_topk
from kindred.operators.topk import rank_by, top_k
from kindred.session import stored


@dataclass(frozen=True)
class Extent:
    rows: int
    dim: int

    @property
    def bytes(self) -> int:
        return self.rows * self.dim * 8


def extents(*tables: DataFrame) -> list[Extent]:
    """Rows and vector length of each (id, vector) table, in one job."""
    sizes = None
    for i, table in enumerate(tables):
        part = table.select(F.lit(i).alias("side"), F.size("vector").alias("dim"))
        sizes = part if sizes is None else sizes.unionByName(part)
    found = {
        r["side"]: Extent(r["rows"], r["dim"] or 0)
        for r in sizes.groupBy("side")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("dim").alias("dim"))
        .collect()
    }
    return [found.get(i, Extent(0, 0)) for i in range(len(tables))]


def exact_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query_id: str = "query_id",
    item_id: str = "candidate_id",
    vector: str = "vector",
    decimals: int = 6,
    limits: Limits = LIMITS,
    plan: str = "auto",
) -> DataFrame:
    """The k best items per query by inner product: (query_id, candidate_id, score, rank).

    The query itself is an item like any other; drop it with ``topk.drop_self``.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("vector"))
    i = items.select(F.col(item_id).alias("candidate_id"), F.col(vector).alias("vector"))
    q_size, i_size = extents(q, i)
    if q_size.rows and i_size.rows and q_size.dim != i_size.dim:
        raise ValueError(f"query vectors have length {q_size.dim}, item vectors {i_size.dim}")
    if plan == "auto":
        if i_size.bytes <= limits.broadcast_bytes:
            plan = "broadcast_items"
        elif max(q_size.bytes, 4 * q_size.rows * k) <= limits.broadcast_bytes:
            plan = "broadcast_queries"
        else:
            plan = "bounded"
    if plan == "broadcast_items":
        return _broadcast_items(q, i, k, decimals, q_size, i_size, limits)
    if plan == "broadcast_queries":
        return _broadcast_queries(q, i, k, decimals, q_size, i_size, limits)
    if plan == "bounded":
        return bounded_topk(q, i, k, decimals, limits).found
    if plan == "routed":
        return _routed_exact(q, i, k, decimals, i_size, limits)
    raise ValueError(f"unknown plan {plan!r}")


def _spread(df: DataFrame, rows: int, other_rows: int, dim: int, limits: Limits) -> DataFrame:
    """Repartition so that one task does a bounded amount of multiplying."""
    work = float(rows) * max(1, other_rows) * max(1, dim)
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(ceil(work / limits.work_per_task), min(cores, ceil(work / 2e7)), 1)
    return df.repartition(min(tasks, max(1, rows)))


def _hits_schema(query_type: T.DataType, item_type: T.DataType) -> T.StructType:
    hit = T.StructType([T.StructField("candidate_id", item_type), T.StructField("score", T.DoubleType())])
    return T.StructType([T.StructField("query_id", query_type), T.StructField("hits", T.ArrayType(hit))])


def _broadcast_items(q, i, k, decimals, q_size, i_size, limits) -> DataFrame:
    spark = q.sparkSession
    table = i.toArrow()  # at most limits.broadcast_bytes
    ids, vectors = blocks.sorted_block(table["candidate_id"], table["vector"])
    shared = spark.sparkContext.broadcast((ids, vectors))
    schema = _hits_schema(q.schema["query_id"].dataType, i.schema["candidate_id"].dataType)
    arrow_schema = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, item_vectors = shared.value
        for batch in batches:
            if batch.num_rows and len(item_ids):
                columns, scores = blocks.best_columns(
                    blocks.matrix(batch.column("vector")), item_vectors, k, decimals
                )
                yield blocks.hit_lists(batch.column("query_id"), item_ids, columns, scores, arrow_schema)

    hits = _spread(q, q_size.rows, i_size.rows, i_size.dim, limits).mapInArrow(search, schema)
    return hits.select("query_id", F.posexplode("hits").alias("pos", "hit")).select(
        "query_id", "hit.candidate_id", "hit.score", (F.col("pos") + 1).alias("rank")
    )


def _broadcast_queries(q, i, k, decimals, q_size, i_size, limits, seeded: bool = False) -> DataFrame:
    spark = q.sparkSession
    # at most limits.broadcast_bytes; a fixed order makes every use of it agree
    table = q.toArrow()
    ids = table["query_id"].combine_chunks()
    floors = None
    if not seeded and i_size.rows > 20 * limits.seed_rows and i_size.rows > 100 * k:
        floors = _seed_floors(q, i, ids, k, decimals, q_size, i_size, limits)
    shared = spark.sparkContext.broadcast((ids, blocks.matrix(table["vector"]), floors))
    schema = _hits_schema(q.schema["query_id"].dataType, i.schema["candidate_id"].dataType)
    arrow_schema = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_vectors, query_floors = shared.value
        best = []
        for batch in batches:
            if batch.num_rows and len(query_ids):
                item_ids, vectors = blocks.sorted_block(batch.column("candidate_id"), batch.column("vector"))
                found = blocks.best_columns(query_vectors, vectors, k, decimals)
                best = [blocks.merge_best([*best, (item_ids, *found)], k, decimals)]
        for item_ids, columns, scores in best:
            yield blocks.hit_lists(query_ids, item_ids, columns, scores, arrow_schema, query_floors)

    hits = _spread(i, i_size.rows, q_size.rows, i_size.dim, limits).mapInArrow(search, schema)
    return top_k(_exploded(hits), k)


def _seed_floors(q, i, ids, k, decimals, q_size, i_size, limits) -> np.ndarray:
    """A score each query is sure to reach k times, found on a few of the items.

    The k-th best of any subset of the items is a lower bound of the k-th best of
    all, so tasks may leave out hits below it and the merge shuffles little.
    """
    share = min(1.0, max(limits.seed_rows, 4 * k) / i_size.rows)
    seed = i.sample(share, seed=7)
    seed_size = Extent(ceil(i_size.rows * share), i_size.dim)
    ranked = _broadcast_queries(q, seed, k, decimals, q_size, seed_size, limits, seeded=True)
    reached = ranked.where(F.col("rank") == k).select("query_id", "score").toArrow()
    by_id = dict(zip(reached["query_id"].to_pylist(), reached["score"].to_pylist()))
    return np.array([by_id.get(x, -np.inf) for x in ids.to_pylist()])


def _exploded(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", F.explode("hits").alias("hit")).select(
        "query_id", "hit.candidate_id", "hit.score"
    )


# --- meeting by cell -------------------------------------------------------------------

# cells up to which their groups are numbered in order of their work
_NUMBERED = 10_000


def meet_in_cells(
    routed: DataFrame,
    celled: DataFrame,
    k: int,
    decimals: int = 6,
    limits: Limits = LIMITS,
    item: str = "vector",
    best: Callable[[np.ndarray, np.ndarray, np.ndarray, pa.Array], BlockHits] | None = None,
) -> DataFrame:
    """Score queries against the items of the cells they were routed to.

    ``routed`` is (query_id, vector, floor, cell), ``celled`` is (candidate_id,
    vector, cell).  The queries of a cell are dealt into slices that a task can hold
    with their lists, past each of which the items of the cell stream (``streams``);
    a slice gives at most k hits per query.  Result: unranked (query_id,
    candidate_id, score).

    Items may come as another column ``item`` than their vectors; ``best(cells, queries, floors, items)`` then gives the
    best of a block of items for each query.
    """
    q_rows = routed.groupBy("cell").agg(F.count(F.lit(1)).alias("q_rows"), F.max(F.size("vector")).alias("dim"))
    i_rows = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("i_rows"))
    pairs = F.col("q_rows").cast("double") * F.col("i_rows")
    sizes = stored(q_rows.join(i_rows, "cell").withColumn("pairs", pairs), "cell-sizes")
    total = sizes.agg(F.count(F.lit(1)).alias("cells"), F.sum("pairs").alias("pairs"), F.sum("i_rows").alias("items"), F.max("dim").alias("dim")).first()
    dim = max(1, total["dim"] or 1)
    held = max(1, limits.list_bytes // bytes_per_query(dim, k))
    cores = routed.sparkSession.sparkContext.defaultParallelism
    # as few slices as a task can hold; more only where a cell would keep one core busy while others wait, as each
    # takes all items of the cell
    share = max((total["pairs"] or 0.0) / cores, 1e9 / dim)
    slices = F.least(F.col("q_rows"), F.greatest(F.ceil(F.col("q_rows") / held), F.ceil(F.col("pairs") / share)))
    splits = sizes.select("cell", "pairs", slices.cast("long").alias("slices"))
    groups = int(splits.agg(F.sum("slices")).first()[0] or 0)
    # small cells share tasks
    busy = ceil((total["pairs"] or 0.0) * dim / 1e9)
    tasks = max(1, min(groups, 4096, max(cores, busy)))
    if total["cells"] <= _NUMBERED:
        heaviest = Window.orderBy(F.desc(F.col("pairs") / F.col("slices")), "cell")
        splits = splits.withColumn("start", F.sum("slices").over(heaviest.rowsBetween(Window.unboundedPreceding, 0)) - F.col("slices"))
    else:
        # the numbers hold because the sizes are a table
        splits = splits.withColumn("start", F.monotonically_increasing_id() * F.lit(1 << 20))
    splits = stored(splits.select("cell", "slices", "start"), "cell-slices")
    group = F.col("start") + F.col("slice")
    place = F.pmod(group if total["cells"] <= _NUMBERED else F.xxhash64(group), F.lit(tasks)).cast("int")

    def grouped(rows: DataFrame, *names: str) -> DataFrame:
        return rows.select(place.alias("place"), group.alias("group"), *names)

    left = routed.join(splits, "cell").withColumn("slice", F.pmod(F.xxhash64("query_id"), F.col("slices")))
    right = celled.join(splits, "cell")
    if groups > total["cells"]:
        # a large cell lies in few files: without this, those who read them would write all that is repeated
        right = right.repartition(max(cores, ceil(total["items"] / limits.rows_per_key)), "candidate_id", item)
    right = right.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    left = grouped(left, "query_id", "vector", "floor")
    if best is None:
        return _exploded(streamed_topk(left, grouped(right, "candidate_id", "vector"), tasks, k, decimals))
    return _exploded(streamed_topk(left, grouped(right, "candidate_id", "cell", item), tasks, k, decimals, item=item, best=best))


def search_cells(marked: DataFrame, celled: DataFrame, k: int, decimals: int = 6, limits: Limits = LIMITS) -> DataFrame:
    """Score queries against the items of the cells marked for them: unranked (query_id, candidate_id, score).

    ``marked`` is a stored (query_id, vector, floor, cells), ``celled`` as for ``meet_in_cells``.  Where queries are so many that this
    would repeat items more than once a core, queries are dealt into slices whatever their cells are, and items, written
    once in order of their cells, stream past each; a query then has one list of k, not one a cell.
    """
    size = marked.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("cells")).alias("probes"), F.max(F.size("vector")).alias("dim")).first()
    dim = max(1, size["dim"] or 1)
    held = max(1, limits.list_bytes // bytes_per_query(dim, k))
    cores = marked.sparkSession.sparkContext.defaultParallelism
    if ceil((size["probes"] or 0) / held) <= cores:
        return meet_in_cells(marked.select("query_id", "vector", "floor", F.explode("cells").alias("cell")), celled, k, decimals, limits)
    # no more of them than centres, which the driver holds
    probed = F.broadcast(marked.select(F.explode("cells").alias("cell")).distinct())
    items = celled.join(probed, "cell", "left_semi").orderBy("candidate_id")
    items = stored(items.select("cell", "candidate_id", "vector", F.monotonically_increasing_id().alias("ordinal")), "numbered-items")
    slices = slices_for(size["rows"], held, items.count(), dim, cores)
    place = F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int").alias("place")
    left = marked.select(place, "query_id", "vector", F.col("floor").cast("double").alias("floor"), "cells")
    schema = hits_schema(marked.schema["query_id"].dataType, celled.schema["candidate_id"].dataType)
    arrow_schema = to_arrow_schema(schema)

    def search(asked: pa.Table, parts: Iterable[tuple[int, pa.Table]]) -> Iterator[pa.RecordBatch]:
        best = BestHits(asked["query_id"].combine_chunks(), blocks.matrix(asked["vector"]), asked["floor"].to_numpy(), k, decimals, None, [])
        lists = asked["cells"].combine_chunks()
        row, cell = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
        order = np.argsort(cell, kind="stable")
        row, cell = row[order], cell[order]
        for _, part in parts:
            of = part["cell"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            for start, stop in zip(starts, np.append(starts[1:], len(of))):
                rows = row[np.searchsorted(cell, of[start]) : np.searchsorted(cell, of[start], side="right")]
                if len(rows):
                    mine = part.slice(start, stop - start)
                    best.add_for(rows, mine["candidate_id"].combine_chunks(), blocks.matrix(mine["vector"]), mine["ordinal"].to_numpy())
        yield best.batch(arrow_schema, pooled=True)

    return _exploded(past_slices(left, items, slices, ["cell", "ordinal"], schema, search))


def learn_cells(items: DataFrame, n_cells: int, seed: int = 42, rounds: int = 10) -> np.ndarray:
    """Centres of at most ``n_cells`` k-means cells of (candidate_id, vector), learned on all rows.

    It starts from the different vectors that come first in order of a hash of their ids, and each round adds up vectors
    in tasks, so the order and layout of the rows do not matter.  ``n_cells`` vectors come to the driver a round.
    """
    spark = items.sparkSession
    centers = _first_vectors(items, n_cells, seed)
    if not len(centers):
        return np.zeros((0, 0))
    dim = centers.shape[1]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centers)

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            c = shared.value
            half = (c * c).sum(axis=1) / 2
            sums, rows = np.zeros(c.shape), np.zeros(len(c), dtype=np.int64)
            for batch in batches:
                if batch.num_rows:
                    v = blocks.matrix(batch.column("vector"))
                    cell = np.argmax(v @ c.T - half, axis=1)
                    sums += blocks.sums_by(cell, v, len(c))
                    rows += np.bincount(cell, minlength=len(c))
            used = np.flatnonzero(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(rows[used]), pa.array(list(sums[used]), pa.list_(pa.float64()))],
                names=["cell", "n", "sums"],
            )

        parts = items.select("vector").mapInArrow(add, "cell int, n long, sums array<double>")
        # rounded, so that the order of the tasks does not show
        total = parts.select("cell", "n", F.posexplode("sums")).groupBy("cell", "pos").agg(
            F.sum("n").alias("n"), F.round(F.sum("col"), 9).alias("s")
        )
        found = total.toPandas()
        new = centers.copy()
        new[found["cell"], found["pos"]] = found["s"] / found["n"]
        shared.unpersist()
        if np.array_equal(new, centers):
            break
        centers = new
    return centers


def _first_vectors(items: DataFrame, n: int, seed: int) -> np.ndarray:
    """The ``n`` different vectors that come first in order of a hash of their ids; fewer if there are no more."""
    hashed = items.select("vector", F.struct(F.xxhash64(F.col("candidate_id").cast("string"), F.lit(seed)).alias("h"), "candidate_id").alias("first"))
    # the first rows hold them, unless most are copies: only then all vectors are grouped
    for rows in (hashed.orderBy("first").limit(8 * n), hashed):
        firsts = rows.groupBy("vector").agg(F.min("first").alias("first"))
        found = firsts.orderBy("first").limit(n).select("vector").collect()
        if len(found) == n:
            break
    return np.array([r["vector"] for r in found], dtype=np.float64)


def assign_cells(items: DataFrame, centers: np.ndarray) -> DataFrame:
    """Adds the nearest centre and the distance to it: (..., cell, spread)."""
    shared = items.sparkSession.sparkContext.broadcast(centers)
    schema = T.StructType(
        [*items.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("spread", T.DoubleType())]
    )
    arrow_schema = to_arrow_schema(schema)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        half = (c * c).sum(axis=1) / 2
        for batch in batches:
            if not batch.num_rows:
                continue
            v = blocks.matrix(batch.column("vector"))
            cell = np.argmax(v @ c.T - half, axis=1)
            spread = np.sqrt(((v - c[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(spread)], schema=arrow_schema
            )

    return items.mapInArrow(nearest, schema)


@dataclass(frozen=True)
class CellStats:
    """Per cell: how many items it holds, how far the farthest is from its centre, and the root of the mean square of that."""

    rows: np.ndarray
    radius: np.ndarray
    spread: np.ndarray

    @staticmethod
    def of(celled: DataFrame, n_cells: int) -> "CellStats":
        rows, radius, spread = np.zeros(n_cells), np.zeros(n_cells), np.zeros(n_cells)
        squares = F.sqrt(F.avg(F.col("spread") * F.col("spread"))).alias("s")
        stats = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("spread").alias("r"), squares)
        for r in stats.collect():  # one row per cell
            rows[r["cell"]], radius[r["cell"]], spread[r["cell"]] = r["n"], r["r"], r["s"]
        return CellStats(rows, radius, spread)

    def bounds(self, v: np.ndarray, products: np.ndarray, reach: float | None) -> np.ndarray:
        """What no item of a cell is expected to score more than, for each query and cell; -inf for empty cells.

        For an item x of a cell with centre c and radius r, q.x <= q.c + |q| r, which is sure.  Where items lie around
        their centre in all directions alike, at a root mean square distance s, q.x has the deviation |q| s / sqrt(d);
        with ``reach`` the bound is so many of them above q.c, if that is less.
        """
        norm = np.sqrt((v * v).sum(axis=1))[:, None]
        above = norm * self.radius
        if reach is not None:
            above = np.minimum(above, norm * self.spread * (reach / max(1, v.shape[1]) ** 0.5))
        return np.where(self.rows > 0, products + above, -np.inf)


def route(queries: DataFrame, centers: np.ndarray, choose) -> DataFrame:
    """Rows (query_id, vector, floor, cell) for the cells ``choose`` marks."""
    return mark_cells(queries, centers, choose).select("query_id", "vector", "floor", F.explode("cells").alias("cell"))


def mark_cells(queries: DataFrame, centers: np.ndarray, choose) -> DataFrame:
    """Rows (query_id, vector, floor, cells) with the cells ``choose`` marks.

    ``choose(vectors, floors, inner_products, centers)`` gives a boolean matrix of
    queries by cells.
    """
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast(centers)
    source = queries.select("query_id", "vector", "floor")
    schema = T.StructType([*source.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    arrow_schema = to_arrow_schema(schema)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = blocks.matrix(batch.column("vector"))
            chosen = choose(v, batch.column("floor").to_numpy(), v @ c.T, c)
            offsets = np.concatenate([[0], np.cumsum(chosen.sum(axis=1))]).astype(np.int32)
            cells = pa.array(np.nonzero(chosen)[1].astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets), cells, type=arrow_schema.field("cells").type)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], schema=arrow_schema)

    return source.mapInArrow(mark, schema)


def nearest_cells(centers_wanted: int, rows: np.ndarray):
    """Mark the nearest non-empty centres of each query."""

    def choose(v, floors, products, c):
        closeness = np.where(rows > 0, products - (c * c).sum(axis=1) / 2, -np.inf)
        order = np.argsort(-closeness, axis=1)[:, :centers_wanted]
        chosen = np.zeros(closeness.shape, dtype=bool)
        np.put_along_axis(chosen, order, True, axis=1)
        return chosen & (rows > 0)

    return choose


def enough_cells(k: int, rows: np.ndarray):
    """Mark the nearest centres whose cells hold k items together."""

    def choose(v, floors, products, c):
        closeness = np.where(rows > 0, products - (c * c).sum(axis=1) / 2, -np.inf)
        order = np.argsort(-closeness, axis=1)
        before = np.cumsum(rows[order], axis=1) - rows[order]
        chosen = np.zeros(closeness.shape, dtype=bool)
        np.put_along_axis(chosen, order, before < k, axis=1)
        return chosen & (rows > 0)

    return choose


def promising_cells(k: int, stats: CellStats, slack: float):
    """Mark the cells, beyond those of ``enough_cells``, that may hold a hit above the floor."""
    first = enough_cells(k, stats.rows)

    def choose(v, floors, products, c):
        may = stats.bounds(v, products, None) >= floors[:, None] - slack
        return may & ~first(v, floors, products, c) & (stats.rows > 0)

    return choose


def next_cells(first: int, last: int, stats: CellStats, reach: float | None, slack: float):
    """Mark the cells from ``first`` to ``last`` in order of their bounds, as far as those reach the query's floor."""

    def choose(v, floors, products, c):
        bounds = stats.bounds(v, products, reach)
        order = np.argsort(-bounds, axis=1, kind="stable")[:, first:last]
        chosen = np.zeros(bounds.shape, dtype=bool)
        np.put_along_axis(chosen, order, True, axis=1)
        return chosen & (bounds >= floors[:, None] - slack) & (stats.rows > 0)

    return choose


def _routed_exact(q, i, k, decimals, i_size, limits) -> DataFrame:
    # copies of a vector share every score, so only the k first ids of each can be hits
    copies = rank_by(i, ["vector"], [F.asc("candidate_id")], k, "copy")
    copies = copies.withColumn("first_id", F.min("candidate_id").over(Window.partitionBy("vector")))
    copies = stored(copies, "copies")
    items = copies.where("copy = 1").select("candidate_id", "vector")
    asked = q.groupBy("vector").agg(F.min("query_id").alias("first_query"))
    queries = asked.select(F.col("first_query").alias("query_id"), "vector", F.lit(float("-inf")).alias("floor"))
    queries = stored(queries, "queries")

    n_cells = int(min(4096, max(2, ceil(i_size.rows**0.5))))
    centers = learn_cells(items, n_cells)
    celled = stored(assign_cells(items, centers), "cells")
    stats = CellStats.of(celled, len(centers))
    celled = celled.drop("spread")

    first = meet_in_cells(route(queries, centers, enough_cells(k, stats.rows)), celled, k, decimals, limits)
    first = stored(top_k(first, k), "first")
    reached = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("reached"))
    floored = queries.join(reached, "query_id", "left").select(
        "query_id", "vector", F.coalesce("reached", "floor").alias("floor")
    )
    rest = route(floored, centers, promising_cells(k, stats, 10.0**-decimals))
    second = meet_in_cells(rest, celled, k, decimals, limits)
    found = top_k(first.drop("rank").unionByName(second), k)

    originals = copies.select(F.col("first_id").alias("candidate_id"), F.col("candidate_id").alias("copy_id"))
    spread = found.join(originals, "candidate_id").select(
        "query_id", F.col("copy_id").alias("candidate_id"), "score"
    )
    per_vector = top_k(spread, k).withColumnRenamed("query_id", "first_query")
    return (
        q.join(asked, "vector")
        .select("query_id", "first_query")
        .join(per_vector.hint("merge"), "first_query")
        .select("query_id", "candidate_id", "score", "rank")
    )
