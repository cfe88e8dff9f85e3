"""Approximate nearest neighbours on a proximity graph (J2): rounds of joins build it, rounds of joins search it.

The graph is found by descent: neighbours of neighbours are likely neighbours.  All degrees are bounded, also those of
popular vectors, so no group grows with the data.  A search goes from the best known items of a query to their neighbours
until the best ones have no neighbour that was not yet seen; all queries go on together, a round at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kindred.config import BEAM, DEGREE, LIMITS, Limits
from kindred.operators import blocks
from kindred.operators.dense import exact_topk, extents
from kindred.operators.topk import rank_by, top_k
from kindred.session import stored

# most vectors that a search may start from; they are broadcast
MAX_ENTRIES = 4096
# vectors compared with one another in a task at the start; neighbourhoods of one task
BLOCK = 512
NEIGHBOURHOODS = 256
# first guesses from different random planes
GUESSES = 3
# decimals of scores inside the graph
DECIMALS = 9
# products of neighbourhoods that a task takes together
_PAIRS_AT_ONCE = 500_000
# pairs of queries and nodes that a task scores as one group, and those whose vectors it puts side by side
PAIRS_OF_GROUP = 500_000
_ROWS_AT_ONCE = 8192


@dataclass(frozen=True)
class GraphIndex:
    """Different vectors (``nodes``), ``edges`` (candidate_id, neighbour), ``entries`` where searches start.

    ``copies`` (candidate_id, copy_id, copy) numbers the ids that share a vector, the first of which is the node.
    """

    nodes: DataFrame
    edges: DataFrame
    entries: DataFrame
    copies: DataFrame

    @staticmethod
    def build(
        items: DataFrame, path: str, degree: int = DEGREE, item_id: str = "candidate_id", vector: str = "vector", seed: int = 42, rounds: int = 10
    ) -> "GraphIndex":
        source = items.select(F.col(item_id).alias("candidate_id"), F.col(vector).alias("vector"))
        spark = source.sparkSession
        # rows are sorted by a number; vectors are compared only where it is the same
        same = Window.partitionBy("hash", "vector")
        hashed = source.withColumn("hash", F.xxhash64("vector"))
        numbered = hashed.withColumn("copy", F.row_number().over(same.orderBy("candidate_id"))).withColumn("first", F.min("candidate_id").over(same))
        numbered = stored(numbered.drop("hash"), "numbered")
        numbered.select(F.col("first").alias("candidate_id"), F.col("candidate_id").alias("copy_id"), "copy").write.mode("overwrite").parquet(f"{path}/copies")
        numbered.where("copy = 1").select("candidate_id", "vector").write.mode("overwrite").parquet(f"{path}/nodes")
        nodes = spark.read.parquet(f"{path}/nodes")
        near = descend(nodes, degree, seed, rounds)
        # both directions of an edge, the best of them
        both = near.select("candidate_id", "neighbour", "score").union(near.select("neighbour", "candidate_id", "score")).distinct()
        best = rank_by(both, ["candidate_id"], [F.desc("score"), F.asc("neighbour")], 2 * degree)
        best.select("candidate_id", "neighbour").write.mode("overwrite").parquet(f"{path}/edges")
        n = nodes.count()
        wanted = min(MAX_ENTRIES, max(4 * BEAM, ceil(4 * n**0.5)))
        first = nodes.orderBy(_hash("candidate_id", seed), "candidate_id").limit(wanted)
        first.write.mode("overwrite").parquet(f"{path}/entries")
        return GraphIndex.read(spark, path)

    @staticmethod
    def around(nodes: DataFrame, edges: DataFrame, entries: DataFrame) -> "GraphIndex":
        """A given graph on vectors that all differ."""
        copies = nodes.select("candidate_id", F.col("candidate_id").alias("copy_id"), F.lit(1).alias("copy"))
        return GraphIndex(nodes, edges, entries, copies)

    @staticmethod
    def read(spark: SparkSession, path: str) -> "GraphIndex":
        return GraphIndex(*(spark.read.parquet(f"{path}/{name}") for name in ("nodes", "edges", "entries", "copies")))


def _hash(column: str, seed: int) -> Column:
    return F.xxhash64(F.col(column).cast("string"), F.lit(seed))


# --- learning the graph ----------------------------------------------------------------


def lifted(nodes: DataFrame) -> DataFrame:
    """Vectors with one more component that makes all equally long: products then order as distances do."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    longest = nodes.agg(F.max(square)).first()[0] or 0.0
    rest = F.sqrt(F.greatest(F.lit(longest) - square, F.lit(0.0)))
    return nodes.select("candidate_id", F.concat(F.col("vector").cast("array<float>"), F.array(rest.cast("float"))).alias("vector"))


def _pairs_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("candidate_id", kind), T.StructField("neighbour", kind), T.StructField("score", T.DoubleType())])


def _planes(nodes: DataFrame, bits: int, seed: int, sample: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Random directions and the middles of the projections on them, measured on ``sample`` vectors."""
    rows = nodes.orderBy(_hash("candidate_id", seed), "candidate_id").limit(sample).select("vector").toArrow()
    points = blocks.matrix(rows["vector"])
    planes = np.random.default_rng(seed).standard_normal((points.shape[1], bits))
    return planes, np.median(points @ planes, axis=0)


def guess(nodes: DataFrame, degree: int, seed: int, rows: int, block: int = BLOCK) -> DataFrame:
    """(candidate_id, neighbour, score): the best of each vector among those on the same sides of some random planes.

    Sides with many vectors are cut by a hash, so a task compares about ``block`` vectors with one another.
    """
    bits = max(0, int(np.ceil(np.log2(max(1, rows) / block))))
    planes, middles = _planes(nodes, bits, seed)
    side_schema = T.StructType([*nodes.schema.fields, T.StructField("side", T.LongType())])
    arrow_sides = to_arrow_schema(side_schema)

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                above = blocks.matrix(batch.column("vector")) @ planes > middles
                side = above @ (1 << np.arange(bits, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(side.astype(np.int64))], schema=arrow_sides)

    placed = stored(nodes.mapInArrow(sides, side_schema), "sides")
    # at most 2^bits rows, some rows / block of them
    parts = placed.groupBy("side").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("parts"))
    placed = placed.join(parts, "side").withColumn("part", F.pmod(_hash("candidate_id", seed), F.col("parts")))
    schema = _pairs_schema(nodes.schema["candidate_id"].dataType)
    arrow_schema = to_arrow_schema(schema)

    def compare(table: pa.Table) -> pa.Table:
        ids, vectors = blocks.sorted_block(table["candidate_id"], table["vector"])
        return _best_pairs(ids, vectors, degree, np.full(len(ids), -np.inf), arrow_schema)

    return placed.select("side", "part", "candidate_id", "vector").groupBy("side", "part").applyInArrow(compare, schema)


def _best_pairs(ids: pa.Array, vectors: np.ndarray, degree: int, floors: np.ndarray, schema: pa.Schema) -> pa.Table:
    """For each vector of a bounded group its best others above its floor."""
    columns, scores = blocks.best_columns(vectors, vectors, min(len(ids), degree + 1), DECIMALS)
    keep = (columns != np.arange(len(ids))[:, None]) & (scores > floors[:, None])
    row, place = np.nonzero(keep)
    return pa.Table.from_arrays([ids.take(pa.array(row)), ids.take(pa.array(columns[row, place])), pa.array(scores[row, place])], schema=schema)


def _kept(pairs: DataFrame, degree: int) -> DataFrame:
    """The best ``degree`` of each vector, with the round in which each was first found."""
    # one shuffle does for both steps
    once = pairs.repartition("candidate_id").groupBy("candidate_id", "neighbour").agg(F.max("score").alias("score"), F.min("born").alias("born"))
    return rank_by(once, ["candidate_id"], [F.desc("score"), F.asc("neighbour")], degree)


def descend(nodes: DataFrame, degree: int = DEGREE, seed: int = 42, rounds: int = 10, settled: float = 0.002) -> DataFrame:
    """(candidate_id, neighbour, score, born, rank): about the ``degree`` nearest others of each vector.

    A round compares the members of each neighbourhood with one another; it is the last one if less than a share
    ``settled`` of the edges changed.  At most twice ``degree`` edges into a vector, chosen anew by a hash each round, take
    part, so neighbourhoods and the uses of a vector are bounded.
    """
    nodes = stored(lifted(nodes), "lifted")
    rows = nodes.count()
    guesses = None
    for i in range(GUESSES):
        found = guess(nodes, degree, seed + i, rows) if rows else nodes.select("candidate_id", F.col("candidate_id").alias("neighbour"), F.lit(0.0).alias("score"))
        guesses = found if guesses is None else guesses.unionByName(found)
        if rows <= BLOCK:
            break
    graph = stored(_kept(guesses.withColumn("born", F.lit(0)), degree), "graph")
    if rows <= BLOCK:
        return graph
    for born in range(1, rounds + 1):
        used = rank_by(graph, ["neighbour"], [F.xxhash64(F.col("candidate_id").cast("string"), F.lit(born)), F.asc("candidate_id")], 2 * degree, "turn")
        used = stored(used.select("candidate_id", "neighbour", "born"), "used")
        both = used.select(F.col("candidate_id").alias("of"), F.col("neighbour").alias("candidate_id"), "born").union(
            used.select(F.col("neighbour").alias("of"), "candidate_id", "born")
        )
        # at most three times the degree in a set; a vector without edges has nothing to be compared with
        hoods = both.where("of is not null").groupBy("of").agg(F.max("born").alias("last"), F.collect_set("candidate_id").alias("members"))
        # a neighbourhood whose edges of this turn are all older holds few pairs that were not compared before
        hoods = hoods.where(F.col("last") == born - 1)
        members = hoods.select("of", F.explode(F.array_union("members", F.array("of"))).alias("candidate_id"))
        floors = graph.where(F.col("rank") == degree).select("candidate_id", F.col("score").alias("floor"))
        vectors = nodes.join(floors, "candidate_id", "left")
        found = compare_members(members.join(vectors, "candidate_id"), degree, rows).withColumn("born", F.lit(born))
        graph = stored(_kept(graph.drop("rank").unionByName(found), degree), "graph")
        if graph.where(F.col("born") == born).count() <= settled * rows * degree:
            break
    return graph


def compare_members(members: DataFrame, degree: int, rows: int) -> DataFrame:
    """Pairs of members (of, candidate_id, vector, floor) of one neighbourhood that beat the floor of the first."""
    schema = _pairs_schema(members.schema["candidate_id"].dataType)
    arrow_schema = to_arrow_schema(schema)

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("of", "ascending"), ("candidate_id", "ascending")])
        starts = np.flatnonzero(np.concatenate([[True], _changes(table["of"])]))
        floors = np.nan_to_num(table["floor"].to_numpy(), nan=-np.inf)
        row, other, scores = hood_pairs(blocks.matrix(table["vector"]), starts, floors, degree)
        ids = table["candidate_id"].combine_chunks()
        return pa.Table.from_arrays([ids.take(pa.array(row)), ids.take(pa.array(other)), pa.array(scores)], schema=arrow_schema)

    task = F.pmod(F.xxhash64(F.col("of").cast("string")), F.lit(ceil(rows / NEIGHBOURHOODS))).alias("task")
    return members.select(task, "of", "candidate_id", "vector", "floor").groupBy("task").applyInArrow(compare, schema)


def hood_pairs(vectors: np.ndarray, starts: np.ndarray, floors: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other row, score) of rows of one neighbourhood whose score beats the floor of the first, its best ``degree`` at least.

    A neighbourhood goes from one of ``starts`` to the next.  Those of like size are multiplied together.
    """
    unit = 10.0**DECIMALS
    lengths = np.diff(np.append(starts, len(vectors)))
    order = np.argsort(lengths, kind="stable")
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    at = 0
    while at < len(order):
        # as many as hold a bounded number of pairs, filled up to the size of the last
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * lengths[order[stop]] ** 2 <= _PAIRS_AT_ONCE:
            stop += 1
        mine, size = order[at:stop], lengths[order[stop - 1]]
        at = stop
        if size < 2:
            continue
        held = np.arange(size) < lengths[mine][:, None]
        rows = np.where(held, starts[mine][:, None] + np.arange(size), 0)
        v = vectors[rows]
        scores = np.floor(v @ v.transpose(0, 2, 1) * unit + 0.5) / unit
        keep = (scores > floors[rows][:, :, None]) & held[:, :, None] & held[:, None, :] & ~np.eye(size, dtype=bool)
        many = np.nonzero(keep.sum(axis=2) > degree)
        if len(many[0]):
            # the others have so many before them in this neighbourhood alone
            least = np.partition(np.where(keep[many], scores[many], -np.inf), size - degree, axis=1)[:, size - degree]
            keep[many] &= scores[many] >= least[:, None]
        hood, i, j = np.nonzero(keep)
        out.append((rows[hood, i], rows[hood, j], scores[hood, i, j]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return np.asarray(pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False), dtype=bool)


# --- searching it ----------------------------------------------------------------------


@dataclass(frozen=True)
class Walked:
    """What a search found, and how many vectors each different query was compared with: (query_id, candidates)."""

    found: DataFrame
    counts: DataFrame


def graph_topk(
    queries: DataFrame, index: GraphIndex, k: int, beam: int = BEAM, decimals: int = 6, hops: int | None = None, limits: Limits = LIMITS
) -> Walked:
    """Best k of each query among what is met on the way from the entries: (query_id, candidate_id, score, rank).

    A round goes to the neighbours of the best ``beam`` items (at least k) that were not gone from before, and the last one
    is that in which there are none, or round ``hops``.  Equal query vectors are searched once.  Without ``hops`` lists are
    as long as those of an exact search: more than the entries may ask for what no edge leads to, and is searched exactly.
    """
    beam = max(beam, k)
    asked = stored(queries.groupBy("vector").agg(F.min("query_id").alias("query_id")), "asked")
    order = [F.desc("score"), F.asc("candidate_id")]
    starts = exact_topk(asked, index.entries, beam, decimals=decimals, limits=limits)
    # only the best are ranked anew: what is behind them stays there.  All that was met is written once
    state = stored(starts.withColumn("done", F.lit(False)), "walk")
    seen = state.select("query_id", "candidate_id")
    n = 0
    while hops is None or n < hops:
        n += 1
        open_ = state.where((F.col("rank") <= beam) & ~F.col("done")).select("query_id", "candidate_id")
        if open_.isEmpty():
            break
        nexts = spread_join(open_, index.edges, "candidate_id", "query_id", limits).select("query_id", F.col("neighbour").alias("candidate_id")).distinct()
        fresh = stored(nexts.join(seen, ["query_id", "candidate_id"], "left_anti"), "fresh")
        scored = stored(products(fresh, asked, index.nodes, decimals, limits), "scored")
        seen = seen.unionByName(scored.select("query_id", "candidate_id"))
        merged = state.drop("rank").withColumn("done", F.lit(True)).unionByName(scored.withColumn("done", F.lit(False)))
        state = stored(rank_by(merged, ["query_id"], order, beam), "walk")
    best = state.where(F.col("rank") <= k).select("query_id", "candidate_id", "score")
    copies = index.copies.where(F.col("copy") <= k).drop("copy")
    whole = spread_join(best, copies, "candidate_id", "query_id", limits).select("query_id", F.col("copy_id").alias("candidate_id"), "score")
    lists = top_k(whole, k)
    n_entries = index.entries.count()
    if hops is None and k > n_entries:
        lists = stored(lists, "lists")
        wanted = min(k, index.copies.count())
        full = lists.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= wanted)
        short = asked.join(full, "query_id", "left_anti")
        items = index.nodes.join(index.copies, "candidate_id").select(F.col("copy_id").alias("candidate_id"), "vector")
        lists = lists.join(full.select("query_id"), "query_id", "left_semi").unionByName(exact_topk(short, items, k, decimals=decimals, limits=limits))
    same = queries.join(asked.withColumnRenamed("query_id", "first_query"), "vector").select("query_id", "first_query")
    found = same.join(lists.withColumnRenamed("query_id", "first_query").hint("merge"), "first_query")
    counts = seen.groupBy("query_id").agg(F.count(F.lit(1)).alias("met")).select("query_id", (F.col("met") + F.lit(max(0, n_entries - beam))).alias("candidates"))
    return Walked(found.select("query_id", "candidate_id", "score", "rank"), counts)


def spread_join(left: DataFrame, right: DataFrame, key: str, salt: str, limits: Limits = LIMITS) -> DataFrame:
    """An inner join of a table with few rows a key: keys hot on the left are cut by ``salt``, and repeated on the right.

    Hot keys are at most the rows of ``left``, which is read twice, over ``limits.block_rows``.
    """
    if left.count() <= limits.block_rows:
        return left.join(right, key)
    hot = left.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limits.block_rows)
    hot = stored(hot.select(key, F.ceil(F.col("n") / limits.block_rows).cast("int").alias("_slices")), "hot")
    slices = F.coalesce("_slices", F.lit(1))
    cut = left.join(hot, key, "left").withColumn("_slice", F.pmod(F.xxhash64(salt), slices).cast("int")).drop("_slices")
    repeated = right.join(hot, key, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("_slices")
    return cut.join(repeated, [key, "_slice"]).drop("_slice")


def products(pairs: DataFrame, asked: DataFrame, nodes: DataFrame, decimals: int, limits: Limits = LIMITS) -> DataFrame:
    """(query_id, candidate_id, score) of given pairs, scored in Arrow batches, or in blocks of queries and nodes if they are many."""
    n_pairs = pairs.count()
    if n_pairs > limits.direct_pairs:
        q, i = extents(asked, nodes)
        held, groups = max(1, limits.list_bytes // (8 * max(1, q.dim))), ceil(n_pairs / PAIRS_OF_GROUP)
        of_query = max(ceil(q.rows / held), round((groups * q.rows / max(1, i.rows)) ** 0.5), 1)
        of_node = max(ceil(i.rows / held), ceil(groups / of_query))
        if q.rows * of_node + i.rows * of_query <= n_pairs:
            return _products_in_blocks(pairs, asked, nodes, decimals, of_query, of_node)
    met = spread_join(pairs, nodes, "candidate_id", "query_id", limits).withColumnRenamed("vector", "theirs")
    rows = met.join(asked, "query_id").select("query_id", "candidate_id", "vector", "theirs")
    schema = T.StructType([rows.schema["query_id"], rows.schema["candidate_id"], T.StructField("score", T.DoubleType())])
    arrow_schema, unit = to_arrow_schema(schema), 10.0**decimals

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                exact = np.einsum("ij,ij->i", blocks.matrix(batch.column("vector")), blocks.matrix(batch.column("theirs")))
                rounded = np.floor(exact * unit + 0.5) / unit
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("candidate_id"), pa.array(rounded)], schema=arrow_schema)

    return rows.mapInArrow(score, schema)


def _products_in_blocks(pairs: DataFrame, asked: DataFrame, nodes: DataFrame, decimals: int, of_query: int, of_node: int) -> DataFrame:
    """``products`` where pairs are many times the vectors: queries and nodes are dealt into so many parts.

    Pairs of two parts meet the vectors of both in one group, so a vector is shuffled once for each part of the others, not
    once for each pair.
    """

    def part(name: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    kinds = [x.schema["vector"].dataType for x in (asked, nodes)]
    vector = F.col("vector").cast(kinds[0] if kinds[0] == kinds[1] else T.ArrayType(T.DoubleType())).alias("vector")
    group = (F.col("of_query") * F.lit(of_node) + F.col("of_node")).alias("group")
    q = asked.select("query_id", vector, part("query_id", of_query).alias("of_query"), every(of_node).alias("of_node"))
    i = nodes.select("candidate_id", vector, part("candidate_id", of_node).alias("of_node"), every(of_query).alias("of_query"))
    both = q.select(group, "query_id", "vector").unionByName(i.select(group, "candidate_id", "vector"), allowMissingColumns=True)
    met = pairs.select(
        F.col("query_id").alias("asked"), F.col("candidate_id").alias("met"),
        part("query_id", of_query).alias("of_query"), part("candidate_id", of_node).alias("of_node"),
    ).select(group, "asked", "met")
    schema = T.StructType([pairs.schema["query_id"], pairs.schema["candidate_id"], T.StructField("score", T.DoubleType())])
    arrow_schema, unit = to_arrow_schema(schema), 10.0**decimals

    def score(mine: pa.Table, held: pa.Table) -> pa.Table:
        if not len(mine) or not len(held):
            return arrow_schema.empty_table()
        sides = []
        for pair_id, name in (("asked", "query_id"), ("met", "candidate_id")):
            own = held.filter(pc.is_valid(held[name]))
            place, at = _places(mine[pair_id].combine_chunks(), own[name].combine_chunks())
            sides.append((place, at, blocks.matrix(own["vector"])))
        (of_q, q_at, q_vectors), (of_i, i_at, i_vectors) = sides
        # a pair is scored once for each row with its ids, as a join does
        pair, left, right = _joined(of_q, q_at, of_i, i_at)
        scores = np.empty(len(pair))
        for start in range(0, len(pair), _ROWS_AT_ONCE):
            some = slice(start, start + _ROWS_AT_ONCE)
            scores[some] = np.einsum("ij,ij->i", q_vectors[left[some]], i_vectors[right[some]])
        chosen = pa.array(pair)
        columns = [mine[name].combine_chunks().take(chosen) for name in ("asked", "met")]
        return pa.Table.from_arrays([*columns, pa.array(np.floor(scores * unit + 0.5) / unit)], schema=arrow_schema)

    return met.groupBy("group").cogroup(both.groupBy("group")).applyInArrow(score, schema)


def _places(wanted: pa.Array, held: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted id the number of it among those held, -1 if it is not; and the rows of the ids, in order of their numbers."""
    names = pc.unique(held)
    numbers = pc.index_in(held, value_set=names).to_numpy()
    place = pc.fill_null(pc.index_in(wanted, value_set=names), -1).to_numpy()
    order = np.argsort(numbers, kind="stable")
    return place, np.stack([numbers[order], order]) if len(order) else np.zeros((2, 0), np.int64)


def _joined(of_q: np.ndarray, q_at: np.ndarray, of_i: np.ndarray, i_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, query row, node row): each pair with all rows that have its ids."""
    pair = np.flatnonzero((of_q >= 0) & (of_i >= 0))
    rows = []
    for of, (numbers, order) in ((of_q, q_at), (of_i, i_at)):
        first = np.searchsorted(numbers, of[pair])
        times = np.searchsorted(numbers, of[pair], side="right") - first
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pair, rows = np.repeat(pair, times), [np.repeat(x, times) for x in rows]
        rows.append(order[np.repeat(first, times) + nth])
    return pair, *rows
