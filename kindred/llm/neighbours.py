"""Approximate nearest neighbours by an adaptive scan of dimensions in the probed lists of an inverted file.

Vectors get one more component that makes all of them equally long, so the largest inner product is the smallest
distance; a random rotation spreads each distance evenly over all components.  A list keeps its rotated vectors in
blocks of columns.  After each block a test compares the distance so far with the best known ones, and drops
candidates that are, with high probability, too far away.

A query goes through its nearest lists first; the last of what it finds there limits the scan of all its other lists, so
the test works from their first candidate on, however short they are.  There are as many lists as the square root of the
number of vectors, and as many of them are probed as a hashed sample of queries, searched exactly, needs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from kindred.llm.common import drop, store

# vectors on which the lists' centres are fitted, or up to twice as many
FIT_ROWS = 32_000
# most lists: centres are broadcast
MAX_LISTS = 2048
# share of the true neighbours that must lie in probed lists, and the queries of the sample that measures it, or up to
# twice as many
TARGET = 0.975
TRIAL_QUERIES = 256
# rows that the lists searched first should hold, in multiples of k
FIRST_DEPTH = 3
# columns of a block of the scan
BLOCK_DIMS = 16
# deviations by which a partial distance must exceed what is expected of a near vector
CONFIDENCE = 2.1
# vectors of one part of a list, queries of one slice: what a task holds at once
PART_ROWS = 20_000
SLICE_QUERIES = 2_000


@dataclass
class Index:
    """Bounded by the number of lists and of dimensions."""

    longest: float  # squared length to which vectors are filled up
    rotation: np.ndarray
    centres: np.ndarray  # rotated

    def fill(self, vectors: np.ndarray) -> np.ndarray:
        """Rotated vectors with the component that makes them as long as the longest."""
        rest = np.sqrt(np.maximum(self.longest - np.einsum("ij,ij->i", vectors, vectors), 0))
        return np.hstack([vectors, rest[:, None]]) @ self.rotation

    def ask(self, queries: np.ndarray) -> np.ndarray:
        return np.hstack([queries, np.zeros((len(queries), 1))]) @ self.rotation


def usable(column: str) -> Column:
    """Vectors without null or non-finite components that are not zero."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def fit(vectors: DataFrame, lists: int | None = None, fit_rows: int = FIT_ROWS, seed: int = 5, rounds: int = 12) -> Index | None:
    """An index of (vec_id, embedding), usable vectors of one length; None if there are none.

    ``lists`` is the square root of the number of vectors, but at most MAX_LISTS, if not given.
    The longest vector is found among all rows; centres come from k-means on some ``fit_rows`` rows (less than twice as
    many), chosen by a hash of id and vector.
    """
    sizes = vectors.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d"), F.min(F.size("embedding")).alias("e"), F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    if sizes.d is None:
        return None
    if sizes.d != sizes.e:
        raise ValueError("vectors differ in their number of components")
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.standard_normal((sizes.d + 1, sizes.d + 1)))
    index = Index(sizes.m * (1 + 1e-12), rotation, np.zeros((1, sizes.d + 1)))
    every = max(1, sizes.n // fit_rows)
    sample = vectors.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(every)) == 0).select("embedding").toPandas()
    points = index.fill(np.stack(sample["embedding"].to_numpy()).astype(np.float64))
    points = np.unique(points, axis=0)
    lists = lists or min(MAX_LISTS, max(1, round(sizes.n**0.5)))
    centres = points[rng.choice(len(points), min(lists, len(points)), replace=False)]
    for _ in range(rounds):
        lengths = (centres**2).sum(axis=1)
        near = np.concatenate([np.argmin(lengths - 2 * points[a : a + 4096] @ centres.T, axis=1) for a in range(0, len(points), 4096)])
        held = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    index.centres = centres
    return index


def scan(
    rotated: np.ndarray, queries: np.ndarray, limits: np.ndarray, block_dims: int = BLOCK_DIMS, confidence: float = CONFIDENCE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs (query, candidate) that no test dropped, their squared distances, and the pairs of components compared.

    ``limits`` holds, for each query, the squared distance of the worst of its best so far.  With d of D components seen,
    a pair is dropped when its partial distance times D / d exceeds limit * (1 + confidence / sqrt(d))^2; with all of
    them seen, when it is beyond the limit.  While many pairs are left a block is one matrix product for all; once few
    are, only those go on.
    """
    width = rotated.shape[1]
    blocks = [slice(s, min(s + block_dims, width)) for s in range(0, width, block_dims)]
    far = np.zeros((len(queries), len(rotated)))
    q = x = None
    work = 0
    for block in blocks:
        mine, theirs = queries[:, block], rotated[:, block]
        if q is None:
            far += np.einsum("ij,ij->i", mine, mine)[:, None] + np.einsum("ij,ij->i", theirs, theirs) - 2 * (mine @ theirs.T)
            work += far.size * mine.shape[1]
        else:
            step = mine[q] - theirs[x]
            far = far + np.einsum("ij,ij->i", step, step)
            work += step.size
        seen = block.stop
        bound = limits * (1 + 1e-9) + 1e-9 if seen == width else limits * seen / width * (1 + confidence / np.sqrt(seen)) ** 2
        if q is None:
            alive = far <= bound[:, None]
            if seen == width or np.count_nonzero(alive) < 0.1 * alive.size:
                q, x = np.nonzero(alive)
                far = far[q, x]
        else:
            fit = far <= bound[q]
            q, x, far = q[fit], x[fit], far[fit]
    return q, x, far, work


def search_part(
    part: pd.DataFrame, asked: pd.DataFrame, index: Index, k: int, block_dims: int = BLOCK_DIMS, confidence: float = CONFIDENCE,
    chunk: int = 1024, batch: int = 256,
) -> pd.DataFrame:
    """The best ``k`` of one part of a list for each query, with exact inner products in double precision.

    A query with a ``floor`` needs no candidate with a smaller product.
    """
    out: list[pd.DataFrame] = []
    if len(part) and len(asked):
        vectors, ids = np.stack(part["embedding"].to_numpy()).astype(np.float64), part["vec_id"].to_numpy()
        rotated = index.fill(vectors)
        for at in range(0, len(asked), batch):
            own = asked.iloc[at : at + batch]
            queries, names = np.stack(own["embedding"].to_numpy()).astype(np.float64), own["query_id"].to_numpy()
            turned = index.ask(queries)
            base = np.einsum("ij,ij->i", queries, queries) + index.longest
            floors = own["floor"].to_numpy(np.float64, na_value=np.nan)
            # a hair more than the last, so that equals with smaller ids are still seen
            given = np.where(np.isnan(floors), np.inf, np.maximum(base - 2 * floors, 0))
            limits = given.copy()
            row, best_id, best = np.zeros(0, np.int64), np.zeros(0, ids.dtype), np.zeros(0)
            # the first chunk is short where it must find the limits for the others
            opening = FIRST_DEPTH * k if np.isinf(limits).any() else chunk
            starts = [0, *range(opening, len(ids), chunk)]
            for start, stop in zip(starts, [*starts[1:], len(ids)]):
                q, x, far, _ = scan(rotated[start:stop], turned, limits, block_dims, confidence)
                if start == 0 and len(ids) > 2 * k and np.isinf(limits).all():
                    # nothing is known yet: of each query's first chunk only the k nearest, with ties and itself, matter
                    table = far.reshape(len(own), -1)
                    if table.shape[1] > k + 1:
                        last = np.partition(table, k, axis=1)[:, k]
                        fit = far <= last[q] * (1 + 1e-9) + 1e-9
                        q, x = q[fit], x[fit]
                x = x + start
                other = ids[x] != names[q]
                q, x = q[other], x[other]
                score = np.concatenate([best, (vectors[x] * queries[q]).sum(axis=1)])
                row, best_id = np.concatenate([row, q]), np.concatenate([best_id, ids[x]])
                order = np.lexsort((best_id, -score, row))
                row = row[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                kept = order[place < k]
                row, best_id, best = row[place < k], best_id[kept], score[kept]
                full = np.flatnonzero(np.bincount(row, minlength=len(own)) == k)
                ends = np.searchsorted(row, full, side="right") - 1
                limits[full] = np.minimum(given[full], np.maximum(base[full] - 2 * best[ends], 0))
            out.append(pd.DataFrame({"query_id": names[row], "vec_id": best_id, "score": best}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})


def assign(vectors: DataFrame, index: Index, probes: int, id_name: str) -> DataFrame:
    """(id, embedding, list, place) with one row for each of the ``probes`` nearest lists, numbered from 0 by ``place``."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def run(frames):
        own = shared.value
        for frame in frames:
            if not len(frame):
                continue
            raw = np.stack(frame["embedding"].to_numpy()).astype(np.float64)
            filled = own.fill(raw) if probes == 1 else own.ask(raw)
            near = nearest_lists(own, filled, probes)
            yield pd.DataFrame({id_name: frame[id_name], "embedding": frame["embedding"], "lists": list(near.astype(np.int32))})

    kind = vectors.schema["embedding"].dataType.simpleString()
    chosen = vectors.select(id_name, "embedding").mapInPandas(run, f"{id_name} long, embedding {kind}, lists array<int>")
    return chosen.select(id_name, "embedding", F.posexplode("lists").alias("place", "list"))


def nearest_lists(index: Index, filled: np.ndarray, probes: int) -> np.ndarray:
    """For each rotated vector its ``probes`` nearest lists, nearest first."""
    far = (index.centres**2).sum(axis=1) - 2 * filled @ index.centres.T
    return np.argsort(far, axis=1, kind="stable")[:, : min(probes, len(index.centres))]


def measured_probes(placed: DataFrame, index: Index, k: int, target: float = TARGET, trial_queries: int = TRIAL_QUERIES, batch: int = 1024) -> int:
    """The fewest lists that hold a share ``target`` of the ``k`` nearest of some ``trial_queries`` vectors of ``placed``.

    The trial queries, fewer than twice as many and chosen by a hash, are compared with all vectors, in blocks; each task
    keeps k of a query, and at most that many rows a query come to the driver.  The share asked for is raised by what a
    sample of so many queries may err (one-sided, 95 %).
    """
    rows = placed.count()
    every = max(1, rows // trial_queries)
    trial = placed.where(F.pmod(F.xxhash64("vec_id", "embedding", F.lit(7)), F.lit(every)) == 0).select("vec_id", "embedding").toPandas()
    if not len(trial):
        return len(index.centres)
    queries, names = np.stack(trial["embedding"].to_numpy()).astype(np.float64), trial["vec_id"].to_numpy()
    shared = placed.sparkSession.sparkContext.broadcast((queries, names))

    def best(frames):
        mine, own = shared.value
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                ids = part["vec_id"].to_numpy()
                score = np.stack(part["embedding"].to_numpy()).astype(np.float64) @ mine.T
                score[ids[:, None] == own] = -np.inf
                keep = min(k, len(ids))
                top = np.argpartition(-score, keep - 1, axis=0)[:keep]
                frame_out = pd.DataFrame({
                    "trial": np.tile(np.arange(len(own)), keep), "list": part["list"].to_numpy()[top].ravel(),
                    "vec_id": ids[top].ravel(), "score": np.take_along_axis(score, top, axis=0).ravel(),
                })
                yield frame_out[np.isfinite(frame_out["score"])]

    by = Window.partitionBy("trial").orderBy(F.desc("score"), "vec_id")
    hits = placed.mapInPandas(best, "trial int, list int, vec_id long, score double")
    hits = hits.withColumn("n", F.row_number().over(by)).where(F.col("n") <= k).select("trial", "list").toPandas()
    if not len(hits):
        return len(index.centres)
    order = np.argsort(nearest_lists(index, index.ask(queries), len(index.centres)), axis=1)
    depth = np.sort(order[hits["trial"].to_numpy(), hits["list"].to_numpy()])
    share = min(1.0, target + 1.645 * (target * (1 - target) / len(hits)) ** 0.5)
    return int(depth[min(len(depth) - 1, int(np.ceil(share * len(depth))) - 1)]) + 1


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, lists: int | None = None, probes: int | None = None, fit_rows: int = FIT_ROWS,
    confidence: float = CONFIDENCE, part_rows: int = PART_ROWS, slice_queries: int = SLICE_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of (vec_id, embedding) for each of (query_id, embedding).

    ``score`` is the inner product, in double precision, of the original vectors; ties go to the smaller id; a row with the
    query's own id is no candidate.  Null, zero and non-finite vectors and null ids take no part on either side.
    Repeated rows of one id are one candidate if their vectors are equal, else count as they are.  Lists of many rows are
    cut into parts, and their queries into slices, so a task holds no more than a part and a slice however the vectors
    crowd.  Other columns are ignored.  No usable vectors, no rows.

    Without ``lists`` their number follows that of the vectors; without ``probes`` it is measured (``measured_probes``).
    A query gets all candidates if they are fewer than ``k``, and ``k`` of them always: one whose probed lists hold fewer
    goes through all lists.
    """
    items = vectors.select(F.col("vec_id").cast("long"), "embedding").where(F.col("vec_id").isNotNull() & usable("embedding")).distinct()
    asked = queries.select(F.col("query_id").cast("long"), "embedding").where(F.col("query_id").isNotNull() & usable("embedding")).distinct()
    items, items_path = store(items, "vectors")
    index = fit(items, lists, fit_rows)
    spark = vectors.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    placed, _ = store(assign(items, index, 1, "vec_id").drop("place"), "lists")
    drop(spark, items_path)
    # one number for each list: bounded by the number of lists
    held = {r["list"]: r["count"] for r in placed.groupBy("list").count().collect()}
    probes = probes or measured_probes(placed, index, k)
    # lists of middling size that hold FIRST_DEPTH times k rows: what a query goes through first, without a limit
    middling = max(1, sorted(held.values())[len(held) // 2])
    first = min(probes, -(-FIRST_DEPTH * k // middling))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def through(probing: DataFrame) -> DataFrame:
        return meet(placed, probing, held, index, k, confidence, part_rows, slice_queries)

    def best(hits: DataFrame) -> DataFrame:
        # ranked in tasks first, so that no more than k rows of a query leave one
        return hits.distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    def floors(found: DataFrame) -> DataFrame:
        return found.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))

    near = assign(asked, index, probes, "query_id")
    none = F.lit(None).cast("double").alias("floor")
    found, _ = store(best(through(near.where(F.col("place") < first).select("*", none))), "first")
    if probes > first:
        rest = near.where(F.col("place") >= first).join(floors(found), "query_id", "left")
        found, _ = store(best(through(rest).unionByName(found.drop("rank"))), "probed")
    if probes < len(index.centres):
        # few: queries whose probed lists hold less than k candidates
        short = asked.join(floors(found), "query_id", "left_anti")
        others = assign(short, index, len(index.centres), "query_id").where(F.col("place") >= probes).select("*", none)
        found = best(through(others).unionByName(found.drop("rank")))
    return found.select("query_id", "rank", "vec_id", "score")


def meet(
    placed: DataFrame, probing: DataFrame, held: dict[int, int], index: Index, k: int, confidence: float, part_rows: int, slice_queries: int
) -> DataFrame:
    """(query_id, vec_id, score): candidates of (vec_id, embedding, list) that (query_id, embedding, list, floor) finds."""
    spark = placed.sparkSession
    shared = spark.sparkContext.broadcast(index)
    probing, _ = store(probing, "probes")
    slices = {r["list"]: -(-r["count"] // slice_queries) for r in probing.groupBy("list").count().collect()}
    shape = spark.createDataFrame([(x, -(-held[x] // part_rows), slices[x]) for x in held if x in slices], "list int, parts long, slices long")
    cut = placed.join(F.broadcast(shape), "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts")).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    into = probing.join(F.broadcast(shape), "list").withColumn("slice", F.pmod(F.xxhash64("query_id"), "slices")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    keys = ["list", "part", "slice"]

    def find(part: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return search_part(part, asked, shared.value, k, confidence=confidence)

    left = cut.select(*keys, "vec_id", "embedding").groupBy(*keys)
    right = into.select(*keys, "query_id", "embedding", "floor").groupBy(*keys)
    return left.cogroup(right).applyInPandas(find, "query_id long, vec_id long, score double")
