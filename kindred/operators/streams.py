"""Lists of the best items, finished by the task that holds the queries: items pass through it as a sorted stream.

Queries and items meet in groups.  A group's queries stay in its task with the best hits so far, bounded by
``limits.list_bytes``, while the items of the group stream by.  No hit is shuffled.  Where every query meets every item
(``past_slices``), items are written once, as blocks, and each task reads those: nothing is repeated on disk.  Where
groups differ (``streamed_topk``), an item is shuffled once for each group it meets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kindred.operators import blocks
from kindred.operators.bounds import ERROR, Asked, BlockHits, block_topk
from kindred.session import stored

# hits of a group that wait to be merged, at least
_PENDING = 500_000
# rows and bytes of a block that streams by, and rows of a result handed on at once
_BLOCK_ROWS, _BLOCK_BYTES, _RESULT_ROWS = 10_000, 8 << 20, 4096
# ordinals of the rows of a sorted partition
_ORDINALS = 40


def hits_schema(query_type: T.DataType, item_type: T.DataType) -> T.StructType:
    hit = T.StructType([T.StructField("candidate_id", item_type), T.StructField("score", T.DoubleType())])
    return T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("hits", T.ArrayType(hit)),
            T.StructField("met", T.LongType()),
            T.StructField("candidates", T.LongType()),
        ]
    )


def bytes_per_query(dim: int, k: int) -> int:
    """What a query takes in a task: its vector in both precisions and turned, its hits and those that wait."""
    return 20 * max(1, dim) + 48 * k + 64


class BestHits:
    """The best k items of the queries of a group, of those seen so far."""

    def __init__(self, query_ids: pa.Array, vectors: np.ndarray, floors: np.ndarray, k: int, decimals: int, rotation, edges):
        self.query_ids, self.floors, self.k, self.decimals = query_ids, floors.copy(), k, decimals
        self.asked, self.edges = Asked(vectors, rotation), edges
        self.first = 0
        self.row, self.ordinal = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.waiting: list[tuple] = []
        self.n_waiting = 0
        # ids of the items that are hits, by rising ordinals
        self.ids: list[tuple[np.ndarray, pa.Array]] = []
        self.met, self.compared = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)

    def add(self, ids: pa.Array, vectors: np.ndarray, first: int | None = None) -> None:
        """Items in order of their ids; ``first`` is the place of the first in that order, by default after all earlier ones."""
        self.first = self.first if first is None else first
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        level = np.searchsorted(self.edges, norms, side="right") if len(self.edges) else np.zeros(len(norms), np.int64)
        reach = self.floors - 10.0**-self.decimals
        used = []
        for one in np.unique(level):
            mine = np.flatnonzero(level == one)
            rows = np.flatnonzero(~(self.asked.norms * (norms[mine].max() * (1 + ERROR)) < reach))
            if not len(rows):
                continue
            whole = len(mine) == len(vectors)
            found = block_topk(self.asked.of(rows), self.floors[rows], vectors if whole else vectors[mine], self.k, self.decimals)
            self.met[rows] += len(mine)
            self.compared[rows] += found.compared
            columns = mine[np.concatenate(found.columns)]
            used.append(columns)
            self.waiting.append((np.repeat(rows, found.lengths), columns + self.first, np.concatenate(found.scores)))
            self.n_waiting += len(columns)
        if used:
            used = np.unique(np.concatenate(used))
            self.ids.append((used + self.first, ids.take(pa.array(used))))
        self.first += len(vectors)
        if self.n_waiting >= max(_PENDING, len(self.floors) * self.k // 2):
            self._merge()

    def add_for(self, rows: np.ndarray, ids: pa.Array, vectors: np.ndarray, ordinals: np.ndarray) -> None:
        """Items that some of the queries meet, in order of their ids; ``ordinals`` are their places in that order among all."""
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        rows = rows[~(self.asked.norms[rows] * (norms.max(initial=0.0) * (1 + ERROR)) < self.floors[rows] - 10.0**-self.decimals)]
        if not len(rows):
            return
        found = block_topk(self.asked.of(rows), self.floors[rows], vectors, self.k, self.decimals)
        self.met[rows] += len(ids)
        self.compared[rows] += found.compared
        columns = np.concatenate(found.columns)
        self.waiting.append((np.repeat(rows, found.lengths), ordinals[columns], np.concatenate(found.scores)))
        self.n_waiting += len(columns)
        used = np.unique(columns)
        self.ids.append((ordinals[used], ids.take(pa.array(used))))
        if self.n_waiting >= max(_PENDING, len(self.floors) * self.k // 2):
            self._merge()

    def add_found(self, ids: pa.Array, found: BlockHits) -> None:
        """Hits among items that follow all earlier ones in order of their ids, found for every query."""
        columns = np.concatenate(found.columns)
        self.met += len(ids)
        self.compared += found.compared
        if len(columns):
            self.waiting.append((np.repeat(np.arange(len(self.floors)), found.lengths), columns + self.first, np.concatenate(found.scores)))
            self.n_waiting += len(columns)
            used = np.unique(columns)
            self.ids.append((used + self.first, ids.take(pa.array(used))))
        self.first += len(ids)
        if self.n_waiting >= max(_PENDING, len(self.floors) * self.k // 2):
            self._merge()

    def _merge(self) -> None:
        row, ordinal, score = (np.concatenate(x) for x in zip((self.row, self.ordinal, self.score), *self.waiting))
        self.waiting, self.n_waiting = [], 0
        order = np.lexsort((ordinal, -score, row))
        row = row[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        order = order[nth < self.k]
        self.row, self.ordinal, self.score = row[nth < self.k], ordinal[order], score[order]
        last = nth == self.k - 1
        full = row[last]
        self.floors[full] = np.maximum(self.floors[full], score[order][nth[nth < self.k] == self.k - 1])
        if self.ids:
            held = np.concatenate([x for x, _ in self.ids])
            keep = np.flatnonzero(np.isin(held, self.ordinal))
            keep = keep[np.argsort(held[keep])]
            names = pa.concat_arrays([x for _, x in self.ids])
            self.ids = [(held[keep], names.take(pa.array(keep)))]

    def _pool(self) -> None:
        """Rows of one query id, null or not, share a list, held by the first of them."""
        codes = self.query_ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
        _, first, back = np.unique(codes, return_index=True, return_inverse=True)
        if len(first) == len(codes):
            return
        place = np.argsort(np.argsort(first))[back]
        first = np.sort(first)
        self.query_ids, self.floors = self.query_ids.take(pa.array(first)), self.floors[first]
        self.met, self.compared = (np.bincount(place, x).astype(np.int64) for x in (self.met, self.compared))
        self.row = place[self.row]
        self._merge()

    def batch(self, schema: pa.Schema, pooled: bool) -> pa.RecordBatch:
        self._merge()
        if pooled:
            self._pool()
        lengths = np.bincount(self.row, minlength=len(self.floors))
        if self.ids:
            held, names = self.ids[0]
        else:
            held, names = np.zeros(0, np.int64), pa.array([], schema.field("hits").type.value_type.field(0).type)
        return blocks.ragged_hits(
            self.query_ids, names, [np.searchsorted(held, self.ordinal)], [self.score], lengths, schema,
            [pa.array(self.met), pa.array(self.compared)],
        )


def _packed(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as out:
        for batch in batches:
            out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def past_slices(
    left: DataFrame, right: DataFrame, slices: int, key: str | list[str], schema: T.StructType,
    run: Callable[[pa.Table, Iterable[tuple[int, pa.Table]]], Iterator[pa.RecordBatch]],
    block_rows: int = _BLOCK_ROWS, block_bytes: int = _BLOCK_BYTES,
) -> DataFrame:
    """What ``run(asked, blocks)`` gives, as rows of ``schema``, for each slice of ``left`` past all rows of ``right``.

    ``left`` has a column ``place`` below ``slices``: the slice of a row.  ``blocks`` are all rows of ``right``, in any order,
    as pairs of a table in order of ``key`` and a number; numbers of rows that count on from it say where they are in that
    order among all.  ``right`` is sorted and written once; tasks read its blocks from the shared folder, so a slice costs
    no shuffle and no disk.  A task holds its slice twice and a few blocks.
    """
    spark = left.sparkSession

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, rows, size = TaskContext.get().partitionId() << _ORDINALS, [], 0, 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_packed(waiting)], pa.binary())], names=["first", "block"])

        for batch in batches:
            fit = max(1, min(block_rows, int(batch.num_rows * (block_bytes / max(1, batch.nbytes)))))
            for start in range(0, batch.num_rows, fit):
                part = batch.slice(start, fit)
                if waiting and (rows + part.num_rows > block_rows or size + part.nbytes > block_bytes):
                    yield block()
                    at, waiting, rows, size = at + rows, [], 0, 0
                waiting.append(part)
                rows, size = rows + part.num_rows, size + part.nbytes
        if waiting:
            yield block()

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([_packed(held)], pa.binary())], names=["block"])

    def search(pairs: Iterable[tuple]) -> Iterator[tuple[bytes]]:
        pairs = iter(pairs)
        head = next(pairs, None)
        if head is None:
            return
        every = ((block["first"], _unpacked(block["block"])) for _, block in chain([head], pairs))
        for batch in run(_unpacked(head[0]["block"]), every):
            for start in range(0, batch.num_rows, _RESULT_ROWS):
                yield (_packed([batch.slice(start, _RESULT_ROWS)]),)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column("block"):
                yield from _unpacked(block.as_py()).to_batches()

    blocks_ = stored(right.orderBy(key).mapInArrow(blocked, "first long, block binary"), "blocks")
    asked = left.repartitionById(slices, F.col("place")).drop("place").mapInArrow(sliced, "block binary")
    # a slice is one row of one partition and all blocks are one: pairs of partitions are the slices
    found = asked.rdd.cartesian(blocks_.coalesce(1).rdd).mapPartitions(search)
    return spark.createDataFrame(found, "block binary", verifySchema=False).mapInArrow(opened, schema)


def streamed_topk(
    left: DataFrame, right: DataFrame, tasks: int, k: int, decimals: int, rotation: np.ndarray | None = None, edges: list[float] = (),
    pooled: bool = False, item: str = "vector", best: Callable[[np.ndarray, np.ndarray, np.ndarray, pa.Array], BlockHits] | None = None,
) -> DataFrame:
    """Lists (query_id, hits, met, candidates) of each group, best first, hits of the floor or more.

    ``left`` is (place, group, query_id, vector, floor), ``right`` (place, group, candidate_id, vector); ``place``, below
    ``tasks``, says which task a group is for.  ``pooled`` gives one list to all rows of a group with one query id.  ``rotation`` and ``edges`` decide how much is compared (``bounds``).
    With ``best(cells, queries, floors, items)`` items come as the column ``item``, with their ``cell``, and it gives the best of a block.
    """
    spark = left.sparkSession
    schema = hits_schema(left.schema["query_id"].dataType, right.schema["candidate_id"].dataType)
    arrow_schema = to_arrow_schema(schema)
    kinds = [x.schema["vector"].dataType for x in ((left, right) if best is None else (left, left))]
    kind = kinds[0] if kinds[0] == kinds[1] else T.ArrayType(T.DoubleType())
    vector = F.col("vector").cast(kind)
    asked = left.select("place", "group", vector, F.lit(0).alias("side"), "query_id", F.col("floor").cast("double"))
    held = right.select("place", "group", *([vector] if best is None else [item, "cell"]), F.lit(1).alias("side"), "candidate_id")
    rows = asked.unionByName(held, allowMissingColumns=True).repartitionById(tasks, F.col("place"))
    shared = spark.sparkContext.broadcast((rotation, np.sort(np.asarray(edges, dtype=float))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation, edges = shared.value
        at, waiting, held = None, [], None

        def prepared() -> BestHits | None:
            if not waiting:
                return None
            asked = pa.Table.from_batches(waiting)
            waiting.clear()
            floors = asked["floor"].to_numpy()
            return BestHits(asked["query_id"].combine_chunks(), blocks.matrix(asked["vector"]), floors, k, decimals, rotation, edges)

        for batch in batches:
            if not batch.num_rows:
                continue
            group, side = batch.column("group").to_numpy(), batch.column("side").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (side[1:] != side[:-1])]))
            for start, stop in zip(starts, np.append(starts[1:], len(group))):
                part = batch.slice(start, stop - start)
                if group[start] != at:
                    if held is not None:
                        yield held.batch(arrow_schema, pooled)
                    at, held = group[start], None
                    waiting.clear()
                if side[start] == 0:
                    waiting.append(part)
                    continue
                held = held or prepared()
                if held is None:
                    continue
                if best is None:
                    held.add(part.column("candidate_id"), blocks.matrix(part.column("vector")))
                else:
                    cells = part.column("cell").to_numpy()
                    held.add_found(part.column("candidate_id"), best(cells, held.asked.vectors, held.floors, part.column(item)))
        if held is not None:
            yield held.batch(arrow_schema, pooled)

    return rows.sortWithinPartitions("group", "side", "candidate_id").mapInArrow(search, schema)
