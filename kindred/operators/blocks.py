"""Arrow-batch helpers used inside search tasks: score a block, keep the best k.

All search paths share one order: higher score first, scores compared after
rounding to a fixed number of decimals, equal scores by candidate id.  Rounding
keeps floating-point noise, which differs between plans, from reordering ties.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CELLS_AT_ONCE = 4_000_000


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as a double matrix; all vectors must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if column.null_count or column.flatten().null_count:
        raise ValueError("vectors must not be null or hold nulls")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if not len(column):
        return flat.reshape(0, 0)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != lengths[0]).any():
        raise ValueError(f"vector lengths differ: {lengths.min()} to {lengths.max()}")
    return flat.reshape(len(column), int(lengths[0]))


def sums_by(group: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each of ``n`` groups, column by column."""
    columns = np.ascontiguousarray(rows.T)
    return np.stack([np.bincount(group, column, minlength=n) for column in columns], axis=1)


def sorted_block(ids: pa.Array, vectors: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Ids in ascending order with their vectors in the same order."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    order = pc.sort_indices(ids)
    return ids.take(order), matrix(vectors)[order.to_numpy()]


def best_columns(
    queries: np.ndarray, items: np.ndarray, k: int, decimals: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the k best items: (column numbers, scores), best first.

    ``items`` must be sorted by id, so that a lower column number wins a tie.
    """
    return best_of(lambda start, stop: queries[start:stop] @ items.T, len(queries), len(items), k, decimals)


def best_of(
    scores_of: Callable[[int, int], np.ndarray], n_q: int, n_i: int, k: int, decimals: int
) -> tuple[np.ndarray, np.ndarray]:
    """``best_columns`` of any scores: ``scores_of(start, stop)`` gives those of some queries with all items."""
    k = min(k, n_i)
    columns = np.empty((n_q, k), dtype=np.int64)
    scores = np.empty((n_q, k), dtype=np.float64)
    unit = 10.0**decimals
    tie = np.arange(n_i - 1, -1, -1, dtype=np.int64)
    step = max(1, _CELLS_AT_ONCE // max(1, n_i))
    for start in range(0, n_q, step):
        rounded = np.floor(scores_of(start, min(start + step, n_q)) * unit + 0.5)
        # one integer per cell that orders by score, then by id
        keys = rounded.astype(np.int64) * n_i + tie
        if k < n_i:
            top = np.argpartition(keys, n_i - k, axis=1)[:, n_i - k :]
        else:
            top = np.broadcast_to(np.arange(n_i), keys.shape)
        order = np.argsort(-np.take_along_axis(keys, top, axis=1), axis=1)
        top = np.take_along_axis(top, order, axis=1)
        columns[start : start + step] = top
        scores[start : start + step] = np.take_along_axis(rounded, top, axis=1) / unit
    return columns, scores


def best_in_row(units: np.ndarray, k: int, step: int, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns with a score other than 0 of one query, best first, and their scores.

    ``units`` are whole numbers, ``step`` of them to one unit of the rounded score, of which ``unit`` make a score of 1.
    """
    n = len(units)
    if n > k:
        # only scores that could round to the k-th best one are worth rounding
        reached = np.partition(units, n - k)[n - k]
        columns = np.flatnonzero((units >= reached - step) & (units != 0))
    else:
        columns = np.flatnonzero(units)
    rounded = (units[columns] + step // 2) // step
    columns, rounded = columns[rounded != 0], rounded[rounded != 0]
    keys = rounded * n + (n - 1 - columns)
    if len(columns) > k:
        top = np.argpartition(keys, len(keys) - k)[len(keys) - k :]
        columns, rounded, keys = columns[top], rounded[top], keys[top]
    order = np.argsort(-keys)
    return columns[order], rounded[order] / unit


def ragged_hits(
    query_ids: pa.Array,
    item_ids: pa.Array,
    columns: list[np.ndarray],
    scores: list[np.ndarray],
    lengths: list[int],
    schema: pa.Schema,
    others: list[pa.Array] = (),
) -> pa.RecordBatch:
    """One row per query with a hit list of its own length, and ``others`` as further columns."""
    hit_type = schema.field(1).type
    hits = pa.StructArray.from_arrays(
        [item_ids.take(pa.array(np.concatenate(columns))), pa.array(np.concatenate(scores))],
        fields=list(hit_type.value_type),
    )
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    lists = pa.ListArray.from_arrays(offsets, hits, type=hit_type)
    return pa.RecordBatch.from_arrays([query_ids, lists, *others], schema=schema)


def merge_best(
    pieces: list[tuple[pa.Array, np.ndarray, np.ndarray]], k: int, decimals: int
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Merge the best lists of the same queries over disjoint items into one list of k."""
    if len(pieces) == 1:
        return pieces[0]
    starts = np.cumsum([0] + [len(ids) for ids, _, _ in pieces[:-1]])
    all_ids = pa.concat_arrays([ids for ids, _, _ in pieces])
    columns = np.hstack([c + start for (_, c, _), start in zip(pieces, starts)])
    used = np.unique(columns)
    ids = all_ids.take(pa.array(used))
    order = pc.sort_indices(ids).to_numpy()
    place = np.empty(len(used), dtype=np.int64)
    place[order] = np.arange(len(used))
    columns = place[np.searchsorted(used, columns)]
    scores = np.hstack([s for _, _, s in pieces])
    rounded = np.floor(scores * 10.0**decimals + 0.5).astype(np.int64)
    best = np.argsort(-(rounded * len(used) + (len(used) - 1 - columns)), axis=1)[:, :k]
    return (
        ids.take(pa.array(order)),
        np.take_along_axis(columns, best, axis=1),
        np.take_along_axis(scores, best, axis=1),
    )


def hit_lists(
    query_ids: pa.Array,
    item_ids: pa.Array,
    columns: np.ndarray,
    scores: np.ndarray,
    schema: pa.Schema,
    floors: np.ndarray | None = None,
) -> pa.RecordBatch:
    """One row per query: its id and its hits, best first; hits below its floor are left out."""
    n_q, k = columns.shape
    if floors is None:
        return ragged_hits(query_ids, item_ids, [columns.ravel()], [scores.ravel()], [k] * n_q, schema)
    keep = scores >= floors[:, None]
    return ragged_hits(
        query_ids,
        item_ids,
        [columns[keep]],
        [scores[keep]],
        keep.sum(axis=1),
        schema,
    )
