"""The best items of a block for each query: bounds on products drop pairs first, what is left is scored in full."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from kindred.operators import blocks

# columns of the first bound; each further one takes twice as many
FIRST_COLUMNS = 8
# from this share of pairs left on, a product of whole blocks costs less than one of the pairs
_DENSE = 0.1
# relative error allowed for in bounds computed in double precision
ERROR = 1e-9
# relative error of a rounding to single precision, and products up to which it cannot overflow
_SINGLE, _LARGEST = 2.0**-23, 1e30
# pairs looked at together: their products stay in a cache
PAIRS_AT_ONCE = 1_000_000


class Asked:
    """Queries as they are compared: as they are, in single precision, and turned with the lengths of their rests."""

    def __init__(self, vectors: np.ndarray, rotation: np.ndarray | None):
        self.vectors, self.rotation = vectors, rotation
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        with np.errstate(over="ignore"):
            self.single = vectors.astype(np.float32)
        self.stops, self.turned, self.rests = [], None, []
        if rotation is not None:
            stop, dim = FIRST_COLUMNS, vectors.shape[1]
            while stop < dim // 2 + 1:
                self.stops.append(stop)
                stop *= 2
        if self.stops:
            self.turned = vectors @ rotation
            self.rests = [rest(self.turned, s) for s in self.stops]

    def of(self, rows: np.ndarray | slice) -> "Asked":
        if not isinstance(rows, slice) and len(rows) == len(self.vectors):
            return self
        part = object.__new__(Asked)
        part.vectors, part.norms, part.single = self.vectors[rows], self.norms[rows], self.single[rows]
        part.rotation, part.stops = self.rotation, self.stops
        part.turned = None if self.turned is None else self.turned[rows]
        part.rests = [x[rows] for x in self.rests]
        return part


@dataclass(frozen=True)
class BlockHits:
    """Of each query of a block: columns and scores, best first and one array for all, how many, and the pairs scored in full."""

    columns: list[np.ndarray]
    scores: list[np.ndarray]
    lengths: np.ndarray
    compared: np.ndarray


def block_topk(asked: Asked, floors: np.ndarray, items: np.ndarray, k: int, decimals: int) -> BlockHits:
    """The k best items of a block with a score of the floor or more; ``items`` are in order of their ids."""
    n, dim = items.shape
    n_q = len(asked.vectors)
    floor = floors - 10.0**-decimals
    floor = floor - ERROR * (1 + np.abs(np.where(np.isfinite(floor), floor, 0.0)))
    most = np.sqrt((items * items).sum(axis=1)).max(initial=0.0)
    single = None
    if n_q and asked.norms.max() * most < _LARGEST and most < _LARGEST and asked.norms.max() < _LARGEST:
        single = items.astype(np.float32).T
        # every product and sum is off by a rounding at most, and so are the vectors
        lowest = np.nextafter((floor - (dim + 8) * _SINGLE * asked.norms * most - 1e-30).astype(np.float32), np.float32(-np.inf))
    useful = bool(asked.stops)
    if useful:
        turned = items @ asked.rotation
        rests = [rest(turned, s) for s in asked.stops]
    step = max(1, PAIRS_AT_ONCE // max(1, n))
    columns, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
    lengths, compared = np.zeros(n_q, dtype=np.int64), np.zeros(n_q, dtype=np.int64)
    unit = 10.0**decimals
    for start in range(0, n_q, step):
        rows = slice(start, min(start + step, n_q))
        pairs = None
        if useful:
            of_rows = [(s, q[rows], x) for s, q, x in zip(asked.stops, asked.rests, rests)]
            pairs = _pairs_left(asked.turned[rows], turned, of_rows, floor[rows])
            # where the bounds say nothing, they will not for the other queries of the block
            useful = pairs is not None
        if pairs is not None:
            compared[rows] = np.bincount(pairs[0], minlength=rows.stop - start)
        else:
            compared[rows] = n
            if single is not None:
                pairs = pairs_single(asked.single[rows], single, lowest[rows])
        if pairs is None:
            best, score = blocks.best_columns(asked.vectors[rows], items, k, decimals)
            keep = score >= floors[rows][:, None]
            lengths[rows] = keep.sum(axis=1)
            columns.append(best[keep])
            scores.append(score[keep])
            continue
        row, column = pairs
        score = np.floor(np.einsum("ij,ij->i", asked.vectors[rows][row], items[column]) * unit + 0.5) / unit
        keep = score >= floors[rows][row]
        row, column, score = row[keep], column[keep], score[keep]
        order = np.lexsort((column, -score, row))
        row, column, score = row[order], column[order], score[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        row, column, score = row[nth < k], column[nth < k], score[nth < k]
        lengths[rows] = np.bincount(row, minlength=rows.stop - start)
        columns.append(column)
        scores.append(score)
    return BlockHits(columns, scores, lengths, compared)


def rest(turned: np.ndarray, start: int) -> np.ndarray:
    """The length of what is left of the vectors after so many columns."""
    return np.sqrt((turned[:, start:] ** 2).sum(axis=1)) * (1 + ERROR)


def pairs_single(q: np.ndarray, x: np.ndarray, lowest: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs whose product in single precision may reach the floor; None if too many to go pair by pair."""
    if not np.isfinite(lowest).all():
        return None
    left = q @ x >= lowest[:, None]
    if np.count_nonzero(left) > _DENSE * left.size:
        return None
    return np.divmod(np.flatnonzero(left), x.shape[1])


def _pairs_left(q: np.ndarray, x: np.ndarray, bounds: list, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs whose bounds all reach the floor; None if too many to go pair by pair."""
    done = 0
    row = column = part = None
    for stop, rest_q, rest_x in bounds:
        if row is None:
            product = q[:, :stop] @ x[:, :stop].T
            left = product + rest_q[:, None] * rest_x >= floor[:, None]
            if left.mean() <= _DENSE:
                row, column = np.nonzero(left)
                part = product[row, column]
        else:
            part = part + np.einsum("ij,ij->i", q[row, done:stop], x[column, done:stop])
            left = part + rest_q[row] * rest_x[column] >= floor[row]
            row, column, part = row[left], column[left], part[left]
        done = stop
    return None if row is None else (row, column)
