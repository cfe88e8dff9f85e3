"""BM25 lists finished by the task that holds the queries: documents pass through it with their postings of the query terms.

Query bags are dealt into slices of bounded size, past each of which all documents stream as blocks
(one row a document, not one a posting).  Documents are written once and read by each task; neither pairs nor hits are shuffled.
In the task, terms whose largest weights in a block of documents add up to less than a query's floor generate no
candidates, and the floors rise with the hits found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kindred.config import Limits
from kindred.operators import blocks
from kindred.operators.streams import past_slices
from kindred.session import stored

# documents and postings of a block
_DOCS, _POSTINGS = 1 << 15, 1 << 21
# hits of a task that wait to be merged, at least
_PENDING = 500_000
# weights kept as one number a document, in a block
_WHOLE = 1 << 23


class _Term:
    """A query term in a block: its documents in order, their weights and the largest, and one weight a document if it is frequent."""

    __slots__ = ("places", "units", "most", "whole")

    def __init__(self, places: np.ndarray, units: np.ndarray, n: int, whole: bool):
        starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        if len(starts) < len(places):
            # bags with one id are one document
            places, units = places[starts], np.add.reduceat(units, starts)
        self.places, self.units, self.most, self.whole = places, units, int(units.max()), None
        if whole:
            self.whole = np.zeros(n, np.int64)
            self.whole[places] = units

    def of(self, places: np.ndarray) -> np.ndarray:
        if self.whole is not None:
            return self.whole[places]
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[at] == places, self.units[at], 0)


class BestDocuments:
    """The best documents of the bags of a task, of those seen so far; every weight is a whole number of units."""

    def __init__(self, asked: pa.Table, k: int, step: int, units: int):
        self.bags, self.k, self.step, self.units = asked["bag_id"].combine_chunks(), k, step, float(units)
        numbers = asked["numbers"].combine_chunks()
        self.offsets = numbers.offsets.to_numpy() - numbers.offsets[0].as_py()
        flat, factors = numbers.flatten().to_numpy(), asked["weights"].combine_chunks().flatten().to_numpy()
        self.vocabulary, term = np.unique(flat, return_inverse=True)
        # a term with one factor is weighed once a block, however many bags have it
        pairs = np.empty(len(term), dtype=[("term", np.int64), ("factor", np.float64)])
        pairs["term"], pairs["factor"] = term, factors
        self.weighted, self.which = np.unique(pairs, return_inverse=True)
        # least rounded scores that still matter
        self.floors = np.ones(len(self.bags), np.int64)
        self.row, self.ordinal, self.score, self.copies = (np.zeros(0, np.int64) for _ in range(4))
        self.waiting: list[tuple] = []
        self.n_waiting = self.first = 0
        self.ids: list[tuple[np.ndarray, pa.Array]] = []

    def add(self, docs: pa.Table, first: int | None = None) -> None:
        """Documents in order of their ids; ``first`` is the place of the first in that order, by default after all earlier ones."""
        self.first = self.first if first is None else first
        n, numbers = docs.num_rows, docs["numbers"].combine_chunks()
        place = np.repeat(np.arange(n), np.diff(numbers.offsets.to_numpy()))
        number, tfw = numbers.flatten().to_numpy(), docs["weights"].combine_chunks().flatten().to_numpy()
        at = np.minimum(np.searchsorted(self.vocabulary, number), len(self.vocabulary) - 1)
        mine = np.flatnonzero(self.vocabulary[at] == number)
        mine = mine[np.argsort(at[mine], kind="stable")]
        place, tfw, term = place[mine], tfw[mine], at[mine]
        starts = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        copies = docs["copies"].to_numpy()
        terms: dict[int, _Term | None] = {}
        held = 0
        total = np.zeros(n, np.int64)
        which, offsets, used = self.which.tolist(), self.offsets.tolist(), []
        for row in range(len(self.bags)):
            found = []
            for w in which[offsets[row] : offsets[row + 1]]:
                if w not in terms:
                    t, factor = self.weighted[w]
                    span = slice(starts[t], starts[t + 1])
                    terms[w] = None
                    if span.stop > span.start:
                        weights = np.floor(factor * tfw[span] * self.units + 0.5).astype(np.int64)
                        frequent = 8 * len(weights) >= n and held + n <= _WHOLE
                        held += n if frequent else 0
                        terms[w] = _Term(place[span], weights, n, frequent)
                if terms[w] is not None:
                    found.append(terms[w])
            places, scores = self._best(found, int(self.floors[row]), total)
            if len(places):
                if len(places) >= self.k:
                    self.floors[row] = max(self.floors[row], scores.min())
                used.append(places)
                self.waiting.append((np.full(len(places), row), places + self.first, scores, copies[places]))
                self.n_waiting += len(places)
        if used:
            used = np.unique(np.concatenate(used))
            self.ids.append((used + self.first, docs["doc_id"].combine_chunks().take(pa.array(used))))
        self.first += n
        if self.n_waiting >= max(_PENDING, len(self.bags) * self.k // 2):
            self._merge()

    def _best(self, found: list[_Term], floor: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and rounded scores of the k best of a block with the floor or more."""
        least, rest, weak = floor * self.step - self.step // 2, 0, 0
        found.sort(key=lambda x: x.most)
        while weak < len(found) and rest + found[weak].most < least:
            rest += found[weak].most
            weak += 1
        strong = found[weak:]
        if not strong:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(strong) == 1:
            mine = strong[0].units >= least - rest
            places, sums = strong[0].places[mine], strong[0].units[mine]
        else:
            total[:] = 0
            for term in strong:
                if term.whole is not None:
                    total += term.whole
                else:
                    total[term.places] += term.units
            places = np.flatnonzero(total >= least - rest)
            sums = total[places]
        for term in reversed(found[:weak]):
            if not len(places):
                break
            rest -= term.most
            sums = sums + term.of(places)
            left = sums + rest >= least
            places, sums = places[left], sums[left]
        scores = (sums + self.step // 2) // self.step
        if len(places) > self.k:
            keys = scores * len(total) + (len(total) - 1 - places)
            best = np.sort(np.argpartition(keys, len(keys) - self.k)[len(keys) - self.k :])
            places, scores = places[best], scores[best]
        return places, scores

    def _merge(self) -> None:
        """Keep what can be among the k best documents of a bag, copies counted."""
        row, ordinal, score, copies = (
            np.concatenate(x) for x in zip((self.row, self.ordinal, self.score, self.copies), *self.waiting)
        )
        self.waiting, self.n_waiting = [], 0
        if not len(row):
            return
        order = np.lexsort((ordinal, -score, row))
        row, ordinal, score, copies = row[order], ordinal[order], score[order], np.minimum(copies[order], self.k)
        place = np.arange(len(row))
        new_row = np.concatenate([[True], row[1:] != row[:-1]])
        new_score = new_row | np.concatenate([[True], score[1:] != score[:-1]])
        row_start = np.maximum.accumulate(np.where(new_row, place, 0))
        score_start = np.maximum.accumulate(np.where(new_score, place, 0))
        upto = np.cumsum(copies)
        before = upto - copies
        better = before[score_start] - before[row_start]
        # the document with which a list is full says what still matters
        full = (upto - before[row_start] >= self.k) & (before - before[row_start] < self.k)
        self.floors[row[full]] = np.maximum(self.floors[row[full]], score[full])
        keep = (place - row_start < self.k) & (better < self.k)
        self.row, self.ordinal, self.score, self.copies = row[keep], ordinal[keep], score[keep], copies[keep]
        if self.ids:
            held = np.concatenate([x for x, _ in self.ids])
            mine = np.flatnonzero(np.isin(held, self.ordinal))
            mine = mine[np.argsort(held[mine])]
            self.ids = [(held[mine], pa.concat_arrays([x for _, x in self.ids]).take(pa.array(mine)))]

    def batch(self, schema: pa.Schema, unit: float) -> pa.RecordBatch:
        self._merge()
        held, names = self.ids[0] if self.ids else (np.zeros(0, np.int64), pa.array([], schema.field(1).type.value_type.field(0).type))
        lengths = np.bincount(self.row, minlength=len(self.bags))
        return blocks.ragged_hits(self.bags, names, [np.searchsorted(held, self.ordinal)], [self.score / unit], lengths, schema)


def streamed_bags(terms: DataFrame, postings: DataFrame, documents: DataFrame, pairs: int, k: int, decimals: int, units: int, limits: Limits) -> DataFrame:
    """(bag_id, doc_id, score) of the documents that can be among a bag's k best with their copies; no weight is negative.

    ``terms`` is (bag_id, term, factor), ``postings`` (term, doc_id, tfw), ``documents`` (doc_id, copies).
    """
    spark = terms.sparkSession
    cores = spark.sparkContext.defaultParallelism
    # the numbers hold because the table is written before it is used
    numbers = stored(terms.select("term").distinct().withColumn("number", F.monotonically_increasing_id()), "term-numbers")
    n_bags = terms.select("bag_id").distinct().count()
    held = max(1, 4 * limits.list_bytes // (48 * k + 400))
    wanted = max(ceil(n_bags / held), min(2 * cores, ceil(pairs / 2e7)), 1)
    slices = min(max(1, n_bags), wanted if wanted <= cores else ceil(wanted / cores) * cores)

    def listed(rows: DataFrame, key: str, weight: str) -> DataFrame:
        pair = F.sort_array(F.collect_list(F.struct("number", F.col(weight).alias("weight"))))
        lists = rows.join(numbers, "term").groupBy(key).agg(pair.alias("pairs"))
        return lists.select(key, F.col("pairs.number").alias("numbers"), F.col("pairs.weight").alias("weights"))

    bags = listed(terms.select("bag_id", "term", "factor"), "bag_id", "factor")
    bags = bags.select(F.pmod(F.xxhash64("bag_id"), F.lit(slices)).cast("int").alias("place"), "bag_id", "numbers", "weights")
    docs = listed(postings.select("term", "doc_id", "tfw"), "doc_id", "tfw").join(documents, "doc_id")

    hit = T.StructType([T.StructField("doc_id", postings.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])
    schema = T.StructType([T.StructField("bag_id", T.LongType()), T.StructField("hits", T.ArrayType(hit))])
    arrow_schema = to_arrow_schema(schema)
    step, unit = units // 10**decimals, 10.0**decimals

    def search(asked: pa.Table, parts: Iterable[tuple[int, pa.Table]]) -> Iterator[pa.RecordBatch]:
        best = BestDocuments(asked, k, step, units)
        for first, part in parts:
            best.add(part, first)
        yield best.batch(arrow_schema, unit)

    found = past_slices(bags, docs, slices, "doc_id", schema, search, _DOCS, 16 * _POSTINGS)
    return found.select("bag_id", F.explode("hits").alias("hit")).select("bag_id", "hit.doc_id", "hit.score")
