"""Rows of sorted partitions as a stream, so that a group of any size passes through a task without being held."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kindred.llm.common import SLICE_BYTES, SLICE_ROWS, slices

# characters that separate words: U+0020 and U+0009 to U+000D
BLANKS = " \t\n\x0b\x0c\r"


def in_order(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """All rows of a key in one partition, sorted by key and ``order``."""
    return df.repartition(key).sortWithinPartitions(F.col(key), *order)


def rows_of(batches: Iterable[pa.RecordBatch], text: str | None = None) -> Iterator[tuple]:
    """The rows of the batches one by one; with ``text``, no more of that column at once than a slice holds."""
    for batch in batches:
        for part in slices(batch, text) if text else (batch,):
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, text: int | None = None) -> Iterator[pa.RecordBatch]:
    """The rows as batches; ``text`` is the place of a column that bounds a batch by its length."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[text] or "") if text is not None else 0
        if len(held) == SLICE_ROWS or size >= SLICE_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
