"""Helpers shared by the corpus operators: tables, byte-bounded Arrow slices, hashes, folds."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kindred.session import scratch_path

# bytes of text that a kernel holds at once, unless one row alone is longer
SLICE_BYTES = 2 << 20
# most rows a kernel holds at once
SLICE_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES, max_rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of at most ``max_bytes`` in ``column``; a longer row comes alone."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < len(lengths):
        before = ends[at - 1] if at else 0
        stop = int(np.searchsorted(ends, before + max_bytes, side="right"))
        stop = min(max(stop, at + 1), at + max_rows)
        yield batch.slice(at, stop - at)
        at = stop


def map_slices(
    df: DataFrame, column: str, schema: str, kernel: Callable[[pa.RecordBatch], pa.RecordBatch], max_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``kernel`` over every byte-bounded slice of every partition; no shuffle, nothing kept between slices."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, max_bytes):
                yield kernel(part)

    return df.mapInArrow(run, schema)


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The texts of a batch as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def crc_fold(column: str, modulus: int) -> Column:
    """``crc32`` of the column as text, modulo ``modulus``; null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)).cast("int")


def crc_fold_value(value: object, modulus: int) -> int:
    return zlib.crc32(str(value).encode() if value is not None else b"") % modulus


def empty_like(schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([], schema=schema)


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same rows as a table in the shared folder, and its path: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table that ``store`` wrote and nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
