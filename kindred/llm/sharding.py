"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kindred.llm.common import store

SHARDS = 24
SEED = 7
# rows that one local permutation should hold, and the most source blocks and target cells: they bound the matrix
BLOCK_ROWS = 1_000_000
MAX_BLOCKS = 512
MAX_CELLS = 768


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many of ``draws`` items out of ``good`` and ``bad`` ones are good: inversion around the mode, at any size.

    Weights follow from the mode by exact ratios of neighbours; sixteen deviations to each side hold all that double
    precision can tell from zero.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    spread = np.sqrt(draws * (good / total) * (bad / total) * max(total - draws, 1) / max(total - 1, 1))
    reach = int(16 * spread) + 16
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    chance = np.exp(weight - weight.max())
    at = np.searchsorted(np.cumsum(chance), rng.random() * chance.sum(), side="right")
    return low + min(int(at), len(chance) - 1)


def communication_matrix(blocks: list[int], cells: list[int], seed: int) -> np.ndarray:
    """How many rows of each block go to each cell, as under a uniform permutation of all rows.

    Row sums are ``blocks``, column sums are ``cells``.  Each block draws from the places that are left: one
    hypergeometric draw per cell.
    """
    rng = np.random.default_rng(seed)
    out = np.zeros((len(blocks), len(cells)), np.int64)
    left = list(cells)
    for i, rows in enumerate(blocks):
        rest = sum(left)
        for j, places in enumerate(left):
            rest -= places
            taken = hypergeometric(places, rest, rows, rng) if rows else 0
            out[i, j] = taken
            left[j] -= taken
            rows -= taken
    return out


def equal_sizes(total: int, parts: int) -> list[int]:
    """Sizes that add up to ``total`` and differ by at most one."""
    return [total // parts + (i < total % parts) for i in range(parts)]


def _mix(column: str, salt: int) -> Column:
    return F.xxhash64(F.col(column), F.lit(salt))


def shuffle_into_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0, gapless in a shard), uniformly at random.

    Shard sizes differ by at most one.  Rows get a number once, in a stored table, so a repeated task sees the same
    rows and repeated or null values change nothing.  Numbers are dealt into source blocks; a block is permuted and cut
    into runs whose lengths the matrix gives; the runs of a cell are permuted again.  A shard is a sequence of cells
    of known sizes, so no task sorts more than a cell.  The matrix has at most MAX_BLOCKS by MAX_CELLS numbers (or
    by ``shards``, if that is more) whatever the input.  No rows in, no rows out.  Columns named as the two new
    ones are replaced.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    numbered, _ = store(rows.select(F.struct(*kept).alias("row"), F.monotonically_increasing_id().alias("uid")), "numbered")
    total = numbered.count()
    n_blocks = min(MAX_BLOCKS, max(8, -(-total // block_rows)))
    per_shard = max(1, min(MAX_CELLS // shards, -(-total // (shards * block_rows))))
    block = F.pmod(_mix("uid", seed), F.lit(n_blocks)).cast("int")
    sizes = dict(numbered.groupBy(block.alias("b")).count().collect())
    shard_sizes = equal_sizes(total, shards)
    cell_sizes = [c for s in shard_sizes for c in equal_sizes(s, per_shard)]
    matrix = communication_matrix([sizes.get(b, 0) for b in range(n_blocks)], cell_sizes, seed)
    first = np.concatenate([np.concatenate([[0], np.cumsum(equal_sizes(s, per_shard))[:-1]]) for s in shard_sizes])
    runs = _runs(spark, matrix, first, per_shard)
    local = Window.partitionBy("block").orderBy(_mix("uid", seed + 1), "uid")
    placed = numbered.withColumn("block", block).withColumn("at", F.row_number().over(local).cast("long") - 1)
    # a block's runs follow one another: the run of a row is the last that begins at or before it
    found = placed.join(F.broadcast(runs), "block")
    run = F.expr("element_at(filter(runs, r -> r.begin <= at), -1)")
    sent = found.select("row", "uid", run.alias("run")).select("row", "uid", "run.cell", "run.shard", "run.first")
    again = Window.partitionBy("cell").orderBy(_mix("uid", seed + 2), "uid")
    slot = F.col("first") + F.row_number().over(again) - 1
    return sent.select("row.*", "shard", slot.cast("long").alias("slot"))


def _runs(spark: SparkSession, matrix: np.ndarray, first: np.ndarray, per_shard: int) -> DataFrame:
    """(block, runs): where each block's run for each cell begins; as many numbers as the matrix has entries."""
    begin = np.cumsum(matrix, axis=1) - matrix
    data = [
        (b, [(int(begin[b, c]), c, c // per_shard, int(first[c])) for c in np.flatnonzero(matrix[b]).tolist()])
        for b in range(len(matrix))
    ]
    return spark.createDataFrame(data, "block int, runs array<struct<begin: long, cell: int, shard: int, first: long>>")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of (doc_id, text).

    ``size`` is the bytes of the text and 8, ``text_crc32`` its checksum (null text: empty); the law is ``rows``.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(docs["doc_id"], (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shuffle_into_shards(rows, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
