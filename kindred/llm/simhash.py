"""SimHash fingerprints and near-duplicate groups by deletion-variant signatures."""

from __future__ import annotations

import uuid
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kindred.llm.common import map_slices, store, text_bytes
from kindred.llm.graph import components

SHINGLE = 3
SEED = 42
BITS = 64


def fingerprints(texts: list[bytes | None], words: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The 64-bit fingerprint of each text as signed integers: a bit is set if over half the shingle hashes set it."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for at, text in enumerate(texts):
        split = (text or b"").lower().split()
        if not split:
            continue
        line = b" ".join(split)
        if len(split) <= words:
            hashes.append(digest(line, seed))
            counts[at] = 1
            continue
        starts = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1)
        ends = (starts[words - 1 :] - 1).tolist()
        begin = [0, *starts[: len(ends) - 1].tolist()]
        hashes += [digest(line[a:b], seed) for a, b in zip(begin, ends, strict=True)]
        counts[at] = len(ends)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        raw = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        first = (np.cumsum(counts) - counts)[full]
        sums = np.empty((len(full), BITS), np.int64)
        for byte in range(8):
            bits = np.unpackbits(raw[:, byte : byte + 1], axis=1)
            sums[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        set_bits = 2 * sums > counts[full, None]
        out[full] = np.packbits(set_bits, axis=1).view(">u8").ravel()
    return out.view(np.int64)


def fingerprint_rows(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; null and empty texts have fingerprint zero.

    ``text_hash`` tells rows with equal ids and different texts apart.
    """

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = fingerprints(text_bytes(batch), words, seed)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(got)], names=["doc_id", "text_hash", "fp"])

    cut = docs.select(docs["doc_id"].cast("long"), F.xxhash64("text").alias("text_hash"), docs["text"].cast("string"))
    return map_slices(cut, "text", "doc_id long, text_hash long, fp long", kernel)


HALF = BITS // 2
LOW = (1 << HALF) - 1
# fingerprints that may share a signature and be compared pair by pair
PAIRWISE = 512


def signatures(fps: DataFrame) -> DataFrame:
    """(key, fp): both halves of each fingerprint whole, and with each single bit deleted.

    Two fingerprints that differ in at most three bits differ in at most one bit of one half, and so share a key.
    A key holds which half (bit 38), which bit is deleted (bits 32 to 37, from 1; 0: none) and the half's other bits.
    """
    keys = []
    for half in (0, 1):
        part = F.shiftrightunsigned("fp", HALF * half).bitwiseAND(F.lit(LOW))
        for deleted in range(HALF + 1):
            kept = part if not deleted else part.bitwiseAND(F.lit(LOW & ~(1 << (deleted - 1))))
            keys.append(kept.bitwiseOR(F.lit(half << 38 | deleted << 32).cast("long")))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def near_pairs(fps: DataFrame, distance: int = 2, pairwise: int = PAIRWISE) -> DataFrame:
    """Links (a, b) that connect all pairs of distinct fingerprints (column fp) within ``distance`` (1 to 3) bits.

    Fingerprints meet by equality of a signature.  Up to ``pairwise`` that share one are compared by the join's
    condition.  Where more share one, bits of the other half are deleted as well, as many as may still differ: those
    who agree then are all within the distance, at most 2^distance of them, and need only a link to the first.
    So no links are lost and work stays linear in the size of a group.
    """
    if not 1 <= distance <= 3:
        raise ValueError("two halves cover distances from 1 to 3")
    keyed = signatures(fps)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # few signatures are shared; those are stored and all else works on them.  The planner guesses signatures as small as
    # the fingerprints that they are exploded from, and stored links and signatures as small as their files: hints keep
    # all these joins from being broadcast
    met, _ = store(keyed.join(shared.hint("merge"), "key"), "signatures")
    few = met.where(F.col("n") <= pairwise)
    near = F.expr("a.key = b.key and a.fp < b.fp") & (F.bit_count(F.expr("a.fp ^ b.fp")) <= distance)
    pairs = few.alias("a").join(few.alias("b").hint("merge"), near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    many = met.where(F.col("n") > pairwise)
    whole = F.expr("(key >> 32) % 64 = 0")
    cliques = _cliques(many.where(whole), distance).union(_cliques(many.where(~whole), distance - 1))
    return pairs.union(cliques).distinct()


def _cliques(many: DataFrame, further: int) -> DataFrame:
    """Links among fingerprints that share a key and differ in at most ``further`` bits of the half that is not in it."""
    masks = [sum(1 << b for b in bits) for bits in combinations(range(HALF), further)]
    mask = F.explode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("mask")
    # the key's half is in the key; the other half loses the bits of the mask
    other = F.expr("shiftrightunsigned(fp, cast(32 * (1 - (key >> 38)) as int)) & 4294967295")
    return (
        many.select("key", "fp", mask)
        .groupBy("key", "mask", other.bitwiseAND(F.bitwise_not(F.col("mask"))).alias("rest"))
        .agg(F.sort_array(F.collect_set("fp")).alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 1 << 30)).alias("b"))
    )


def near_duplicates(docs: DataFrame, distance: int = 2, words: int = SHINGLE, seed: int = SEED, pairwise: int = PAIRWISE) -> DataFrame:
    """(doc_id, text_hash, fp, group_id, component_id) for every row of (doc_id, text).

    ``group_id`` is the smallest fingerprint of a group of rows linked by chains of near fingerprints.
    ``component_id`` is the smallest doc_id reached over links of at most ``distance`` differing bits, itself
    included; null only if no row there has an id.  Null and empty texts share fingerprint zero and link like others.
    Repeated rows stay rows.  Other columns are ignored; no rows in, no rows out.
    """
    rows, _ = store(fingerprint_rows(docs, words, seed), "fingerprints")
    fps, _ = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(near_pairs(fps.select("fp"), distance, pairwise))
    rooted = fps.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least.hint("merge"), "root").select("fp", F.col("root").alias("group_id"), "component_id")
    return rows.join(named.hint("merge"), "fp").select("doc_id", "text_hash", "fp", "group_id", "component_id")


def keep_one(docs: DataFrame, **options: int) -> DataFrame:
    """One row of each near-duplicate group of (doc_id, text, ...), with all its columns.

    It is the row with the group's smallest doc_id, and of rows with that id the one with the smallest text hash and
    fingerprint; groups in which no row has an id keep one row without.  Of wholly repeated rows one stays.
    """
    return keep_first(docs, near_duplicates(docs, **options))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The first row of ``docs`` of each group in ``found`` (doc_id, text_hash, group_id), in the order of ``keep_one``."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy("group_id").agg(first)
    # names that no column of docs can have
    tag = uuid.uuid4().hex
    own_id, own_hash, row_hash = f"id_{tag}", f"hash_{tag}", f"row_{tag}"
    keys = kept.select(F.col("first.doc_id").alias(own_id), F.col("first.text_hash").alias(own_hash))
    hashed = docs.withColumn(row_hash, F.xxhash64("text"))
    same = F.col(own_id).eqNullSafe(F.col("doc_id").cast("long")) & (F.col(own_hash) == F.col(row_hash))
    one = hashed.join(keys.hint("merge"), same, "left_semi").dropDuplicates(["doc_id", row_hash])
    return one.select(*docs.columns)
