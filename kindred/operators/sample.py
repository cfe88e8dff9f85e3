"""Reproducible samples and single rows by position."""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import DataFrame, functions as F

from kindred.config import LIMITS, Limits
from kindred.session import stored


def seeded_sample(df: DataFrame, n: int, key: str = "uniq_id", seed: int = 42) -> DataFrame:
    """N rows without replacement, the same ones however the data is partitioned."""
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("_ticket", ticket).orderBy("_ticket", key).limit(n).drop("_ticket")


def nth_id(df: DataFrame, position: int, key: str = "uniq_id", limits: Limits = LIMITS) -> str | None:
    """The id at a 0-based position in ascending order, without sorting the table.

    Counts per leading characters say which prefix holds the position; it starts from
    the one that all ids share and grows until few enough ids share it.  The ids are
    read from ``df`` once.
    """
    ids = stored(df.select(F.col(key).cast("string").alias("id")).where("id is not null"), "ids")
    ends = ids.agg(F.min("id").alias("low"), F.max("id").alias("high")).first()
    # what the least and the greatest id share, all ids between them do
    prefix, left = commonprefix([ends["low"] or "", ends["high"] or ""]), position
    while True:
        inside = ids.where(F.startswith("id", F.lit(prefix)))
        step = F.substring("id", len(prefix) + 1, 1)
        counts = sorted(
            (r["step"], r["n"]) for r in inside.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
        )
        total = sum(n for _, n in counts)
        if left >= total:
            return None
        if total <= limits.collect_values:
            return inside.orderBy("id").offset(left).limit(1).first()["id"]
        for char, n in counts:
            if left < n:
                break
            left -= n
        if char == "":
            return prefix
        prefix += char


def first_middle_last(df: DataFrame, key: str = "uniq_id", limits: Limits = LIMITS) -> DataFrame:
    """The rows at positions 0, n/2 and n-1 in id order."""
    ends = df.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    if not ends["n"]:
        return df.limit(0)
    wanted = {ends["low"], ends["high"], nth_id(df, ends["n"] // 2, key, limits)}
    return df.where(F.col(key).isin(sorted(wanted)))
