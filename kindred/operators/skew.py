"""Joins in which one key may hold a large share of all rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, functions as F

from kindred.config import LIMITS, Limits

# keys that may be called hot at the same time: what is broadcast, whatever the size of the tables
HOT_KEYS = 100_000


def join_hot(many: DataFrame, few: DataFrame, key: str, limits: Limits = LIMITS) -> DataFrame:
    """The inner join on ``key`` of rows of which a key may hold any number with rows of which it holds few.

    Rows of a key with more than ``limits.rows_per_key`` are dealt over several, by a hash of their other columns, and
    the rows of ``few`` with that key are repeated for each.  ``many`` is read up to three times: give a stored table.
    Rows alike in all columns stay together.  Null keys match nothing.
    """
    rows = many.count()
    per_key = max(limits.rows_per_key, ceil(rows / HOT_KEYS))
    if rows <= per_key:
        # the planner guesses results of a search as small as its queries; they are not
        return many.join(few.hint("merge"), key)
    counts = many.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > per_key)
    hot = F.broadcast(counts.select(key, F.ceil(F.col("_n") / per_key).cast("long").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    others = [F.col(name) for name in many.columns if name != key] or [F.col(key)]
    left = many.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*others), salts)).drop("_salts")
    right = few.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_salts")
    return left.join(right.hint("merge"), [key, "_salt"]).drop("_salt")
