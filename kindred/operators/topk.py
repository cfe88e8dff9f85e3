"""Ranked lists: (query_id, candidate_id, score, rank), rank 1 best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def rank_by(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """Number the rows of each key in ``order`` and keep the first k.

    Spark cuts every key to k rows before the shuffle, so a hot key never
    reaches one task whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def top_k(
    scored: DataFrame,
    k: int,
    query_id: str = "query_id",
    item_id: str = "candidate_id",
    score: str = "score",
) -> DataFrame:
    """The k best rows per query: higher score first, then by id."""
    return rank_by(scored, [query_id], [F.desc(score), F.asc(item_id)], k)


def drop_self(ranked: DataFrame, query_id: str = "query_id", item_id: str = "candidate_id") -> DataFrame:
    """remove the query product; done after ranking, so ranks keep its gap."""
    return ranked.where(F.col(query_id) != F.col(item_id))


def renumber(ranked: DataFrame, k: int, keys: list[str] | tuple = ("query_id",)) -> DataFrame:
    """Close the gaps in the ranks and keep the first k per query."""
    return rank_by(ranked.withColumnRenamed("rank", "_was"), list(keys), [F.asc("_was")], k).drop("_was")
