"""Agreement between ranked lists and summaries of measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.operators.quantiles import exact_quantiles


def recall_at_k(approximate: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """Per query of ``exact``, the share of its k best that ``approximate`` has among its k best."""
    truth = exact.where(F.col("rank") <= k).select("query_id", "candidate_id")
    found = approximate.where(F.col("rank") <= k).select("query_id", "candidate_id", F.lit(1).alias("hit"))
    return (
        truth.join(found, ["query_id", "candidate_id"], "left")
        .groupBy("query_id")
        .agg((F.count("hit") / F.lit(float(k))).alias("recall"))
    )


def jaccard_at_k(queries: DataFrame, left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """Per query, shared over all candidates of two top-k lists; 0 when both are empty."""
    sides = (
        left.where(F.col("rank") <= k)
        .select("query_id", "candidate_id")
        .unionByName(right.where(F.col("rank") <= k).select("query_id", "candidate_id"))
    )
    # a candidate of both lists occurs twice, one of a single list once
    seen = sides.groupBy("query_id", "candidate_id").agg(F.count(F.lit(1)).alias("lists"))
    overlap = seen.groupBy("query_id").agg(
        (F.count_if(F.col("lists") == 2) / F.count(F.lit(1))).alias("jaccard")
    )
    return queries.select("query_id").join(overlap, "query_id", "left").select(
        "query_id", F.coalesce("jaccard", F.lit(0.0)).alias("jaccard")
    )


def percentile_summary(df: DataFrame, column: str) -> dict[str, float | None]:
    """Exact p50, p95 and p99, and the mean."""
    p50, p95, p99 = exact_quantiles(df, [column], [0.5, 0.95, 0.99])[column]
    return {"p50": p50, "p95": p95, "p99": p99, "mean": df.agg(F.avg(column)).first()[0]}
