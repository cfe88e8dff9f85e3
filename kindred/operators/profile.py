"""Profile of the raw data: missing values, frequent values, price histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.operators.encode import top_values


def missing_profile(df: DataFrame) -> DataFrame:
    """Percentage of nulls per column, only columns that have any, highest first."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("pct_missing")) for c in df.columns])
    return (
        shares.select(F.inline(pairs))
        .where("pct_missing > 0")
        .orderBy(F.desc("pct_missing"), "column_name")
    )


def frequent_values(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """The n most frequent values of a column; equal counts are ordered by value."""
    return top_values(df, {column: n}).select("value", "n").orderBy(F.desc("n"), "value")


def histogram(df: DataFrame, column: str, below: float = 500.0, bins: int = 50) -> DataFrame:
    """Counts in equal bins over the observed range of the values under ``below``.

    The last bin includes its upper edge.  Empty bins are listed with count 0.
    """
    values = df.where((F.col(column) < below) & ~F.isnan(column)).select(F.col(column).alias("v"))
    ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    spark = df.sparkSession
    low, high = ends["low"], ends["high"]
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, n long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counted = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(low) + F.col("id") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("id") + 1) * F.lit(width)).alias("high"),
    )
    return edges.join(counted, "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))
