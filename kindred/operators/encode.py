"""Structured features: fitted once on a catalogue, then applied to any product table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kindred.config import LIMITS, TOP_N_BRANDS, TOP_N_COLORS, Limits
from kindred.operators.quantiles import exact_median

# The order of the columns in the structured vector.
NUMERIC = ("sales_price", "rating", "discount_percentage", "no_of_reviews")
CATEGORICAL = ("brand", "color", "delivery_type")
BINARY = ("is_prime", "is_bestseller")
OTHER = "Other"

# A one-hot vector over more values than this is an input error unless the encoder is told otherwise.
MAX_VOCABULARY = 10_000

NUMERIC_SCHEMA = "feature string, median double, minimum double, maximum double"
VOCABULARY_SCHEMA = "feature string, value string, position int, top boolean"


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of the non-null values of several columns: (feature, value, n)."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(pairs).alias("p"))
        .where("p.value is not null")
        .groupBy("p.feature", "p.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_values(df: DataFrame, limits_per_column: dict[str, int]) -> DataFrame:
    """A4: the most frequent values per column; equal counts are ordered by value."""
    counts = value_counts(df, list(limits_per_column))
    keep = F.lit(None).cast("int")
    for name, n in limits_per_column.items():
        keep = F.when(F.col("feature") == name, F.lit(n)).otherwise(keep)
    by_count = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
    # the constant bound lets Spark cut each feature to it before the shuffle
    return (
        counts.withColumn("rank", F.row_number().over(by_count))
        .where(F.col("rank") <= max(limits_per_column.values()))
        .where(F.col("rank") <= keep)
    )


@dataclass
class StructuredEncoder:
    """Learns medians, ranges and vocabularies.

    ``max_vocabulary`` bounds the values of a one-hot feature, which come to the driver and widen every vector; more
    delivery types than that are an error, not cut off.
    """

    top_n_brands: int = TOP_N_BRANDS
    top_n_colors: int = TOP_N_COLORS
    limits: Limits = field(default=LIMITS)
    max_vocabulary: int = MAX_VOCABULARY

    def fit(self, products: DataFrame) -> "StructuredModel":
        medians = exact_median(products, list(NUMERIC), self.limits)
        ranges = products.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.min(F.when(~F.isnan(c), F.col(c))).alias(f"min_{c}") for c in NUMERIC],
            *[F.max(F.when(~F.isnan(c), F.col(c))).alias(f"max_{c}") for c in NUMERIC],
        ).first()
        wanted = {
            "brand": self.top_n_brands,
            "color": self.top_n_colors,
            "delivery_type": self.max_vocabulary + 1,
        }
        # bounded: at most the wanted number of values per feature
        kept = top_values(products, wanted).collect()
        numeric = {c: (medians[c], ranges[f"min_{c}"], ranges[f"max_{c}"]) for c in NUMERIC}
        vocabulary, top = {}, {}
        for name in CATEGORICAL:
            mine = [r for r in kept if r["feature"] == name]
            top[name] = {r["value"] for r in mine}
            covered = sum(r["n"] for r in mine)
            values = set(top[name])
            if covered < ranges["rows"]:
                # a product outside the top values, or without one, falls in the bucket
                values.add("None" if name == "delivery_type" else OTHER)
            if len(values) > self.max_vocabulary:
                raise ValueError(f"{name} has more than {self.max_vocabulary} values")
            vocabulary[name] = sorted(values)
        return StructuredModel(numeric, vocabulary, top)

    def fit_transform(self, products: DataFrame, output: str = "structured") -> DataFrame:
        return self.fit(products).transform(products, output)


@dataclass(frozen=True)
class StructuredModel:
    """A10: the fitted state, and the expressions that apply it."""

    numeric: dict[str, tuple[float, float, float]]
    vocabulary: dict[str, list[str]]
    top: dict[str, set[str]]

    @property
    def dim(self) -> int:
        return len(NUMERIC) + sum(len(v) for v in self.vocabulary.values()) + len(BINARY)

    def filled(self, name: str) -> Column:
        """A2: the number, with null and NaN replaced by the fitted median."""
        c = F.col(name).cast("double")
        return F.coalesce(F.when(~F.isnan(c), c), F.lit(self.numeric[name][0]).cast("double"))

    def scaled(self, name: str) -> Column:
        """A3: min-max scaled number; a constant column gives 0, nothing is clipped."""
        _, low, high = self.numeric[name]
        if low is None:
            return F.lit(0.0)
        width = (high - low) or 1.0
        return (self.filled(name) - F.lit(low)) / F.lit(width)

    def bucketed(self, name: str) -> Column:
        """A5: the value itself when it is a frequent one, else ``Other``."""
        c = F.col(name).cast("string")
        if name == "delivery_type":
            return F.coalesce(c, F.lit("None"))
        return F.when(c.isin(sorted(self.top[name])), c).otherwise(F.lit(OTHER))

    def one_hot(self, name: str) -> Column:
        """One-hot array over the fitted values; an unseen value gives zeros."""
        values = self.vocabulary[name]
        n = len(values)
        if not n:
            return F.array().cast("array<float>")
        zero, one = F.lit(0.0).cast("float"), F.lit(1.0).cast("float")
        at = F.array_position(F.array(*[F.lit(v) for v in values]), self.bucketed(name)).cast("int")
        return F.when(at == 0, F.array_repeat(zero, n)).otherwise(
            F.concat(F.array_repeat(zero, at - 1), F.array(one), F.array_repeat(zero, F.lit(n) - at))
        )

    def vector(self) -> Column:
        """Numbers, one-hot groups and flags in fixed order, as float."""
        numbers = F.array(*[self.scaled(c).cast("float") for c in NUMERIC])
        flags = F.array(*[F.col(c).cast("float") for c in BINARY])
        return F.concat(numbers, *[self.one_hot(c) for c in CATEGORICAL], flags)

    def transform(self, products: DataFrame, output: str = "structured") -> DataFrame:
        return products.withColumn(output, self.vector())

    # The fitted state as two small tables

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        numbers = [(name, *values) for name, values in self.numeric.items()]
        words = [
            (name, value, i, value in self.top[name])
            for name, values in self.vocabulary.items()
            for i, value in enumerate(values)
        ]
        return (
            spark.createDataFrame(numbers, NUMERIC_SCHEMA),
            spark.createDataFrame(words, VOCABULARY_SCHEMA),
        )

    def write(self, spark: SparkSession, path: str) -> None:
        numbers, words = self.tables(spark)
        numbers.coalesce(1).write.mode("overwrite").parquet(f"{path}/numeric")
        words.coalesce(1).write.mode("overwrite").parquet(f"{path}/vocabulary")

    @staticmethod
    def read(spark: SparkSession, path: str) -> "StructuredModel":
        numbers = spark.read.parquet(f"{path}/numeric").collect()
        words = spark.read.parquet(f"{path}/vocabulary").orderBy("feature", "position").collect()
        numeric = {r["feature"]: (r["median"], r["minimum"], r["maximum"]) for r in numbers}
        vocabulary = {c: [r["value"] for r in words if r["feature"] == c] for c in CATEGORICAL}
        top = {c: {r["value"] for r in words if r["feature"] == c and r["top"]} for c in CATEGORICAL}
        return StructuredModel(numeric, vocabulary, top)
