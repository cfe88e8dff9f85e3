"""The raw catalogue (one JSON object per line) and its cleaned form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kindred.functions import clean as c

# Column names of the raw catalogue.
REQUIRED = (
    "uniq_id", "product_name", "brand", "sales_price", "weight", "rating",
    "parent___child_category__all", "medium", "meta_keywords", "delivery_type",
    "amazon_prime__y_or_n", "best_seller_tag__y_or_n",
)
COLOR_COLUMN = "colour"
DETAILS_COLUMN = "product_details__k_v_pairs"
OPTIONAL = (COLOR_COLUMN, "discount_percentage", "no__of_reviews")

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("uniq_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("sales_price", T.DoubleType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("categories", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("meta_keywords", T.StringType()),
        T.StructField("delivery_type", T.StringType()),
        T.StructField("is_prime", T.IntegerType()),
        T.StructField("is_bestseller", T.IntegerType()),
        T.StructField("color", T.StringType()),
        T.StructField("discount_percentage", T.DoubleType()),
        T.StructField("no_of_reviews", T.DoubleType()),
    ]
)


def raw_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the known columns that occur in at least one raw record.

    An explicit schema cannot tell an absent column from a null one, so the keys
    are looked for in the records: one scan, no schema inference over values.
    """
    known = [*REQUIRED, *OPTIONAL, DETAILS_COLUMN]
    lines = spark.read.text(path)
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    seen = lines.select(
        *[F.max(F.array_contains(keys, name).cast("int")).alias(name) for name in known]
    ).first()
    return [name for name in known if seen[name]]


def read_raw(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The raw catalogue with every column as the text of its JSON token.

    Reading text keeps ``200.00`` and ``999999999`` as written, and keeps each
    key-value field with the keys of its own record.  ``columns`` names the columns
    of the source and saves the scan that looks for them.
    """
    names = raw_columns(spark, path) if columns is None else columns
    missing = [name for name in REQUIRED if name not in names]
    if missing:
        raise ValueError(f"raw catalogue lacks the columns {missing}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.schema(schema).json(path)


def clean_columns(
    raw: DataFrame, strip_chars: str = "first", kv_nulls: str = "keep"
) -> list[Column]:
    """The projection that cleans ``raw``.

    ``kv_nulls="keep"`` leaves null categories, image URL and key-value colour as
    null; ``"default"`` turns them into ``unknown``, blank and ``unknown``.
    """
    if kv_nulls not in ("keep", "default"):
        raise ValueError(f"kv_nulls must be 'keep' or 'default', not {kv_nulls!r}")
    unknown, blank = ("unknown", "") if kv_nulls == "default" else (None, None)
    types = {f.name: f.dataType for f in raw.schema.fields}
    col = F.col

    def number(name: str) -> Column:
        return c.numeric(col(name), strip_chars)

    def optional_number(name: str) -> Column:
        return F.coalesce(number(name), F.lit(0.0)) if name in types else F.lit(0.0)

    category = "parent___child_category__all"
    if COLOR_COLUMN in types:
        color = c.plain_color(col(COLOR_COLUMN))
    elif DETAILS_COLUMN in types:
        color = c.kv_color(col(DETAILS_COLUMN), types[DETAILS_COLUMN], unknown)
    else:
        raise ValueError(f"raw catalogue needs {COLOR_COLUMN!r} or {DETAILS_COLUMN!r}")
    return [
        c.text_or(col("uniq_id"), "").alias("uniq_id"),
        c.text_or(col("product_name"), "").alias("product_name"),
        c.text_or(col("brand"), "Unknown").alias("brand"),
        number("sales_price").alias("sales_price"),
        c.below_sentinel(number("weight")).alias("weight"),
        number("rating").alias("rating"),
        c.category_keys(col(category), types[category], unknown).alias("categories"),
        c.first_url(col("medium"), blank).alias("image_url"),
        c.text_or(col("meta_keywords"), "").alias("meta_keywords"),
        c.text_or(col("delivery_type"), "unknown").alias("delivery_type"),
        c.yes_flag(col("amazon_prime__y_or_n")).alias("is_prime"),
        c.yes_flag(col("best_seller_tag__y_or_n")).alias("is_bestseller"),
        color.alias("color"),
        optional_number("discount_percentage").alias("discount_percentage"),
        optional_number("no__of_reviews").alias("no_of_reviews"),
    ]


def clean(raw: DataFrame, strip_chars: str = "first", kv_nulls: str = "keep") -> DataFrame:
    """P10: the clean catalogue, in one projection."""
    return raw.select(*clean_columns(raw, strip_chars, kv_nulls))


def load_and_clean(
    spark: SparkSession, path: str, columns: list[str] | None = None, **options
) -> DataFrame:
    """Read the raw catalogue and clean it."""
    return clean(read_raw(spark, path, columns), **options)


def duplicate_ids(products: DataFrame) -> DataFrame:
    """Ids that occur more than once; a catalogue must have none."""
    return products.groupBy("uniq_id").count().where("count > 1")


def product_card(products: DataFrame) -> DataFrame:
    """The public fields of a product, with NaN shown as null."""
    def value(name: str) -> Column:
        return F.when(~F.isnan(name), F.col(name)).alias(name)

    return products.select(
        "uniq_id", "product_name", "brand", value("sales_price"), value("rating"),
        "color", "categories", "image_url",
    )
