"""Purge of products without an image vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.operators.attach import is_present

DEAD_IMAGE = "dead image link"


def kept_ids(vectors: DataFrame, image: str = "image_vector", epsilon: float = 1e-5) -> DataFrame:
    return vectors.where(is_present(F.col(image), epsilon)).select("uniq_id")


def purged_ids(vectors: DataFrame, image: str = "image_vector", epsilon: float = 1e-5) -> DataFrame:
    """(uniq_id, reason) of the products to purge."""
    dead = vectors.where(~is_present(F.col(image), epsilon))
    return dead.select("uniq_id", F.lit(DEAD_IMAGE).alias("reason"))


def purge(table: DataFrame, kept: DataFrame) -> DataFrame:
    """the rows of an aligned table whose product is kept."""
    return table.join(kept, "uniq_id", "left_semi")
