"""Tables of a built search index, all Parquet below one folder.

    products/        clean catalogue (S2)
    vectors/         uniq_id and its structured, text and image vector (S3)
    encoder/         fitted encoder state (S4)
    lexical/         BM25 postings and statistics (S5)
    dense/<mode>/    uniq_id and its fused vector per search mode (S6)
    cells/<mode>/    the same in k-means cells, for approximate search (S6)
    graph/<mode>/    the different ones, their neighbours and copies, for search on a graph (S6)
    purged/          uniq_id and reason of purged products (S8)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kindred.config import MODES
from kindred.operators.ann import CellIndex
from kindred.operators.encode import StructuredModel
from kindred.operators.lexical import LexicalIndex
from kindred.operators.proximity import GraphIndex
from kindred.session import path_exists

PURGED_SCHEMA = "uniq_id string, reason string"


@dataclass(frozen=True)
class SearchIndex:
    """Everything a search needs, opened lazily from its folder."""

    products: DataFrame
    vectors: DataFrame
    dense: dict[str, DataFrame]
    lexical: LexicalIndex | None
    encoder: StructuredModel
    purged: DataFrame
    cells: dict[str, CellIndex]
    graphs: dict[str, GraphIndex]

    @property
    def modes(self) -> list[str]:
        return [m for m in MODES if m in self.dense]


def write_table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def has_index(spark: SparkSession, path: str) -> bool:
    """Whether a complete index lies at ``path``; the marker is written last."""
    return path_exists(spark, f"{path}/complete")


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    """Open the tables below ``path``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}")

    return SearchIndex(
        products=table("products"),
        vectors=table("vectors"),
        dense={m: table(f"dense/{m}") for m in MODES if path_exists(spark, f"{path}/dense/{m}")},
        lexical=LexicalIndex.read(spark, f"{path}/lexical")
        if path_exists(spark, f"{path}/lexical/corpus")
        else None,
        encoder=StructuredModel.read(spark, f"{path}/encoder"),
        purged=table("purged")
        if path_exists(spark, f"{path}/purged")
        else spark.createDataFrame([], PURGED_SCHEMA),
        cells={
            m: CellIndex.read(spark, f"{path}/cells/{m}") for m in MODES if path_exists(spark, f"{path}/cells/{m}/centers")
        },
        # copies are written first, entries last
        graphs={m: GraphIndex.read(spark, f"{path}/graph/{m}") for m in MODES if path_exists(spark, f"{path}/graph/{m}/entries")},
    )


def write_measurements(df: DataFrame, path: str) -> None:
    """Measurements as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_purged(spark: SparkSession, path: str) -> DataFrame:
    """Purged ids and reasons."""
    return spark.read.schema(PURGED_SCHEMA).parquet(path)
