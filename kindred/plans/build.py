"""Offline build of a search index, and its rebuild after a purge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.config import TARGET_RECALL, TOP_N_BRANDS, TOP_N_COLORS
from kindred.functions import vectors as v
from kindred.functions.text import lexical_text
from kindred.operators.ann import CellIndex
from kindred.operators.attach import is_present
from kindred.operators.encode import StructuredEncoder, StructuredModel
from kindred.operators.lexical import build_lexical
from kindred.operators.proximity import GraphIndex
from kindred.operators.purge import kept_ids, purge, purged_ids
from kindred.sources.artifacts import SearchIndex, has_index, open_index, write_table
from kindred.sources.catalogue import duplicate_ids


def with_lexical_text(products: DataFrame) -> DataFrame:
    """(uniq_id, text): what a product is indexed and queried by in lexical search."""
    text = lexical_text(F.col("product_name"), F.col("brand"), F.col("categories"))
    return products.select("uniq_id", text.alias("text"))


def mode_vectors(vectors: DataFrame, mode: str) -> DataFrame:
    """(uniq_id, vector) of one search mode; image mode leaves out products without an image."""
    text, structured = F.col("text_vector"), F.col("structured")
    if mode == "text_structured":
        fused = v.fuse_two(text, structured)
    elif mode == "combined":
        fused = v.fuse_three(text, structured, F.col("image_vector"))
    elif mode == "image":
        vectors = vectors.where(is_present(F.col("image_vector")))
        fused = v.l2_normalize(F.col("image_vector"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return vectors.select("uniq_id", v.floats(fused).alias("vector"))


def build_index(
    products: DataFrame,
    text_vectors: DataFrame,
    path: str,
    image_vectors: DataFrame | None = None,
    top_n_brands: int = TOP_N_BRANDS,
    top_n_colors: int = TOP_N_COLORS,
    encoder: StructuredModel | None = None,
    purged: DataFrame | None = None,
    n_cells: int | None = None,
    cells: dict[str, CellIndex] | None = None,
    graph: bool = False,
) -> SearchIndex:
    """Write every table of an index.

    ``cells`` of another index of like products lend their centres and reach to this one, which then learns none.

    ``n_cells`` also writes each mode's vectors in so many k-means cells, for approximate search; about the square root of
    the number of products is a good number.  ``graph`` writes a proximity graph for each mode, the other approximate search.

    ``text_vectors`` is (uniq_id, text_vector), ``image_vectors`` (uniq_id,
    image_vector) with zero vectors, or no row, for missing images.  A fitted
    ``encoder`` is reused as it is.
    """
    spark = products.sparkSession
    products = write_table(products, f"{path}/products")
    twice = duplicate_ids(products).first()
    if twice:
        raise ValueError(f"id {twice['uniq_id']!r} occurs {twice['count']} times")
    if encoder is None:
        encoder = StructuredEncoder(top_n_brands, top_n_colors).fit(products)
    encoder.write(spark, f"{path}/encoder")

    _check_vectors(products, text_vectors, "text_vector", required=True)
    structured = encoder.transform(products).select("uniq_id", "structured")
    # spread by the join: what is made of this table takes as many tasks as it has files
    vectors = structured.join(text_vectors.hint("merge"), "uniq_id")
    if image_vectors is not None:
        dim = _check_vectors(products, image_vectors, "image_vector", required=False)
        zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
        vectors = vectors.join(image_vectors, "uniq_id", "left").withColumn(
            "image_vector", F.coalesce("image_vector", zero)
        )
    vectors = write_table(vectors, f"{path}/vectors")
    for mode in ("text_structured",) if image_vectors is None else ("text_structured", "image", "combined"):
        dense = write_table(mode_vectors(vectors, mode), f"{path}/dense/{mode}")
        if cells and mode in cells:
            around = dense.withColumnRenamed("uniq_id", "candidate_id")
            CellIndex.around(around, f"{path}/cells/{mode}", cells[mode].centers).reaching(f"{path}/cells/{mode}", cells[mode].reach)
        elif n_cells:
            CellIndex.build(dense, f"{path}/cells/{mode}", n_cells, item_id="uniq_id", target=TARGET_RECALL)
        if graph:
            GraphIndex.build(dense, f"{path}/graph/{mode}", item_id="uniq_id")
    build_lexical(with_lexical_text(products), f"{path}/lexical")
    if purged is not None:
        write_table(purged, f"{path}/purged")
    spark.range(1).write.mode("overwrite").parquet(f"{path}/complete")
    return open_index(spark, path)


def _check_vectors(products: DataFrame, vectors: DataFrame, name: str, required: bool) -> int:
    """The length of all vectors; an error for products without one (if ``required``), repeated ids and other lengths."""
    found = vectors.agg(F.min(F.size(name)).alias("least"), F.max(F.size(name)).alias("most"), F.count_if(F.col(name).isNull()).alias("nulls")).first()
    if found["nulls"] or found["least"] != found["most"]:
        raise ValueError(f"{name}: {found['nulls']} nulls, lengths from {found['least']} to {found['most']}")
    twice = duplicate_ids(vectors).first()
    if twice:
        raise ValueError(f"{name}: id {twice['uniq_id']!r} occurs {twice['count']} times")
    if required:
        without = products.join(vectors.select("uniq_id"), "uniq_id", "left_anti").select("uniq_id").orderBy("uniq_id")
        ids = [r["uniq_id"] for r in without.limit(10).collect()]
        if ids:
            raise ValueError(f"{name}: products without a vector, among them {', '.join(map(repr, ids))}")
    return found["most"] or 0


def purge_index(index: SearchIndex, path: str) -> SearchIndex:
    """a new index without the products that have no image; neither the encoder nor the cells are fitted again, a graph is."""
    kept = kept_ids(index.vectors)
    vectors = purge(index.vectors, kept)
    return build_index(
        purge(index.products, kept),
        vectors.select("uniq_id", "text_vector"),
        path,
        image_vectors=vectors.select("uniq_id", "image_vector"),
        encoder=index.encoder,
        purged=index.purged.unionByName(purged_ids(index.vectors)),
        cells=index.cells,
        graph=bool(index.graphs),
    )


def load_or_build(spark: SparkSession, path: str, build: Callable[[str], SearchIndex]) -> SearchIndex:
    """Open the index at ``path``, or build it there first."""
    if not has_index(spark, path):
        build(path)
    return open_index(spark, path)


def availability(index: SearchIndex) -> DataFrame:
    """Number of products and the search modes that can be used."""
    modes = F.array(*[F.lit(m) for m in index.modes])
    return index.products.agg(F.count(F.lit(1)).alias("products_indexed")).withColumn("available_modes", modes)
