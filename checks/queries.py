"""The registered queries: each takes (spark, sf_dir) and reads the tables there."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from checks.catalogue import (
    TOP_N_BRANDS, TOP_N_COLORS, documents, own_path, product_vectors, products, raw_catalogue, search_index, table,
)
from kindred.config import HYBRID_MODES, MODES, Search
from kindred.functions import clean as c, text as t, vectors as v
from kindred.operators import profile
from kindred.operators.ann import CellIndex, ivf_topk, lsh_topk, widening_search
from kindred.operators.attach import attach_image_vectors, attach_text_vectors, count_present, hashed_text_vectors
from kindred.operators.dense import exact_topk
from kindred.operators.encode import NUMERIC, StructuredEncoder, StructuredModel
from kindred.operators.evaluate import jaccard_at_k, percentile_summary, recall_at_k
from kindred.operators.fusion import rrf
from kindred.operators.lexical import LexicalIndex, bm25_topk, build_lexical
from kindred.operators.purge import kept_ids, purge, purged_ids
from kindred.operators.proximity import GraphIndex, graph_topk
from kindred.operators.quantize import CodedIndex, Codebooks, coded_topk
from kindred.operators.sample import first_middle_last, seeded_sample
from kindred.plans import recommend as r
from kindred.plans.build import availability as index_availability, load_or_build, purge_index
from kindred.plans.compare import compare_engines
from kindred.plans.requests import answer, answer_detailed, product_lookup as lookup, request_status as status_of
from kindred.session import path_exists, scratch_path, stored
from kindred.sources.artifacts import SearchIndex, read_purged, write_measurements
from kindred.sources.catalogue import clean as clean_rows, load_and_clean, product_card as card

STRING = T.StringType()
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def rounded(value: Column | str, decimals: int = 6) -> Column:
    """Adding 0 turns a negative zero into zero."""
    return F.round(value, decimals) + F.lit(0.0)


def elements(df: DataFrame, vector: Column, key: str = "uniq_id") -> DataFrame:
    """One row per vector element, rounded."""
    return df.select(
        F.col(key).alias("uniq_id"), F.posexplode(vector.cast("array<double>")).alias("pos", "x")
    ).select("uniq_id", F.col("pos").cast("long").alias("pos"), rounded("x").alias("value"))


def fitted(spark: SparkSession, sf_dir: str):
    rows = products(spark, sf_dir)
    return rows, StructuredEncoder(TOP_N_BRANDS, TOP_N_COLORS).fit(rows)


def all_products(index: SearchIndex) -> DataFrame:
    return index.products.select(F.col("uniq_id").alias("query_id"))


def union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- cleaning and texts ------------------------------------------------------------------


@query
def clean_catalogue(spark, sf_dir):
    return products(spark, sf_dir)


@query
def clean_numeric(spark, sf_dir):
    weight = c.numeric(F.col("weight"))
    return raw_catalogue(spark, sf_dir).select(
        "uniq_id",
        c.numeric(F.col("sales_price")).alias("price_first"),
        c.numeric(F.col("sales_price"), "all").alias("price_all"),
        weight.alias("weight_raw"),
        c.below_sentinel(weight).alias("weight"),
        c.numeric(F.col("rating")).alias("rating"),
        c.numeric(F.col("discount_percentage")).alias("discount"),
        c.numeric(F.col("no__of_reviews")).alias("reviews"),
    )


@query
def clean_flags(spark, sf_dir):
    return raw_catalogue(spark, sf_dir).select(
        "uniq_id",
        c.yes_flag(F.col("amazon_prime__y_or_n")).alias("is_prime"),
        c.yes_flag(F.col("best_seller_tag__y_or_n")).alias("is_bestseller"),
    )


@query
def clean_color(spark, sf_dir):
    return raw_catalogue(spark, sf_dir).select(
        "uniq_id",
        c.plain_color(F.col("colour")).alias("color"),
        c.kv_color(F.col("product_details__k_v_pairs"), STRING).alias("kv_color"),
    )


@query
def clean_first_url(spark, sf_dir):
    return raw_catalogue(spark, sf_dir).select(
        "uniq_id", c.first_url(F.col("medium")).alias("image_url"), c.has_http_url(F.col("medium")).alias("fetchable")
    )


@query
def clean_category_keys(spark, sf_dir):
    own = raw_catalogue(spark, sf_dir).select(
        F.col("uniq_id").alias("id"), c.category_keys(F.col("parent___child_category__all"), STRING).alias("keys")
    )
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("id"),
        c.category_keys(F.col("props"), STRING).alias("keys"),
    )
    return own.unionByName(events)


@query
def embedding_text(spark, sf_dir):
    columns = [F.col(x) for x in ("product_name", "brand", "color", "categories", "meta_keywords")]
    return products(spark, sf_dir).select("uniq_id", t.embedding_text(*columns).alias("text"))


@query
def rerank_text(spark, sf_dir):
    return products(spark, sf_dir).select(
        "uniq_id", r.short_text().alias("short_text"), r.long_text().alias("long_text")
    )


@query
def audience_class(spark, sf_dir):
    own = products(spark, sf_dir).select(t.audience(F.col("categories"), F.col("product_name")).alias("audience"))
    docs = documents(spark, sf_dir).select(t.audience(F.col("lang"), F.col("text")).alias("audience"))
    return union([x.groupBy("audience").agg(F.count(F.lit(1)).alias("n")) for x in (own, docs)])


@query
def tokenize_counts(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", t.tokens(F.col("text")).alias("t"))
    return docs.select(
        "doc_id",
        F.size("t").alias("n_tokens"),
        F.size(F.array_distinct("t")).alias("n_distinct"),
        F.coalesce(F.array_max(F.transform("t", F.length)), F.lit(0)).alias("longest"),
    )


# --- fitted transforms and vectors -------------------------------------------------------


@query
def numeric_fit(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    numbers, _ = model.tables(spark)
    return numbers.select("feature", *[rounded(x).alias(x) for x in ("median", "minimum", "maximum")])


@query
def minmax_transform(spark, sf_dir):
    rows, model = fitted(spark, sf_dir)
    return rows.select("uniq_id", *[rounded(model.scaled(name)).alias(name) for name in NUMERIC])


@query
def topn_vocab(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    _, words = model.tables(spark)
    return words.select("feature", "value", F.col("position").cast("long").alias("position"))


@query
def rare_bucket(spark, sf_dir):
    rows, model = fitted(spark, sf_dir)
    return rows.select("uniq_id", model.bucketed("brand").alias("brand"), model.bucketed("color").alias("color"))


@query
def onehot_assemble(spark, sf_dir):
    rows, model = fitted(spark, sf_dir)
    return elements(rows, model.vector())


@query
def l2_normalize(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return elements(rows, v.l2_normalize(v.scale(F.col("embedding"), 3.0)), "vec_id")


def _groups(spark, sf_dir) -> DataFrame:
    rows, model = fitted(spark, sf_dir)
    structured = model.transform(rows).select("uniq_id", "structured")
    return structured.join(product_vectors(spark, sf_dir), "uniq_id")


@query
def fuse_two(spark, sf_dir):
    return elements(_groups(spark, sf_dir), v.fuse_two(F.col("text_vector"), F.col("structured")))


@query
def fuse_three(spark, sf_dir):
    fused = v.fuse_three(F.col("text_vector"), F.col("structured"), F.col("image_vector"))
    return elements(_groups(spark, sf_dir), fused)


@query
def vector_distances(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    first = rows.orderBy("vec_id").limit(1).first()["embedding"]
    other = F.array(*[F.lit(x) for x in first])
    return rows.select(
        "vec_id",
        rounded(v.dot(F.col("embedding"), other)).alias("dot"),
        rounded(v.squared_l2(F.col("embedding"), other)).alias("squared_l2"),
    )


@query
def vector_counts(spark, sf_dir):
    return count_present(product_vectors(spark, sf_dir), "image_vector")


@query
def text_vectors(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    made = hashed_text_vectors(docs, "text", 64)
    return made.select("doc_id", F.size("text_vector").alias("dim"), rounded(v.norm(F.col("text_vector")), 4).alias("norm"))


# --- search ------------------------------------------------------------------------------


def _knn(mode: str) -> Query:
    def run(spark, sf_dir):
        index = search_index(spark, sf_dir)
        return r.dense_candidates(all_products(index), index, mode, 10)

    return run


REGISTRY["knn_exact_text"] = _knn("text_structured")
REGISTRY["knn_exact_image"] = _knn("image")
REGISTRY["knn_exact_combined"] = _knn("combined")


@query
def knn_embeddings(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return exact_topk(rows, rows, 5, query_id="vec_id", item_id="vec_id")


@query
def knn_embeddings_bounded(spark, sf_dir):
    """Every hundredth vector against all, those made one to five times as long, by the plan of levels and bounds."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("candidate_id"), v.doubles(F.col("embedding")).alias("vector"))
    longer = rows.select("candidate_id", F.transform("vector", lambda x: x * (1 + F.col("candidate_id") % 5)).alias("vector"))
    queries = rows.where("candidate_id % 100 = 0").withColumnRenamed("candidate_id", "query_id")
    return exact_topk(queries, longer, 10, plan="bounded")


def _cells(spark, sf_dir, n_cells: int) -> tuple[DataFrame, CellIndex]:
    items = search_index(spark, sf_dir).dense["text_structured"]
    cells = CellIndex.build(items, scratch_path(spark, "cells"), n_cells, item_id="uniq_id")
    return items.select(F.col("uniq_id").alias("query_id"), "vector"), cells


@query
def encoder_roundtrip(spark, sf_dir):
    rows, model = fitted(spark, sf_dir)
    path = scratch_path(spark, "encoder")
    model.write(spark, path)
    return elements(StructuredModel.read(spark, path).transform(rows), F.col("structured"))


@query
def model_vectors(spark, sf_dir):
    """Vectors of a stand-in for a model: the length of the name, and that times 2 and plus 3; no name, no vector."""

    def load():
        def predict(names: np.ndarray) -> np.ndarray:
            n = np.array([len(x) for x in names], np.float32)
            return np.stack([n, 2 * n, n + 3], axis=1)

        return predict

    # a seventh of the products has no name here
    named = products(spark, sf_dir).select(
        "uniq_id", F.when(F.col("uniq_id").cast("long") % 7 != 0, F.col("product_name")).alias("name")
    )
    return elements(attach_text_vectors(named, "name", load, dim=3), F.col("text_vector"))


@query
def image_model_vectors(spark, sf_dir):
    """Image vectors of a stand-in for a model, from stored bytes: their number, 3, and their number modulo 5; no bytes, no vector."""

    def load():
        def predict(images: np.ndarray) -> np.ndarray:
            n = np.array([len(x) for x in images], np.float32)
            return np.stack([n, np.full_like(n, 3), n % 5], axis=1)

        return predict

    # a fifth of the products has no image here
    stored_bytes = products(spark, sf_dir).select(
        "uniq_id", F.when(F.col("uniq_id").cast("long") % 5 != 0, F.encode("product_name", "utf-8")).alias("content")
    )
    return elements(attach_image_vectors(stored_bytes, "content", load, dim=3), F.col("image_vector"))


@query
def clean_without_optional_columns(spark, sf_dir):
    """A raw catalogue that lacks colour, discounts and reviews: the colour comes from the details, the numbers are 0."""
    raw = raw_catalogue(spark, sf_dir).drop("colour", "discount_percentage", "no__of_reviews")
    return clean_rows(raw)


@query
def ndjson_catalogue(spark, sf_dir):
    """The raw catalogue written as JSON lines, read back and cleaned."""
    path = scratch_path(spark, "ndjson")
    raw_catalogue(spark, sf_dir).write.json(path)
    return load_and_clean(spark, path)


@query
def knn_ivf_all_cells(spark, sf_dir):
    queries, cells = _cells(spark, sf_dir, 8)
    return ivf_topk(queries, cells, 10, nprobe=cells.n_cells)


@query
def knn_ivf(spark, sf_dir):
    queries, cells = _cells(spark, sf_dir, 16)
    return ivf_topk(queries, cells, 10, nprobe=4)


@query
def knn_ivf_given_centers(spark, sf_dir):
    """Centres taken from the rows with the first ids, so that SQL can make the same cells and probe some of them."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("candidate_id"), F.col("embedding").alias("vector"))
    centers = np.array([r["vector"] for r in rows.where("candidate_id < 16").orderBy("candidate_id").collect()], dtype=float)
    cells = CellIndex.around(rows, scratch_path(spark, "given"), centers)
    return ivf_topk(rows.withColumnRenamed("candidate_id", "query_id"), cells, 10, nprobe=4)


@query
def knn_ivf_widened(spark, sf_dir):
    """Visits that start with one cell and stop only where no hit is possible: the rows of an exact search."""
    queries, cells = _cells(spark, sf_dir, 16)
    return widening_search(queries, cells, 10, nprobe=1, reach=None).found


@query
def knn_pq_given_codebooks(spark, sf_dir):
    """Codewords taken from the rows with the first ids: eight bytes a vector, fifty of all by codes, ten of them rescored."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("candidate_id"), F.col("embedding").alias("vector"))
    first = np.array([r["vector"] for r in rows.where("candidate_id < 16").orderBy("candidate_id").collect()], dtype=float)
    books = Codebooks(first.reshape(len(first), 8, -1).transpose(1, 0, 2), first.shape[1])
    index = CodedIndex.around(rows, scratch_path(spark, "coded"), np.zeros((1, first.shape[1])), books)
    return coded_topk(rows.withColumnRenamed("candidate_id", "query_id"), index, 10, nprobe=1, shortlist=50)


@query
def knn_graph(spark, sf_dir):
    """Every hundredth vector against all, on a graph learned by descent."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("candidate_id"), F.col("embedding").alias("vector"))
    graph = GraphIndex.build(rows, scratch_path(spark, "graph"))
    return graph_topk(rows.where("candidate_id % 100 = 0").withColumnRenamed("candidate_id", "query_id"), graph, 10).found


@query
def knn_graph_given_edges(spark, sf_dir):
    """Edges by a rule on the ids, so that SQL can go the same three hops from the same entries."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("candidate_id"), F.col("embedding").alias("vector"))
    to = F.explode(F.array(F.expr("3 * candidate_id + 1"), F.expr("candidate_id + 17"), F.expr("candidate_id div 2")))
    edges = rows.select("candidate_id", to.alias("neighbour")).join(rows.select(F.col("candidate_id").alias("neighbour")), "neighbour", "left_semi")
    graph = GraphIndex.around(rows, edges, rows.where("candidate_id < 8"))
    queries = rows.where("candidate_id % 100 = 0").withColumnRenamed("candidate_id", "query_id")
    return graph_topk(queries, graph, 10, beam=1000, hops=3).found


@query
def knn_lsh_candidates(spark, sf_dir):
    items = search_index(spark, sf_dir).dense["text_structured"]
    queries = items.select(F.col("uniq_id").alias("query_id"), "vector")
    dim = items.select(F.size("vector").alias("d")).first()["d"]
    return lsh_topk(queries, items.withColumnRenamed("uniq_id", "candidate_id"), 10, dim, 0.25, 4)


def document_index(spark, sf_dir) -> LexicalIndex:
    """Built by the first query of an application, opened by the others; the corpus numbers are written last."""
    path = own_path(spark, sf_dir, "documents")
    if not path_exists(spark, f"{path}/corpus/_SUCCESS"):
        build_lexical(documents(spark, sf_dir).select("doc_id", "text"), path, doc_id="doc_id")
    return LexicalIndex.read(spark, path)


@query
def corpus_stats(spark, sf_dir):
    return document_index(spark, sf_dir).terms.select("term", "df", rounded("idf").alias("idf"))


@query
def corpus_totals(spark, sf_dir):
    index = document_index(spark, sf_dir)
    return spark.createDataFrame([(index.n_docs, round(index.avgdl, 6))], "n_docs long, avgdl double")


@query
def bm25_topk_documents(spark, sf_dir):
    passages = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return bm25_topk(passages, document_index(spark, sf_dir), 10)


REGISTRY["bm25_topk"] = REGISTRY.pop("bm25_topk_documents")


@query
def bm25_catalogue(spark, sf_dir):
    index = search_index(spark, sf_dir)
    return r.lexical_candidates(all_products(index), index, 100)


@query
def rrf_fusion(spark, sf_dir):
    index = search_index(spark, sf_dir)
    everything = all_products(index)
    dense = r.dense_candidates(everything, index, "text_structured", 100)
    merged = rrf(dense, r.lexical_candidates(everything, index, 100))
    return merged.select(
        "query_id", "candidate_id", rounded("score", 9).alias("score"), "dense_rank", "sparse_rank", "rank"
    )


@query
def candidates_by_mode(spark, sf_dir):
    index = search_index(spark, sf_dir)
    return union(
        [
            r.candidates(all_products(index), index, mode).select(
                F.lit(mode).alias("mode"), "query_id", "candidate_id", rounded("score", 9).alias("score"), "rank"
            )
            for mode in MODES
        ]
    )


# --- recommendation and requests ---------------------------------------------------------


@query
def recommend_ids(spark, sf_dir):
    index = search_index(spark, sf_dir)
    return union(
        [r.recommend(all_products(index), index, 10, mode).withColumn("mode", F.lit(mode)) for mode in MODES]
    )


@query
def recommend_ivf_all_cells(spark, sf_dir):
    index = search_index(spark, sf_dir)
    return union(
        [
            r.recommend(all_products(index), index, 10, m, search=Search("ivf", index.cells[m].n_cells)).withColumn("mode", F.lit(m))
            for m in MODES
        ]
    )


@query
def recommend_detailed(spark, sf_dir):
    index = search_index(spark, sf_dir)
    return union(
        [
            r.recommend_detailed(all_products(index), index, 10, mode)
            .withColumn("mode", F.lit(mode))
            .withColumn("score", rounded("score", 9))
            for mode in MODES
        ]
    )


@query
def recommend_nested(spark, sf_dir):
    index = search_index(spark, sf_dir)
    return r.recommend_nested(all_products(index), index, 5, "image")


@query
def recommend_nested_rows(spark, sf_dir):
    """The nested answers of all modes, one row per similar product."""
    index = search_index(spark, sf_dir)
    return union(
        [
            r.recommend_nested(all_products(index), index, 5, mode).select(
                "mode", F.col("query_product.uniq_id").alias("query_id"), F.inline("similar_products")
            ).select(
                "mode", "query_id", "rank", F.col("uniq_id").alias("candidate_id"), rounded("similarity_score", 9).alias("score"),
                "product_name", "brand",
            )
            for mode in MODES
        ]
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event: frequent users repeat theirs, and some are invalid."""
    kind, user = F.col("event_type"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        (user * 7).cast("string").alias("product_id"),
        F.when((kind == "error") & (user % 5 == 0), 0)
        .when((kind == "signup") & (user % 9 == 0), 100_000_000)
        .otherwise(1 + user % 12)
        .alias("num_similar"),
        F.when(kind == "view", "text_structured")
        .when(kind == "click", "image")
        .when(kind == "purchase", "combined")
        .when(kind == "signup", "image")
        .otherwise("hybrid")
        .alias("mode"),
    )


@query
def request_status(spark, sf_dir):
    return status_of(requests(spark, sf_dir), search_index(spark, sf_dir))


@query
def request_answers(spark, sf_dir):
    return answer(requests(spark, sf_dir), search_index(spark, sf_dir))


@query
def request_counts(spark, sf_dir):
    """How many answers each valid request has; it must be as many as it asks for."""
    asked, index = requests(spark, sf_dir), search_index(spark, sf_dir)
    valid = status_of(asked, index).where("status = 200").select("request_id", "num_similar")
    rows = answer(asked, index).groupBy("request_id").agg(F.count("*").alias("n"))
    return valid.join(rows, "request_id", "left").select("request_id", "num_similar", F.coalesce("n", F.lit(0).cast("long")).alias("n_rows"))


@query
def request_counts_ivf(spark, sf_dir):
    """As ``request_counts`` by a search that starts with one of very uneven cells: around the mean, and around twelve products."""
    asked, index = requests(spark, sf_dir), search_index(spark, sf_dir)
    cells = {}
    for mode, dense in index.dense.items():
        rows = dense.select(F.col("uniq_id").alias("candidate_id"), "vector")
        first = rows.orderBy(F.length("candidate_id"), "candidate_id").limit(12).collect()
        single = np.array([r["vector"] for r in first], dtype=float)
        cells[mode] = CellIndex.around(rows, scratch_path(spark, f"uneven-{mode}"), np.vstack([single.mean(axis=0), 1.5 * single]))
    found = answer(asked, replace(index, cells=cells), search=Search("ivf", nprobe=1, reach=1.0))
    valid = status_of(asked, index).where("status = 200").select("request_id", "num_similar")
    rows = found.groupBy("request_id").agg(F.count("*").alias("n"))
    return valid.join(rows, "request_id", "left").select("request_id", "num_similar", F.coalesce("n", F.lit(0).cast("long")).alias("n_rows"))


@query
def request_details(spark, sf_dir):
    return answer_detailed(requests(spark, sf_dir), search_index(spark, sf_dir))


@query
def product_lookup(spark, sf_dir):
    return lookup(requests(spark, sf_dir), search_index(spark, sf_dir))


@query
def availability(spark, sf_dir):
    found = index_availability(search_index(spark, sf_dir))
    return found.withColumn("available_modes", F.array_join("available_modes", ","))


@query
def product_card(spark, sf_dir):
    return card(products(spark, sf_dir))


@query
def purge_missing_image(spark, sf_dir):
    return purge(products(spark, sf_dir), kept_ids(product_vectors(spark, sf_dir)))


REGISTRY["purged_ids"] = lambda spark, sf_dir: purged_ids(product_vectors(spark, sf_dir))


def purged_index(spark, sf_dir) -> SearchIndex:
    """The index after the purge of products without an image, its purged ids read from their file."""
    path = own_path(spark, sf_dir, "purged")
    index = load_or_build(spark, path, lambda p: purge_index(search_index(spark, sf_dir), p))
    return replace(index, purged=read_purged(spark, f"{path}/purged"))


@query
def purged_request_status(spark, sf_dir):
    return status_of(requests(spark, sf_dir), purged_index(spark, sf_dir))


@query
def purged_product_lookup(spark, sf_dir):
    return lookup(requests(spark, sf_dir), purged_index(spark, sf_dir))


# --- evaluation, profile, samples, artifacts ---------------------------------------------


REGISTRY["recall_at_k"] = lambda spark, sf_dir: recall_at_k(
    _knn("text_structured")(spark, sf_dir), _knn("combined")(spark, sf_dir), 10
)


@query
def cross_modal_jaccard(spark, sf_dir):
    index = search_index(spark, sf_dir)
    everything = all_products(index)
    lists = [r.recommend(everything, index, 10, mode) for mode in ("text_structured", "image")]
    return jaccard_at_k(everything, *lists, 10).withColumn("jaccard", rounded("jaccard", 9))


REGISTRY["percentile_summary"] = lambda spark, sf_dir: spark.createDataFrame(
    [tuple(round(x, 6) for x in percentile_summary(table(spark, sf_dir, "events"), "value").values())],
    "p50 double, p95 double, p99 double, mean double",
)


@query
def engine_comparison(spark, sf_dir):
    items = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("candidate_id"), F.col("embedding").alias("vector"))
    return compare_engines(items.withColumnRenamed("candidate_id", "query_id"), items)


@query
def profile_missing(spark, sf_dir):
    found = profile.missing_profile(raw_catalogue(spark, sf_dir))
    return found.select("column_name", rounded("pct_missing").alias("pct_missing"))


@query
def profile_top_values(spark, sf_dir):
    return profile.frequent_values(raw_catalogue(spark, sf_dir), "brand", 15)


@query
def profile_price(spark, sf_dir):
    return raw_catalogue(spark, sf_dir).select("uniq_id", c.profile_price(F.col("sales_price")).alias("price"))


@query
def profile_histogram(spark, sf_dir):
    unit_price = F.col("l_extendedprice") / F.col("l_quantity") / 10
    lines = table(spark, sf_dir, "lineitem").select(unit_price.alias("price"))
    found = profile.histogram(lines, "price")
    return found.select("bin", rounded("low").alias("low"), rounded("high").alias("high"), "n")


@query
def seeded_sample_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return seeded_sample(rows, 100, key="event_id")


REGISTRY["seeded_sample"] = REGISTRY.pop("seeded_sample_events")

REGISTRY["first_middle_last"] = lambda spark, sf_dir: first_middle_last(
    products(spark, sf_dir).select("uniq_id", "product_name")
)


@query
def measurements_roundtrip(spark, sf_dir):
    """Measurements of the events by type, written as JSON lines and read back."""
    path = scratch_path(spark, "measurements")
    by_type = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), rounded(F.avg("value")).alias("mean"), F.max("value").alias("most"))
    write_measurements(by_type, path)
    return spark.read.schema(by_type.schema).json(path)


@query
def artifact_roundtrip(spark, sf_dir):
    index = search_index(spark, sf_dir)
    sums = F.aggregate("structured", F.lit(0.0), lambda s, x: s + x)
    return index.products.join(index.vectors, "uniq_id").select(
        "uniq_id", "brand", "sales_price",
        rounded(sums, 4).alias("structured_sum"),
        rounded(v.dot(F.col("text_vector"), F.col("text_vector")), 4).alias("text_norm"),
    )
