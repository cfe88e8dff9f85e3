"""Two-stage recommendation for a table of query products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kindred.config import CANDIDATE_DEPTH, EXACT, HYBRID_MODES, LIMITS, RERANK_DEPTH, Limits, Search
from kindred.functions.text import long_pair_text, short_pair_text
from kindred.operators.ann import widening_search
from kindred.operators.dense import exact_topk
from kindred.operators.fusion import rrf
from kindred.operators.lexical import bm25_topk
from kindred.operators.proximity import graph_topk
from kindred.operators.rerank import TOKEN_OVERLAP, PairScorer, rerank
from kindred.operators.skew import join_hot
from kindred.operators.topk import drop_self, renumber
from kindred.plans.build import with_lexical_text
from kindred.session import stored
from kindred.sources.artifacts import SearchIndex

SCORE_KINDS = {"text_structured": "pair", "combined": "pair", "image": "cosine"}


def depth_for(n: int) -> int:
    """Candidates to fetch so that n are left when the query itself is among them."""
    return max(CANDIDATE_DEPTH, n + 1)


def dense_candidates(
    queries: DataFrame, index: SearchIndex, mode: str, depth: int, limits: Limits = LIMITS, search: Search = EXACT
) -> DataFrame:
    """Ranked dense neighbours of the query products, the products themselves included.

    Approximate lists are as long as exact ones.
    """
    if mode not in index.dense:
        raise ValueError(f"mode {mode!r} is not available: {index.modes}")
    items = index.dense[mode]
    asked = items.join(queries.select(F.col("query_id").alias("uniq_id")), "uniq_id", "left_semi")
    if search.kind == "ivf":
        if mode not in index.cells:
            raise ValueError(f"the index has no cells for mode {mode!r}: build it with n_cells")
        asked = asked.select(F.col("uniq_id").alias("query_id"), "vector")
        cells = index.cells[mode]
        reach = cells.reach if search.reach == "calibrated" else search.reach
        return widening_search(asked, cells, depth, search.nprobe, reach, limits=limits).found
    if search.kind == "graph":
        if mode not in index.graphs:
            raise ValueError(f"the index has no graph for mode {mode!r}: build it with graph=True")
        asked = asked.select(F.col("uniq_id").alias("query_id"), "vector")
        return graph_topk(asked, index.graphs[mode], depth, search.beam, limits=limits).found
    return exact_topk(asked, items, depth, query_id="uniq_id", item_id="uniq_id", limits=limits)


def lexical_candidates(
    queries: DataFrame, index: SearchIndex, depth: int, limits: Limits = LIMITS
) -> DataFrame:
    """Ranked BM25 matches of the texts of the query products."""
    ids = queries.select(F.col("query_id").alias("uniq_id"))
    texts = with_lexical_text(index.products.join(ids, "uniq_id", "left_semi"))
    return bm25_topk(texts, index.lexical, depth, query_id="uniq_id", limits=limits)


def candidates(
    queries: DataFrame,
    index: SearchIndex,
    mode: str,
    depth: int = CANDIDATE_DEPTH,
    limits: Limits = LIMITS,
    first: int | None = None,
    search: Search = EXACT,
    sparse: DataFrame | None = None,
) -> DataFrame:
    """(query_id, candidate_id, score, rank), the query product dropped, ranks closed.

    Hybrid modes fuse dense and lexical lists and give the fused score; image mode
    gives the cosine.  Where ``queries`` has a column ``depth``, none above
    ``depth``, each query uses lists of its own depth, and the result has that
    column too.  ``first`` says that only so many per query will be used; ``sparse``
    gives lexical lists of these queries, and perhaps others, that were made before.
    """
    keys = [name for name in ("query_id", "depth") if name in queries.columns]

    def cut(ranked: DataFrame) -> DataFrame:
        if "depth" not in keys:
            return ranked
        return ranked.join(queries.select(*keys), "query_id").where(F.col("rank") <= F.col("depth"))

    hybrid = mode in HYBRID_MODES and index.lexical is not None
    if first is not None and not hybrid and search.kind == "exact":
        # the head of an exact list is the exact list of that length; the query product may be in it
        depth = min(depth, first + 1)
    ranked = cut(dense_candidates(queries, index, mode, depth, limits, search))
    if hybrid:
        sparse = cut(lexical_candidates(queries, index, depth, limits) if sparse is None else sparse)
        # one more than wanted, as the query product may be among them; the bound on
        # fused scores needs dense lists at least that long
        keep = None if first is None else min(first + 1, depth)
        if keep is not None and (search.kind != "exact" or index.dense[mode].count() < keep):
            keep = None
        ranked = rrf(ranked, sparse, depth=depth, keys=keys, keep=keep)
        if "depth" in keys:
            ranked = ranked.where(F.col("rank") <= F.col("depth"))
    return renumber(drop_self(ranked.select(*keys, "candidate_id", "score", "rank")), depth, keys)


def with_texts(
    pairs: DataFrame, products: DataFrame, text: Column, scorer: PairScorer, limits: Limits = LIMITS
) -> DataFrame:
    """Pairs with the texts of both products, prepared for the scorer; a product may be the candidate of very many."""
    texts = products.select("uniq_id", scorer.prepare(text).alias("text"))
    left = texts.withColumnsRenamed({"uniq_id": "query_id", "text": "query_text"})
    right = texts.withColumnsRenamed({"uniq_id": "candidate_id", "text": "candidate_text"})
    return join_hot(stored(pairs, "pairs"), right, "candidate_id", limits).join(left, "query_id")


def short_text() -> Column:
    return short_pair_text(F.col("product_name"), F.col("brand"), F.col("categories"))


def long_text() -> Column:
    return long_pair_text(F.col("product_name"), F.col("brand"), F.col("color"), F.col("categories"))


def _stage_two(
    queries: DataFrame,
    index: SearchIndex,
    n: int,
    mode: str,
    text: Column,
    scorer: PairScorer,
    limits: Limits,
    search: Search,
) -> DataFrame:
    used = max(RERANK_DEPTH, n) if mode in HYBRID_MODES else n
    found = candidates(queries, index, mode, depth_for(n), limits, first=used, search=search)
    first = found.where(F.col("rank") <= used)
    if mode not in HYBRID_MODES:
        return first
    first = first.drop("score")
    return rerank(with_texts(first, index.products, text, scorer, limits), n, scorer)


def recommend(
    queries: DataFrame,
    index: SearchIndex,
    n: int,
    mode: str = "text_structured",
    scorer: PairScorer = TOKEN_OVERLAP,
    limits: Limits = LIMITS,
    search: Search = EXACT,
) -> DataFrame:
    """The n most similar products per query: (query_id, rank, candidate_id).

    Query ids that are not in the catalogue give no rows; ``requests.answer``
    reports them.
    """
    ranked = _stage_two(queries, index, n, mode, short_text(), scorer, limits, search)
    return ranked.select("query_id", "rank", "candidate_id")


def recommend_detailed(
    queries: DataFrame,
    index: SearchIndex,
    n: int = CANDIDATE_DEPTH,
    mode: str = "text_structured",
    scorer: PairScorer = TOKEN_OVERLAP,
    limits: Limits = LIMITS,
    search: Search = EXACT,
) -> DataFrame:
    """Scored candidates with their product fields.

    ``score`` is higher-is-better in every mode; ``score_kind`` says whether it is
    a pair score or a cosine.
    """
    ranked = _stage_two(queries, index, n, mode, long_text(), scorer, limits, search)
    fields = index.products.select(
        F.col("uniq_id").alias("candidate_id"), "product_name", "brand", "sales_price", "rating", "image_url"
    )
    return join_hot(stored(ranked, "ranked"), fields, "candidate_id", limits).select(
        "query_id", "rank", "candidate_id", "score", F.lit(SCORE_KINDS[mode]).alias("score_kind"),
        "product_name", "brand", "sales_price", "rating", "image_url",
    )


def recommend_nested(
    queries: DataFrame, index: SearchIndex, n: int = 10, mode: str = "text_structured", **options
) -> DataFrame:
    """One row per query: query_product, similar_products (best first), mode."""
    detailed = recommend_detailed(queries, index, n, mode, **options)
    hit = F.struct(
        "rank",
        F.col("candidate_id").alias("uniq_id"),
        F.col("score").alias("similarity_score"),
        "product_name", "brand", "sales_price", "rating", "image_url",
    )
    lists = detailed.groupBy("query_id").agg(F.array_sort(F.collect_list(hit)).alias("similar_products"))
    asked = index.products.join(
        queries.select(F.col("query_id").alias("uniq_id")), "uniq_id", "left_semi"
    ).select(
        F.col("uniq_id").alias("query_id"),
        F.struct("uniq_id", "product_name", "brand", "sales_price", "image_url").alias("query_product"),
    )
    empty = F.array().cast(lists.schema["similar_products"].dataType)
    return asked.join(lists, "query_id", "left").select(
        "query_product", F.coalesce("similar_products", empty).alias("similar_products"), F.lit(mode).alias("mode")
    )
