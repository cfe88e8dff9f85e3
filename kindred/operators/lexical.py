"""BM25 over whole tables: corpus statistics and batch top-k search.

Documents with the same bag of tokens score alike for every query, so postings
are kept for one document per bag and copies are added back at the end.

A search scores all (query, document) pairs that share a term by a join when
their number is small, and inside tasks when the postings of the query terms fit
the broadcast bound.  Beyond both documents stream past slices of the queries
(``postings``), where lists are finished and terms too weak to lift a document to
the k-th best score generate no candidates: no hit is lost, no pair is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kindred.config import BM25_B, BM25_EPSILON, BM25_K1, LIMITS, Limits
from kindred.functions.text import tokens
from kindred.operators import blocks
from kindred.operators.postings import streamed_bags
from kindred.operators.skew import join_hot
from kindred.operators.topk import rank_by, top_k
from kindred.session import stored


@dataclass(frozen=True)
class LexicalIndex:
    """postings(term, doc_id, tfw), terms(term, df, idf, max_tfw, n_postings),
    documents(doc_id, dl, first_id, copies), and two corpus numbers.

    ``tfw`` is the part of the weight that depends on the document; the weight of
    a posting is ``idf * tfw``.
    """

    postings: DataFrame
    terms: DataFrame
    documents: DataFrame
    n_docs: int
    avgdl: float

    @staticmethod
    def read(spark: SparkSession, path: str) -> "LexicalIndex":
        corpus = spark.read.parquet(f"{path}/corpus").first()
        return LexicalIndex(
            spark.read.parquet(f"{path}/postings"),
            spark.read.parquet(f"{path}/terms"),
            spark.read.parquet(f"{path}/documents"),
            corpus["n_docs"],
            corpus["avgdl"],
        )


def bag_key(bag: Column) -> Column:
    """A key of a sorted bag: equal for texts with the same tokens, as no token holds a blank."""
    return F.sha2(F.array_join(bag, " "), 256)


def build_lexical(
    docs: DataFrame,
    path: str,
    doc_id: str = "uniq_id",
    text: str = "text",
    k1: float = BM25_K1,
    b: float = BM25_B,
    epsilon: float = BM25_EPSILON,
    limits: Limits = LIMITS,
) -> LexicalIndex:
    """Tokenize ``docs`` and write the index tables below ``path``.

    Copies of a text are counted in the tasks that read them, and no task gets all of them.  The words of a bag are counted
    in the task that holds it.
    """
    spark = docs.sparkSession
    bags = docs.select(
        F.col(doc_id).alias("doc_id"), F.sort_array(tokens(F.col(text))).alias("bag")
    ).select("doc_id", "bag", F.size("bag").alias("dl"))
    # a bag as one text: copies are counted where they are read, and a bag is moved once, not once for each of its words
    texts = bags.groupBy(F.array_join("bag", " ").alias("words"), "dl").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
    )
    texts = stored(texts, "bag-texts")

    keyed = stored(bags.select("doc_id", "dl", bag_key(F.col("bag")).alias("key")), "bag-keys")
    groups = texts.select(F.sha2("words", 256).alias("key"), "first_id", "copies")
    join_hot(keyed, groups, "key", limits).select("doc_id", "dl", "first_id", "copies").write.mode("overwrite").parquet(f"{path}/documents")
    documents = spark.read.parquet(f"{path}/documents")
    totals = documents.agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("dl")).first()
    n_docs = totals["n"]
    avgdl = (totals["dl"] or 0) / n_docs if n_docs else 0.0

    counted = term_counts(texts)
    tf, dl = F.col("n").cast("double"), F.col("dl")
    tfw = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / F.lit(avgdl)))
    counted.select("term", "doc_id", tfw.alias("tfw"), "copies").write.mode("overwrite").parquet(
        f"{path}/postings"
    )
    postings = spark.read.parquet(f"{path}/postings")

    raw = postings.groupBy("term").agg(
        F.sum("copies").alias("df"), F.max("tfw").alias("max_tfw"), F.count(F.lit(1)).alias("n_postings")
    )
    raw = raw.withColumn("raw_idf", F.log(F.lit(n_docs) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    raw.write.mode("overwrite").parquet(f"{path}/raw_terms")
    raw = spark.read.parquet(f"{path}/raw_terms")
    mean_idf = raw.agg(F.avg("raw_idf")).first()[0]
    floor_idf = epsilon * (mean_idf if mean_idf is not None else 0.0)
    idf = F.when(F.col("raw_idf") < 0, F.lit(floor_idf)).otherwise(F.col("raw_idf"))
    raw.select("term", "df", idf.alias("idf"), "max_tfw", "n_postings").write.mode("overwrite").parquet(
        f"{path}/terms"
    )
    spark.createDataFrame([(n_docs, avgdl)], "n_docs long, avgdl double").write.mode(
        "overwrite"
    ).parquet(f"{path}/corpus")
    return LexicalIndex.read(spark, path)


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, doc_id, copies, dl, n) of bags (words, dl, first_id, copies), counted where the bag is: nothing is moved."""
    # in a sorted bag equal tokens are neighbours: a term occurs from its first place to that of the next term
    bag = F.col("bag")
    place = F.sequence(F.lit(1), F.col("dl"))
    starts = F.filter(place, lambda i: (i == 1) | (F.get(bag, i - 1) != F.get(bag, i - 2)))
    nexts = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.col("dl") + 1))
    spans = texts.where("dl > 0").select("first_id", "copies", "dl", F.split("words", " ").alias("bag")).withColumn("starts", starts)
    return (
        spans.withColumn("nexts", nexts)
        .select(F.col("first_id").alias("doc_id"), "copies", "dl", "bag", F.inline(F.arrays_zip("starts", "nexts")))
        .select(F.get(bag, F.col("starts") - 1).alias("term"), "doc_id", "copies", "dl", (F.col("nexts") - F.col("starts")).alias("n"))
    )


def query_bags(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct token bags (bag_id, bag, key), and which one each query has (query_id, key)."""
    asked = queries.select(F.col(query_id).alias("query_id"), F.sort_array(tokens(F.col(text))).alias("bag"))
    asked = asked.withColumn("key", bag_key(F.col("bag")))
    # the numbers hold because the table is written before it is used
    bags = stored(
        asked.dropDuplicates(["key"]).select("key", "bag").withColumn("bag_id", F.monotonically_increasing_id()),
        "bags",
    )
    return bags, stored(asked.select("query_id", "key"), "bag-owners")


def bm25_topk(
    queries: DataFrame,
    index: LexicalIndex,
    k: int,
    query_id: str = "query_id",
    text: str = "text",
    decimals: int = 6,
    limits: Limits = LIMITS,
) -> DataFrame:
    """The k best documents per query with a score other than 0, and their ranks.

    Documents that share no term score 0.  They are left out, but keep their
    places: a negative score ranks behind all of them.
    """
    bags, owners = query_bags(queries, query_id, text)
    terms = (
        bags.select("bag_id", F.explode("bag").alias("term"))
        .groupBy("bag_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
        .join(index.terms, "term")
        .select(
            "bag_id", "term", "n_postings", "df",
            (F.col("qtf") * F.col("idf")).alias("factor"),
            (F.col("qtf") * F.col("idf") * F.col("max_tfw")).alias("bound"),
            F.ceil(F.col("n_postings") / limits.postings_per_key).cast("int").alias("salts"),
        )
    )
    terms = stored(terms, "query-terms")

    def of_owners(lists: DataFrame) -> DataFrame:
        return join_hot(owners, lists.join(bags.select("bag_id", "key"), "bag_id"), "key", limits)

    per_term = terms.groupBy("term").agg(
        F.sum("n_postings").alias("pairs"), F.min("factor").alias("low"), F.max("df").alias("df")
    )
    load = per_term.agg(F.sum("pairs").alias("pairs"), F.min("low").alias("low"), F.sum("df").alias("df")).first()
    pairs, low = load["pairs"] or 0, load["low"] or 0.0
    # what the postings of all query terms, copies included, take on the driver: each has its term, its id and numbers
    widest = index.documents.agg(F.max(F.octet_length(F.col("doc_id").cast("string")))).first()[0] or 0
    term_bytes = per_term.agg(F.sum((F.octet_length("term") + 8) * F.col("df") + 200)).first()[0] or 0
    posting_bytes = (32 + 2 * widest) * (load["df"] or 0) + term_bytes
    if low < 0:
        scored = _score_all(terms, index, pairs, decimals, limits)
        ranked = _rank_around_zero(_with_copies(scored, index, None), index.n_docs, k)
    elif pairs > limits.direct_pairs and posting_bytes <= limits.broadcast_bytes:
        hits = _rank_in_tasks(terms, index, pairs, k, decimals, limits)
        return of_owners(hits).select(
            "query_id", F.posexplode("hits").alias("pos", "hit")
        ).select(
            "query_id", F.col("hit.doc_id").alias("candidate_id"), "hit.score", (F.col("pos") + 1).alias("rank")
        )
    else:
        if pairs <= limits.direct_pairs:
            best = top_k(_score_all(terms, index, pairs, decimals, limits), k, "bag_id", "doc_id").drop("rank")
        else:
            best = _score_streamed(terms, index, pairs, k, decimals, limits)
        ranked = top_k(_with_copies(best, index, k), k, "bag_id", "doc_id")
    return of_owners(ranked).select(
        "query_id", F.col("doc_id").alias("candidate_id"), "score", "rank"
    )


def _salted(terms: DataFrame, postings: DataFrame, pairs: int, limits: Limits) -> DataFrame:
    """Join query terms with postings.

    The tasks are sized by the pairs that come out, which the sizes of the two
    inputs say nothing about.

    The postings of a frequent term are split over several keys, and so are the
    queries that use it, so no key pairs more than a bounded number of either.
    """
    sizes = terms.groupBy("term").agg(
        F.max("salts").alias("salts"),
        F.ceil(F.count(F.lit(1)) / limits.queries_per_key).cast("int").alias("slices"),
    )
    left = (
        terms.drop("salts")
        .join(sizes, "term")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .withColumn("slice", F.expr("cast(pmod(xxhash64(bag_id), slices) as int)"))
        .drop("salts", "slices")
    )
    right = (
        postings.join(sizes, "term")
        .withColumn("salt", F.expr("cast(pmod(xxhash64(doc_id), salts) as int)"))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .drop("salts", "slices")
    )
    keys = ["term", "salt", "slice"]
    cores = terms.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, ceil(pairs / 50_000)), ceil(pairs / limits.pairs_per_task), 1)
    return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)


# every weight is a whole number of these units: whole numbers add up alike in any order and in every plan
UNITS = 10**12


def _units(factor: Column | str, tfw: Column | str) -> Column:
    """The weight of a query term in a document, in units."""
    return F.floor(F.col(factor) * F.col(tfw) * F.lit(float(UNITS)) + 0.5).cast("long")


def _summed(matches: DataFrame, decimals: int) -> DataFrame:
    """Scores of (bag, document) pairs, rounded half up; pairs that sum to 0 are left out."""
    step = UNITS // 10**decimals
    total = F.sum(_units("factor", "tfw"))
    # floor division of whole numbers
    rounded = F.expr(f"total + {step // 2}")
    whole = (rounded - F.pmod(rounded, F.lit(step))) / F.lit(step)
    return (
        matches.groupBy("bag_id", "doc_id")
        .agg(total.alias("total"))
        .select("bag_id", "doc_id", (whole / F.lit(float(10**decimals))).alias("score"))
        .where("score != 0")
    )


def _score_all(
    terms: DataFrame, index: LexicalIndex, pairs: int, decimals: int, limits: Limits
) -> DataFrame:
    """Every pair that shares a term, by a join on the term."""
    matches = _salted(terms, index.postings.select("term", "doc_id", "tfw"), pairs, limits)
    return _summed(matches, decimals)


def _rank_in_tasks(
    terms: DataFrame, index: LexicalIndex, pairs: int, k: int, decimals: int, limits: Limits
) -> DataFrame:
    """(bag_id, hits best first) when the postings fit every executor: a task finishes its own bags."""
    spark = terms.sparkSession
    wanted = terms.select("term").distinct()
    postings = index.postings.select("term", "doc_id", "tfw").join(wanted, "term", "left_semi")
    # at most limits.broadcast_bytes
    table = _with_copies(postings, index, k).select("term", "doc_id", "tfw")
    table = table.toArrow().combine_chunks().sort_by("term")
    words = table["term"].combine_chunks()
    starts = np.flatnonzero(np.concatenate([[True], pc.not_equal(words[1:], words[:-1]).to_numpy(False)]))
    ends = np.append(starts[1:], len(words))
    span = dict(zip(words.take(pa.array(starts)).to_pylist(), zip(starts.tolist(), ends.tolist())))
    ids = pc.unique(table["doc_id"])
    ids = ids.take(pc.sort_indices(ids))
    places = pc.index_in(table["doc_id"], value_set=ids).to_numpy()
    shared = spark.sparkContext.broadcast((span, places, table["tfw"].to_numpy(), ids))

    schema = T.StructType(
        [
            T.StructField("bag_id", T.LongType()),
            T.StructField(
                "hits",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("doc_id", index.postings.schema["doc_id"].dataType),
                            T.StructField("score", T.DoubleType()),
                        ]
                    )
                ),
            ),
        ]
    )
    arrow_schema = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span, places, tfw, ids = shared.value
        n = len(ids)
        unit = float(UNITS)
        whole: dict[str, np.ndarray] = {}  # frequent terms as one weight per document
        for batch in batches:
            found_places, found_scores, lengths = [], [], []
            for bag in batch.column("terms").to_pylist():
                scores = np.zeros(n, dtype=np.int64)
                for entry in bag:
                    term, factor = entry["term"], entry["factor"]
                    start, end = span[term]
                    # a document occurs once per term, so plain indexing adds up
                    if 8 * (end - start) < n:
                        scores[places[start:end]] += np.floor(factor * tfw[start:end] * unit + 0.5).astype(np.int64)
                        continue
                    if term not in whole:
                        whole[term] = np.zeros(n)
                        whole[term][places[start:end]] = tfw[start:end]
                    scores += np.floor(factor * whole[term] * unit + 0.5).astype(np.int64)
                columns, best = blocks.best_in_row(scores, k, UNITS // 10**decimals, 10.0**decimals)
                found_places.append(columns)
                found_scores.append(best)
                lengths.append(len(columns))
            if lengths:
                yield blocks.ragged_hits(
                    batch.column("bag_id"), ids, found_places, found_scores, lengths, arrow_schema
                )

    bags = terms.groupBy("bag_id").agg(F.collect_list(F.struct("term", "factor")).alias("terms"))
    cores = spark.sparkContext.defaultParallelism
    tasks = max(cores, ceil(pairs / (20 * limits.pairs_per_task)))
    return bags.repartition(tasks).mapInArrow(search, schema)


def _score_streamed(
    terms: DataFrame, index: LexicalIndex, pairs: int, k: int, decimals: int, limits: Limits
) -> DataFrame:
    """Exact top-k scores when neither pairs nor postings are few; documents that cannot be among the k best are missing."""
    wanted = terms.select("term").distinct()
    postings = index.postings.select("term", "doc_id", "tfw").join(wanted, "term", "left_semi")
    documents = index.documents.where("doc_id = first_id").groupBy("doc_id").agg(F.min("copies").alias("copies"))
    return streamed_bags(terms, postings, documents, pairs, k, decimals, UNITS, limits)


def _with_copies(rows: DataFrame, index: LexicalIndex, k: int | None) -> DataFrame:
    """Repeat rows for the documents with the same bag; past the k first ids none can be a hit."""
    members = index.documents.where("copies > 1").select("doc_id", "first_id")
    if k is not None:
        members = rank_by(members, ["first_id"], [F.asc("doc_id")], k, "nth").drop("nth")
    single = index.documents.where("copies = 1").select("doc_id", F.col("doc_id").alias("first_id"))
    groups = members.unionByName(single)
    return (
        rows.withColumnRenamed("doc_id", "first_id")
        .join(groups, "first_id")
        .drop("first_id")
    )


def _rank_around_zero(scored: DataFrame, n_docs: int, k: int) -> DataFrame:
    """Ranks when scores may be negative: unmatched documents stand between the signs."""
    order = Window.partitionBy("bag_id").orderBy(F.desc("score"), "doc_id")
    matched = F.count(F.lit(1)).over(Window.partitionBy("bag_id"))
    place = F.row_number().over(order)
    zeros = F.lit(n_docs) - matched
    rank = F.when(F.col("score") > 0, place).otherwise(place + zeros).cast("int")
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)
