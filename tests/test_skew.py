"""Hot keys: joins and corpus statistics in which one key holds a large share of all rows."""

from collections import Counter

from pyspark.sql import functions as F

from kindred.config import Limits
from kindred.operators.lexical import bm25_topk, build_lexical
from kindred.operators.skew import join_hot
from kindred.session import scratch_path, stored

FEW = Limits(rows_per_key=100)


def tables(spark):
    rows = [(i, None if i % 50 == 7 else "hot" if i % 2 else f"k{i % 40}") for i in range(4000)]
    many = stored(spark.createDataFrame(rows, "id int, key string"), "many")
    few = [("hot", 1), ("hot", 2), ("k0", 3), ("k2", 4), ("unused", 5), (None, 6)]
    expected = Counter((i, k, x) for i, k in rows for f, x in few if k is not None and f == k)
    return many, spark.createDataFrame(few, "key string, x int"), expected


def test_a_hot_key_is_dealt_over_tasks(spark):
    many, few, expected = tables(spark)
    for limits in (FEW, Limits()):
        found = join_hot(many, few, "key", limits)
        assert Counter((r["id"], r["key"], r["x"]) for r in found.collect()) == expected
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def greatest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        total = sum(expected.values())
        assert greatest(join_hot(many, few, "key", Limits())) > 0.9 * total
        assert greatest(join_hot(many, few, "key", FEW)) < 0.35 * total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_sides_and_rows_alike(spark):
    many, few, _ = tables(spark)
    assert join_hot(many.where("false"), few, "key", FEW).count() == 0
    assert join_hot(many, few.where("false"), "key", FEW).count() == 0
    alike = stored(spark.createDataFrame([("hot",)] * 300 + [("k0",)], "key string"), "alike")
    assert join_hot(alike, few, "key", FEW).count() == 601


def test_one_text_in_two_of_five_documents(spark):
    docs = [(f"d{i:04d}", "the same words" if i % 5 < 2 else f"the word w{i % 97} of {i % 13}") for i in range(2000)]
    frame = spark.createDataFrame(docs, "uniq_id string, text string").repartition(8)
    tight, loose = (build_lexical(frame, scratch_path(spark, "lex"), limits=x) for x in (FEW, Limits()))
    for name in ("documents", "terms"):
        assert getattr(tight, name).exceptAll(getattr(loose, name)).count() == 0
        assert getattr(tight, name).count() == getattr(loose, name).count()
    copies = {r["doc_id"]: r["copies"] for r in tight.documents.collect()}
    assert len(copies) == 2000 and copies["d0001"] == 800
    queries = spark.createDataFrame([(f"q{i:04d}", "same words" if i % 3 else f"w{i}") for i in range(600)], "query_id string, text string")
    for plan in (Limits(rows_per_key=100), Limits(rows_per_key=100, direct_pairs=0), Limits(rows_per_key=100, direct_pairs=0, broadcast_bytes=0)):
        found, plain = bm25_topk(queries, tight, 5, limits=plan), bm25_topk(queries, loose, 5)
        rows = Counter(map(tuple, found.collect()))
        assert rows == Counter(map(tuple, plain.collect()))
        assert sum(q == "q0001" for q, *_ in rows) == 5
