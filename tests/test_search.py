import os
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.catalogue import build, products, search_index
from kindred.config import Limits, Search
from kindred.operators.ann import CellIndex, ivf_topk, lsh_topk
from kindred.operators.dense import exact_topk, learn_cells
from kindred.operators.evaluate import jaccard_at_k, percentile_summary, recall_at_k
from kindred.operators.fusion import rrf
from kindred.operators.rerank import TOKEN_OVERLAP, model_scorer, rerank
from kindred.plans import recommend as r
from kindred.plans.build import availability, build_index, load_or_build, purge_index
from kindred.plans.compare import compare_engines, compare_modes
from kindred.plans.requests import answer, product_lookup, request_status
from kindred.session import scratch_path, scratch_root
from kindred.sources.artifacts import has_index, open_index, read_purged, write_measurements


@pytest.fixture(scope="module")
def index(spark, sf_dir):
    return search_index(spark, sf_dir)


@pytest.fixture(scope="module")
def purged(spark, index):
    return purge_index(index, scratch_path(spark, "purged-index"))


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "query_id string")


def ranked(spark, *rows):
    return spark.createDataFrame(list(rows), "query_id string, candidate_id string, score double, rank int")


def lists(df):
    out = {}
    for row in df.orderBy("query_id", "rank").collect():
        out.setdefault(row["query_id"], []).append(row["candidate_id"])
    return out


# --- fusion and re-ranking ---------------------------------------------------------------


def brute_rrf(dense, sparse, depth, k=60):
    scores = {}
    for row in [*dense, *[s for s in sparse if s[2] != 0]]:
        scores[row[1]] = scores.get(row[1], 0.0) + 1 / (k + row[3])
    # insertion order settles ties: dense entries first, then sparse ones
    return sorted(scores, key=lambda c: -scores[c])[:depth]


def test_rrf(spark):
    dense = [("q", c, 1.0, i + 1) for i, c in enumerate("qabcdefg")]
    sparse = [("q", c, s, i + 1) for i, (c, s) in enumerate([("q", 9.0), ("x", 3.0), ("a", 2.0), ("y", 0.0), ("c", -1.0)])]
    for depth in (3, 100):
        found = rrf(ranked(spark, *dense), ranked(spark, *sparse), depth=depth)
        assert lists(found)["q"] == brute_rrf(dense, sparse, depth)
    for keep in (1, 2, 5, 8):
        found = rrf(ranked(spark, *dense), ranked(spark, *sparse), keep=keep)
        assert lists(found)["q"] == brute_rrf(dense, sparse, keep)
    # swapping the lists changes no score
    a = {r["candidate_id"]: r["score"] for r in rrf(ranked(spark, *dense), ranked(spark, *sparse[:3])).collect()}
    b = {r["candidate_id"]: r["score"] for r in rrf(ranked(spark, *sparse[:3]), ranked(spark, *dense)).collect()}
    assert a == pytest.approx(b)


def test_rerank_keeps_order_of_ties_and_takes_a_model(spark):
    pairs = spark.createDataFrame(
        [("q", "b", 1, "x y", "x"), ("q", "a", 2, "x y", "y"), ("q", "c", 3, "x y", "Y x"), ("p", "a", 1, "", "")],
        "query_id string, candidate_id string, rank int, query_text string, candidate_text string",
    )
    words = pairs
    for side in ("query_text", "candidate_text"):
        words = words.withColumn(side, TOKEN_OVERLAP.prepare(F.col(side)))
    assert lists(rerank(words, 3)) == {"q": ["c", "b", "a"], "p": ["a"]}
    assert rerank(words.where("false"), 3).count() == 0

    def make():
        return lambda left, right: np.array([float(len(b) - len(a)) for a, b in zip(left, right)])

    assert lists(rerank(pairs, 2, model_scorer(make)))["q"] == ["c", "b"]


# --- approximate search ------------------------------------------------------------------


def test_approximate_search(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(c, 0.05, size=(60, 8)) for c in np.eye(8)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    items = spark.createDataFrame([(f"p{i:03d}", [float(a) for a in v]) for i, v in enumerate(x)], "candidate_id string, vector array<float>")
    queries = items.select(F.col("candidate_id").alias("query_id"), "vector")
    exact = exact_topk(queries, items, 5)
    truth = sorted(map(tuple, exact.collect()))
    cells = CellIndex.build(items, scratch_path(spark, "cells"), 8)
    cells = CellIndex.read(spark, cells.items.inputFiles()[0].split("/items/")[0])
    limits = Limits(block_rows=17)
    assert sorted(map(tuple, ivf_topk(queries, cells, 5, 8, limits=limits).collect())) == truth
    few = recall_at_k(ivf_topk(queries, cells, 5, 1), exact, 5).agg(F.avg("recall")).first()[0]
    assert 0.95 < few <= 1
    some = recall_at_k(lsh_topk(queries, items, 5, 8, 0.5, 4, limits=limits), exact, 5).agg(F.avg("recall")).first()[0]
    assert 0.5 < some <= 1
    report = {(e.engine, e.params): e for e in compare_engines(queries, items, 5, 8, (8,), ((1000.0, 1),)).collect()}
    assert {e for e, _ in report} == {"exact", "bounded", "ivf", "widening", "coded", "graph", "lsh"}
    assert all(0.2 < e.recall <= 1 and e.candidates_per_query <= len(x) for e in report.values())
    assert all(e.recall == 1 and e.candidates_per_query == len(x) for k, e in report.items() if k[0] in ("exact", "ivf"))
    assert all(e.recall == 1 for k, e in report.items() if k[0] == "bounded")
    assert all(e.recall >= 0.95 and e.candidates_per_query < len(x) for k, e in report.items() if k[0] in ("widening", "coded"))


def test_evaluation(spark):
    a = ranked(spark, ("q", "x", 1.0, 1), ("q", "y", 1.0, 2))
    b = ranked(spark, ("q", "y", 1.0, 1), ("q", "z", 1.0, 2), ("p", "z", 1.0, 1))
    assert dict(map(tuple, recall_at_k(a, b, 2).collect())) == {"q": 0.5, "p": 0.0}
    found = dict(map(tuple, jaccard_at_k(ids(spark, "q", "p", "none"), a, b, 2).collect()))
    assert found == {"q": pytest.approx(1 / 3), "p": 0.0, "none": 0.0}
    s = percentile_summary(spark.range(101).selectExpr("cast(id as double) as x"), "x")
    assert s == {"p50": 50.0, "p95": 95.0, "p99": 99.0, "mean": 50.0}


# --- recommendation ----------------------------------------------------------------------


@pytest.mark.parametrize("mode", ["text_structured", "image", "combined"])
def test_counts_and_members(spark, index, mode):
    known = {row["uniq_id"] for row in index.products.select("uniq_id").collect()}
    for n in (1, 10):
        found = lists(r.recommend(ids(spark, "1", "2"), index, n, mode))
        assert set(found) == {"1", "2"}
        for q, hits in found.items():
            assert len(hits) == n == len(set(hits))
            assert q not in hits and set(hits) <= known


def test_more_than_the_usual_depth(spark, index):
    for mode in ("text_structured", "image"):
        assert len(lists(r.recommend(ids(spark, "1"), index, 150, mode))["1"]) == 150


def test_one_query_equals_its_share_of_a_batch(spark, index):
    everything = index.products.select(F.col("uniq_id").alias("query_id"))
    batch = lists(r.recommend(everything, index, 5))
    assert lists(r.recommend(ids(spark, "7"), index, 5))["7"] == batch["7"]
    pruned = Limits(direct_pairs=0, broadcast_bytes=0, block_rows=50, postings_per_key=20)
    assert lists(r.recommend(ids(spark, "7", "8"), index, 5, limits=pruned)) == {q: batch[q] for q in ("7", "8")}


def test_unknown_ids_and_modes(spark, index):
    assert r.recommend(ids(spark, "no such"), index, 5).count() == 0
    with pytest.raises(ValueError, match="not available"):
        r.recommend(ids(spark, "1"), index, 5, "sound")


def test_without_lexical_index_dense_ranks_are_used(spark, index):
    dense = replace(index, lexical=None)
    found = lists(r.candidates(ids(spark, "3"), dense, "combined"))["3"]
    near = lists(r.dense_candidates(ids(spark, "3"), index, "combined", 100))["3"]
    assert found == [x for x in near if x != "3"]


def test_nested_equals_detailed(spark, index):
    queries = ids(spark, "1", "2", "3")
    for mode in ("combined", "image"):
        detailed = r.recommend_detailed(queries, index, 4, mode).orderBy("query_id", "rank").collect()
        nested = r.recommend_nested(queries, index, 4, mode).orderBy("query_product.uniq_id").collect()
        flat = [
            (n.query_product.uniq_id, s["rank"], s.uniq_id, s.similarity_score, s.brand) for n in nested for s in n.similar_products
        ]
        assert flat == [(d.query_id, d["rank"], d.candidate_id, d.score, d.brand) for d in detailed]
        assert {n.mode for n in nested} == {mode}
        assert {d.score_kind for d in detailed} == {"cosine" if mode == "image" else "pair"}


# --- index life cycle and requests -------------------------------------------------------


def test_purge(spark, index, purged):
    gone = {row["uniq_id"] for row in purged.purged.collect()}
    before = {row["uniq_id"] for row in index.products.collect()}
    assert gone and {row["uniq_id"] for row in purged.products.collect()} == before - gone
    assert purged.vectors.count() == purged.dense["text_structured"].count() == len(before - gone)
    assert purged.encoder == index.encoder
    for mode, cells in purged.cells.items():
        assert (cells.centers == index.cells[mode].centers).all() and cells.reach == index.cells[mode].reach
        assert cells.items.count() == len(before - gone)
    path = scratch_path(spark, "ids")
    purged.purged.write.parquet(path)
    assert read_purged(spark, path).count() == len(gone)
    assert r.recommend(ids(spark, min(gone)), purged, 3).count() == 0


def test_load_or_build(spark, sf_dir):
    path = scratch_path(spark, "index")
    made = []

    def make(p):
        made.append(p)
        return build(spark, sf_dir, p)

    assert not has_index(spark, path)
    first = load_or_build(spark, path, make)
    second = load_or_build(spark, path, make)
    assert made == [path]
    assert availability(second).first().asDict() == {
        "products_indexed": first.products.count(), "available_modes": ["text_structured", "image", "combined"],
    }
    assert open_index(spark, path).lexical.n_docs == first.products.count()


def test_requests(spark, purged):
    gone = purged.purged.first()["uniq_id"]
    rows = [
        ("r1", "1", 3, "text_structured"), ("r2", "1", 3, "text_structured"), ("r3", "1", 5, "image"),
        ("r4", gone, 3, "image"), ("r5", "nope", 3, "image"), ("r6", "1", 10**6, "image"), ("r7", "1", 3, "sound"),
        ("r8", "1", 0, "image"), ("r9", "2", 2, "combined"), ("r10", "2", 120, "combined"), ("r11", "3", None, "image"),
    ]
    requests = spark.createDataFrame(rows, "request_id string, product_id string, num_similar int, mode string")
    status = {s.request_id: (s.status, s.reason) for s in request_status(requests, purged).collect()}
    assert {k: v[0] for k, v in status.items()} == {
        "r1": 200, "r2": 200, "r3": 200, "r4": 404, "r5": 404, "r6": 400, "r7": 422, "r8": 422, "r9": 200, "r10": 200,
        "r11": 422,
    }
    assert "purged" in status["r4"][1] and "not found" in status["r5"][1]
    answers = lists(answer(requests, purged).withColumnRenamed("request_id", "query_id"))
    assert {k: len(v) for k, v in answers.items()} == {"r1": 3, "r2": 3, "r3": 5, "r9": 2, "r10": 120}
    for request, product, n, mode in (rows[0], rows[2], rows[8], rows[9]):
        assert answers[request] == lists(r.recommend(ids(spark, product), purged, n, mode))[product]
    assert answers["r1"] == answers["r2"]


def test_mode_measurements(spark, index):
    found = compare_modes(index, n=3, batches=2, batch_size=4)
    assert {(row["mode"], row["batch"], row["queries"]) for row in found.collect()} == {
        (m, b, 4) for m in index.modes for b in (1, 2)
    }
    path = scratch_path(spark, "measured")
    write_measurements(found, path)
    assert spark.read.json(path).count() == 6


# --- nothing is lost without a word -------------------------------------------------------


def small_catalogue(spark, sf_dir, n=12):
    rows = products(spark, sf_dir).where(F.col("uniq_id").cast("int").between(1, n))
    ids = rows.select("uniq_id")
    vector = lambda i, dim: [float((int(i) * (j + 3)) % 7 + 1) for j in range(dim)]
    names = [r["uniq_id"] for r in ids.collect()]
    text = spark.createDataFrame([(i, vector(i, 4)) for i in names], "uniq_id string, text_vector array<float>")
    image = spark.createDataFrame([(i, vector(i, 3) if i != "3" else [0.0] * 3) for i in names], "uniq_id string, image_vector array<float>")
    return rows, text, image


def test_build_rejects_what_it_would_lose(spark, sf_dir):
    rows, text, image = small_catalogue(spark, sf_dir)
    path = scratch_path(spark, "rejected")
    with pytest.raises(ValueError, match="products without a vector, among them '5'"):
        build_index(rows, text.where("uniq_id <> '5'"), path, image)
    with pytest.raises(ValueError, match="text_vector: id '5' occurs 2 times"):
        build_index(rows, text.union(text.where("uniq_id = '5'")), path, image)
    with pytest.raises(ValueError, match="image_vector: id '4' occurs 2 times"):
        build_index(rows, text, path, image.union(image.where("uniq_id = '4'")))
    short = spark.createDataFrame([("99", [1.0])], "uniq_id string, image_vector array<float>")
    with pytest.raises(ValueError, match="lengths from 1 to 3"):
        build_index(rows, text, path, image.union(short))


def test_requests_a_mode_cannot_answer(spark, sf_dir):
    rows, text, image = small_catalogue(spark, sf_dir)
    index = build_index(rows, text, scratch_path(spark, "small"), image.where("uniq_id <> '4'"), n_cells=3)
    asked = [("a", "3", 2, "image"), ("b", "4", 2, "image"), ("c", "1", 9, "image"), ("d", "1", 10, "image"), ("e", "3", 11, "combined"), ("f", "3", 12, "combined")]
    requests = spark.createDataFrame(asked, "request_id string, product_id string, num_similar int, mode string")
    status = {s.request_id: (s.status, s.reason) for s in request_status(requests, index).collect()}
    assert {k: v[0] for k, v in status.items()} == {"a": 404, "b": 404, "c": 200, "d": 400, "e": 200, "f": 400}
    assert status["a"][1] == "product has no vector in this mode" and "(9)" in status["d"][1]
    answers = lists(answer(requests, index).withColumnRenamed("request_id", "query_id"))
    assert {k: len(v) for k, v in answers.items()} == {"c": 9, "e": 11}
    near = lists(answer(requests, index, search=Search("ivf", 3)).withColumnRenamed("request_id", "query_id"))
    assert near == answers


def test_lookup_tells_unknown_from_purged(spark, purged):
    gone = purged.purged.first()["uniq_id"]
    ids_ = spark.createDataFrame([("1",), ("1",), (gone,), ("nope",), (None,)], "product_id string")
    found = sorted((str(x.product_id), x.status, x.reason) for x in product_lookup(ids_, purged).collect())
    assert [x[:2] for x in found] == sorted([("1", 200), ("1", 200), (gone, 404), ("nope", 404), ("None", 404)])
    assert "purged" in dict((a, c) for a, _, c in found)[gone]


def test_search_names():
    with pytest.raises(ValueError):
        Search("nearly")


def test_cells_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(8)
    items = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 5)))], "candidate_id long, vector array<float>")
    one, other = learn_cells(items.repartition(1), 6), learn_cells(items.repartition(7, "candidate_id"), 6)
    assert len(one) == 6 and np.allclose(one, other, atol=1e-6)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_runs_from_another_folder(tmp_path, sf_dir):
    """The executors get the package from the driver, wherever the application starts."""
    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", e.queries()["knn_embeddings"](spark, {sf_dir!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_lists_that_are_not_fused_are_searched_as_far_as_used(spark, index, monkeypatch):
    depths = []

    def searched(queries, items, k, **options):
        depths.append(k)
        return exact_topk(queries, items, k, **options)

    monkeypatch.setattr(r, "exact_topk", searched)
    queries = index.products.select(F.col("uniq_id").alias("query_id")).limit(20)
    short = r.recommend_detailed(queries, index, 5, "image")
    deep = r.candidates(queries, index, "image").where("rank <= 5")
    assert lists(short) == lists(deep) and depths == [6, 100]
