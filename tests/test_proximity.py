"""Search on a proximity graph: recall, bounded degrees, copies, full lists, hot keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.config import Limits, Search
from kindred.operators import proximity
from kindred.operators.dense import exact_topk
from kindred.operators.evaluate import recall_at_k
from kindred.operators.proximity import GraphIndex, descend, graph_topk, spread_join
from kindred.session import scratch_path

SCHEMA = "candidate_id string, vector array<float>"


def table(spark, x):
    return spark.createDataFrame([(f"p{i:05d}", [float(a) for a in v]) for i, v in enumerate(x)], SCHEMA)


def asked(items):
    return items.select(F.col("candidate_id").alias("query_id"), "vector")


def rows(df):
    return sorted(map(tuple, df.select("query_id", "candidate_id", "score", "rank").collect()))


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(0, 0.35, size=(3000, 16))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_recall_with_few_comparisons(spark, clustered):
    items = table(spark, clustered)
    graph = GraphIndex.build(items, scratch_path(spark, "graph"))
    queries = asked(items.where("substring(candidate_id, -1, 1) = '0'"))
    walked = graph_topk(queries, graph, 10, beam=32)
    assert recall_at_k(walked.found, exact_topk(queries, items, 10), 10).agg(F.avg("recall")).first()[0] >= 0.95
    assert walked.counts.agg(F.avg("candidates")).first()[0] < 0.4 * len(clustered)
    lists = {r["query_id"]: r["n"] for r in walked.found.groupBy("query_id").agg(F.count("*").alias("n")).collect()}
    assert len(lists) == 300 and set(lists.values()) == {10}


def test_scores_are_those_of_the_vectors(spark, clustered):
    items = table(spark, 3 * clustered[:700] * np.linspace(0.5, 2, 700)[:, None])
    graph = GraphIndex.build(items, scratch_path(spark, "graph"))
    exact = {r[:2]: r[2] for r in rows(exact_topk(asked(items), items, 700))}
    found = rows(graph_topk(asked(items), graph, 7).found)
    assert all(exact[q, c] == pytest.approx(s, abs=2e-6) for q, c, s, _ in found)
    best = {}
    for q, c, s, r in sorted(found, key=lambda x: (x[0], x[3])):
        best.setdefault(q, []).append((-s, c))
        assert r == len(best[q])
    assert all(x == sorted(x) for x in best.values())


def test_descent_finds_neighbours_within_its_bounds(spark, clustered):
    x = clustered[:1500]
    # a vector near to very many others
    x = np.vstack([x, x.mean(axis=0)])
    near = descend(table(spark, x), degree=8).toPandas()
    assert near.groupby("candidate_id").size().max() == 8
    assert not (near["candidate_id"] == near["neighbour"]).any() and not near.duplicated(["candidate_id", "neighbour"]).any()
    far = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(far, np.inf)
    true = np.argsort(far, axis=1)[:, :8]
    found = {i: set() for i in range(len(x))}
    for a, b in zip(near["candidate_id"], near["neighbour"]):
        found[int(a[1:])].add(int(b[1:]))
    assert np.mean([len(found[i] & set(true[i])) / 8 for i in found]) >= 0.9


def test_copies_and_long_lists(spark, clustered):
    x = np.vstack([clustered[:30], np.repeat(clustered[:1], 40, axis=0)])
    items = table(spark, x)
    graph = GraphIndex.build(items, scratch_path(spark, "graph"))
    assert graph.nodes.count() == 30
    for k in (1, 5, 60, 100):
        assert rows(graph_topk(asked(items), graph, k).found) == rows(exact_topk(asked(items), items, k))


def test_lists_longer_than_the_entries_and_what_they_lead_to(spark, clustered):
    items = table(spark, clustered[:60])
    nowhere = items.select("candidate_id", F.col("candidate_id").alias("neighbour")).limit(0)
    graph = GraphIndex.around(items, nowhere, items.orderBy("candidate_id").limit(5))
    assert rows(graph_topk(asked(items), graph, 20).found) == rows(exact_topk(asked(items), items, 20))


def test_no_items_and_one(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = table(spark, [[0.6, 0.8]])
    nothing = GraphIndex.build(empty, scratch_path(spark, "graph"))
    assert graph_topk(asked(one), nothing, 3).found.count() == 0
    single = GraphIndex.build(one, scratch_path(spark, "graph"))
    assert rows(graph_topk(asked(one), single, 3).found) == [("p00000", "p00000", 1.0, 1)]
    assert graph_topk(asked(empty), single, 3).found.count() == 0


def test_hot_keys_are_cut_and_nothing_is_lost(spark):
    left = spark.range(500).select(F.col("id").alias("query_id"), F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 7).alias("candidate_id"))
    right = spark.range(6).select(F.col("id").alias("candidate_id"), (F.col("id") * 10).alias("x"))
    plain = sorted(map(tuple, left.join(right, "candidate_id").select("query_id", "candidate_id", "x").collect()))
    cut = spread_join(left, right, "candidate_id", "query_id", Limits(block_rows=16)).select("query_id", "candidate_id", "x")
    assert sorted(map(tuple, cut.collect())) == plain


def test_search_kind(spark):
    assert Search("graph", beam=16).beam == 16
    with pytest.raises(ValueError):
        Search("graph", beam=0)
    assert proximity.BEAM == Search("graph").beam


def test_walk_ranks_only_the_best_again(spark, clustered, monkeypatch):
    items = table(spark, clustered)
    graph = GraphIndex.build(items, scratch_path(spark, "graph"))
    written, stored = [], proximity.stored

    def counted(df, name):
        out = stored(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(proximity, "stored", counted)
    queries = asked(items.where("substring(candidate_id, -1, 1) = '0'"))
    walked = graph_topk(queries, graph, 10, beam=16)
    assert max(n for name, n in written if name == "walk") <= 300 * 16
    met = sum(n for name, n in written if name == "scored") + 300 * graph.entries.count()
    assert walked.counts.agg(F.sum("candidates")).first()[0] == met


def test_pairs_of_neighbourhoods(clustered):
    x = clustered[:400]
    starts, floors = np.array([0, 1, 6, 6 + 47, 200, 203]), np.where(np.arange(400) % 3, 0.6, -np.inf)
    found = {(i, j): s for i, j, s in zip(*proximity.hood_pairs(x, starts, floors, 8))}
    for start, stop in zip(starts, [*starts[1:], 400]):
        for i in range(start, stop):
            scores = {j: x[i] @ x[j] for j in range(start, stop) if j != i and x[i] @ x[j] > floors[i]}
            best = sorted(scores, key=lambda j: -scores[j])[:8]
            assert all(found.get((i, j)) == pytest.approx(scores[j], abs=1e-8) for j in best)
            assert {j for a, j in found if a == i} == set(best)


def test_many_pairs_meet_in_blocks(spark, clustered, monkeypatch):
    items = table(spark, clustered[:300])
    # two rows with one id, and a null id, are nodes like others
    nodes = items.unionByName(table(spark, clustered[300:301])).unionByName(spark.createDataFrame([(None, [0.5] * 16)], SCHEMA))
    queries = asked(items.where("candidate_id < 'p00090'")).unionByName(asked(table(spark, clustered[301:302])))
    pairs = queries.select("query_id").distinct().join(nodes.select("candidate_id").distinct().where("candidate_id is null or candidate_id > 'p00020' or candidate_id = 'p00000'"))
    pairs = pairs.unionByName(spark.createDataFrame([("p00001", "unknown"), ("unknown", "p00001"), (None, "p00002")], pairs.schema))

    def scored(limits):
        found = proximity.products(pairs, queries, nodes, 6, limits).collect()
        return sorted(map(tuple, found), key=str)

    plain = scored(Limits())
    blocks, calls = proximity._products_in_blocks, []
    monkeypatch.setattr(proximity, "PAIRS_OF_GROUP", 3000)
    monkeypatch.setattr(proximity, "_products_in_blocks", lambda *a: calls.append(a[-2:]) or blocks(*a))
    assert scored(Limits(direct_pairs=1000)) == plain and calls[0][1] > 1
    assert scored(Limits(direct_pairs=1000, list_bytes=4096)) == plain
