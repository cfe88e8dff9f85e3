import numpy as np
import pytest

from kindred.config import Limits
from kindred.operators.dense import exact_topk
from kindred.operators.topk import drop_self

TINY = Limits(broadcast_bytes=1, block_rows=37, seed_rows=20, work_per_task=1e5)


def unit(rows, dim, seed):
    v = np.random.default_rng(seed).normal(size=(rows, dim))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, vectors, name):
    ids = [f"p{i:04d}" for i in range(len(vectors))]
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in zip(ids, vectors)], f"{name} string, vector array<float>"
    )


def brute(queries, items, k):
    scores = np.floor(queries.astype(float) @ items.astype(float).T * 1e6 + 0.5)
    out = []
    for q, row in enumerate(scores):
        order = sorted(range(len(items)), key=lambda j: (-row[j], j))[:k]
        out += [(f"p{q:04d}", f"p{j:04d}", row[j] / 1e6, r + 1) for r, j in enumerate(order)]
    return out


def rows(df):
    return sorted(tuple(r) for r in df.select("query_id", "candidate_id", "score", "rank").collect())


@pytest.fixture(scope="module")
def tables(spark):
    # a third of the items are copies of one vector, and so are a third of the queries
    items = unit(600, 16, 1)
    items[::3] = items[0]
    queries = np.vstack([items[:60], unit(40, 16, 2)])
    return queries, items, frame(spark, queries, "query_id"), frame(spark, items, "candidate_id")


@pytest.mark.parametrize("plan", ["broadcast_items", "broadcast_queries", "bounded", "routed"])
@pytest.mark.parametrize("k", [1, 10])
def test_every_plan_equals_brute_force(tables, plan, k):
    queries, items, q, i = tables
    found = exact_topk(q, i, k, limits=TINY, plan=plan)
    assert rows(found) == sorted(brute(queries, items, k))


def test_k_is_cut_to_the_number_of_items(tables):
    queries, items, q, i = tables
    few = i.where("candidate_id < 'p0005'")
    for plan in ("broadcast_items", "broadcast_queries", "bounded", "routed"):
        found = exact_topk(q, few, 10, limits=TINY, plan=plan)
        assert rows(found) == sorted(brute(queries, items[:5], 10))


def test_plan_follows_the_sizes(tables):
    queries, items, q, i = tables
    expected = sorted(brute(queries, items, 5))
    for bound in (1, 100 * 16 * 8 + 1, 10**9):
        found = exact_topk(q, i, 5, limits=Limits(broadcast_bytes=bound, block_rows=64))
        assert rows(found) == expected


def test_self_is_nearest_and_can_be_dropped(spark):
    v = unit(200, 64, 3)
    found = exact_topk(frame(spark, v, "query_id"), frame(spark, v, "candidate_id"), 5)
    first = found.where("rank = 1").collect()
    assert len(first) == 200 and all(r["query_id"] == r["candidate_id"] for r in first)
    assert drop_self(found).where("query_id = candidate_id").count() == 0


def test_lengths_must_agree(spark):
    with pytest.raises(ValueError, match="length"):
        exact_topk(frame(spark, unit(3, 4, 0), "query_id"), frame(spark, unit(3, 5, 0), "candidate_id"), 1)
