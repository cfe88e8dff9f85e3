"""Exact search by levels of norm and bounds on the rest of a product, against plain loops."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from kindred.config import Limits
from kindred.operators.bounded import block_topk, bounded_topk

from tests.test_dense import frame, rows, unit

SMALL = Limits(block_rows=50, seed_rows=60)


def brute(queries, items, k):
    scores = np.floor(queries.astype(float) @ items.astype(float).T * 1e6 + 0.5)
    out = []
    for q, row in enumerate(scores):
        order = sorted(range(len(items)), key=lambda j: (-row[j], j))[:k]
        out += [(f"p{q:04d}", f"p{j:04d}", row[j] / 1e6, r + 1) for r, j in enumerate(order)]
    return sorted(out)


def decaying(n, dim, seed):
    """Vectors of which most of the length lies in a few directions, turned at random."""
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    return (rng.normal(size=(n, dim)) * 0.7 ** np.arange(dim)) @ turn


def test_bounds_drop_pairs_and_no_hit(spark):
    items, queries = decaying(700, 32, 1).astype(np.float32), decaying(40, 32, 2).astype(np.float32)
    # the same directions for both
    queries[:20] = items[:20]
    found = bounded_topk(frame(spark, queries, "query_id"), frame(spark, items, "candidate_id"), 5, limits=SMALL)
    assert rows(found.found) == brute(queries, items, 5)
    counts = found.counts.collect()
    assert len(counts) == 40 and all(r["candidates"] <= r["met"] <= 700 for r in counts)
    assert sum(r["candidates"] for r in counts) < 0.5 * 40 * 700


def test_short_vectors_are_not_met(spark):
    rng = np.random.default_rng(3)
    items = (unit(600, 16, 3) * (10.0 ** rng.integers(0, 4, 600))[:, None]).astype(np.float32)
    queries = unit(30, 16, 4)
    found = bounded_topk(frame(spark, queries, "query_id"), frame(spark, items, "candidate_id"), 3, limits=SMALL)
    assert rows(found.found) == brute(queries, items, 3)
    assert sum(r["met"] for r in found.counts.collect()) < 0.6 * 30 * 600


def test_a_third_of_all_rows_alike(spark):
    items = unit(500, 8, 5)
    items[::3] = items[0]
    queries = np.vstack([np.repeat(items[:1], 30, axis=0), unit(10, 8, 6), np.zeros((2, 8), np.float32)]).astype(np.float32)
    found = bounded_topk(frame(spark, queries, "query_id"), frame(spark, items, "candidate_id"), 200, limits=SMALL)
    assert rows(found.found) == brute(queries, items, 200)


def test_scores_below_zero_and_few_items(spark):
    items, queries = -np.abs(unit(9, 4, 7)), np.abs(unit(5, 4, 8))
    q, i = frame(spark, queries, "query_id"), frame(spark, items, "candidate_id")
    assert rows(bounded_topk(q, i, 3, limits=SMALL).found) == brute(queries, items, 3)
    assert rows(bounded_topk(q, i, 20, limits=SMALL).found) == brute(queries, items, 20)
    assert rows(bounded_topk(q, i, 3, limits=SMALL, levels=1).found) == brute(queries, items, 3)


def test_empty_tables_and_other_columns(spark):
    vectors = unit(4, 4, 9)
    q, i = frame(spark, vectors, "query_id"), frame(spark, vectors, "candidate_id")
    assert bounded_topk(q, i.where("false"), 3).found.count() == 0
    assert bounded_topk(q, i.where("false"), 3).counts.count() == 0
    assert bounded_topk(q.where("false"), i, 3).found.count() == 0
    more = bounded_topk(q.selectExpr("*", "1 as level", "2 as norm"), i.selectExpr("*", "1 as part", "2 as norm"), 3)
    assert rows(more.found) == brute(vectors, vectors, 3)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 60), st.sampled_from([2, 16, 20, 64]), st.integers(1, 12), st.floats(0, 3))
def test_a_block_equals_a_plain_product(seed, n_q, n_i, dim, k, above):
    rng = np.random.default_rng(seed)
    shape = 0.6 ** np.arange(dim)
    queries, items = rng.normal(size=(n_q, dim)) * shape, np.round(rng.normal(size=(n_i, dim)) * shape, rng.integers(0, 4))
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0] if seed % 2 else np.eye(dim)
    floors = np.where(rng.random(n_q) < 0.2, -np.inf, np.round(rng.normal(size=n_q) + above, 6))
    found = block_topk(queries, floors, items, rotation, k, 6)
    columns, scores = np.concatenate(found.columns), np.concatenate(found.scores)
    ends = np.cumsum(found.lengths)
    assert ends[-1] == len(columns) == len(scores) and (found.compared <= n_i).all()
    plain = np.floor(queries @ items.T * 1e6 + 0.5) / 1e6
    for row, (end, length) in enumerate(zip(ends, found.lengths)):
        hits = sorted((-plain[row, j], j) for j in range(n_i) if plain[row, j] >= floors[row])[:k]
        assert columns[end - length : end].tolist() == [j for _, j in hits]
        assert scores[end - length : end] == pytest.approx([-s for s, _ in hits], abs=1e-9)
