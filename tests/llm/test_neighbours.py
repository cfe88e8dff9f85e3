import numpy as np
import pandas as pd
import pytest

from kindred.llm import neighbours as nb
from kindred.llm.queries import op5_neighbours


def brute(rows, queries, k):
    """Exact nearest of (id, vector): lists of (id, score)."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, q in queries:
        score = (vectors * np.asarray(q, np.float64)).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def gather(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_query_recall(spark, name):
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet").collect()]
    expected = brute(data, [(i, v) for i, v in data if i % 20 == 0], 20)
    got = gather(op5_neighbours(spark, f"/root/testdata/{name}"))
    assert set(got) == set(expected)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / len(expected[q]) for q in got]
    assert np.mean(hits) >= 0.9
    vectors = {i: np.asarray(v, np.float64) for i, v in data}
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and len(found) == len(expected[q])
        assert all(s == pytest.approx(float(vectors[q] @ vectors[i]), abs=1e-12) for i, s in found)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank int, list int, score double")


def test_all_lists_and_a_wide_test_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(17) * rng.uniform(0.2, 3)).astype(np.float32).tolist()) for i in range(400)]
    df = table(spark, [(i, v, 0, 1, 2, 0.5) for i, v in rows])
    queries = df.where("vec_id % 10 = 0").selectExpr("vec_id as query_id", "embedding")
    got = gather(nb.search(df, queries, 7, lists=6, probes=6, confidence=1e9, part_rows=40, slice_queries=10))
    expected = brute(rows, [r for r in rows if r[0] % 10 == 0], 7)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in expected.items()}


def test_the_test_saves_work_and_keeps_near_vectors():
    rng = np.random.default_rng(2)
    points = rng.standard_normal((3000, 128)) * np.where(np.arange(3000) < 150, 1, 3)[:, None]
    query = points[0] + 0.1 * rng.standard_normal(128)
    true = ((points - query) ** 2).sum(axis=1)
    limit = np.partition(true, 20)[20]
    q, alive, far, work = nb.scan(points, query[None], np.array([limit]))
    assert work < 0.9 * points.size and np.allclose(far, true[alive]) and not q.any()
    assert len(set(alive) & set(np.flatnonzero(true <= limit))) >= 0.95 * (true <= limit).sum()


def test_limits_of_the_first_lists_stop_the_scan_of_the_others():
    rng = np.random.default_rng(4)
    points = rng.standard_normal((20, 32))[rng.integers(0, 20, 6000)] + 0.3 * rng.standard_normal((6000, 32))
    index = nb.Index(float((points**2).sum(axis=1).max()), np.linalg.qr(rng.standard_normal((33, 33)))[0], np.zeros((1, 33)))
    part = pd.DataFrame({"vec_id": np.arange(6000), "embedding": list(points)})
    score = points @ points[:40].T
    floor = np.sort(score, axis=0)[-21]
    calls = []
    original = nb.scan
    nb.scan = lambda *a: calls.append(original(*a)) or calls[-1]
    try:
        asked = pd.DataFrame({"query_id": np.arange(40), "embedding": list(points[:40])})
        free = nb.search_part(part, asked.assign(floor=np.nan), index, 20)
        work, calls = sum(c[3] for c in calls), []
        bound = nb.search_part(part, asked.assign(floor=floor), index, 20)
        assert sum(c[3] for c in calls) < work < points.size * 33 / 32 * 40
    finally:
        nb.scan = original
    for q in range(40):
        true = {int(i) for i in np.argsort(-score[:, q], kind="stable") if i != q and score[i, q] >= floor[q]}
        for found in (free, bound):
            assert len(true & set(found.loc[found["query_id"] == q, "vec_id"])) >= 0.8 * len(true)


def test_recall_and_fewer_lists_on_clustered_vectors(spark):
    rng = np.random.default_rng(6)
    middles = rng.standard_normal((50, 24))
    points = (middles[rng.integers(0, 50, 12_000)] + 0.3 * rng.standard_normal((12_000, 24))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    df = table(spark, [(i, v, 0, 1, 2, 0.5) for i, v in rows])
    queries = [r for r in rows if r[0] % 100 == 0]
    got = gather(nb.search(df, df.where("vec_id % 100 = 0").selectExpr("vec_id as query_id", "embedding"), part_rows=2000, slice_queries=50))
    expected = brute(rows, queries, 20)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 20 for q in expected]
    assert set(got) == set(expected) and np.mean(hits) >= 0.95
    ids = df.select("vec_id", "embedding")
    index = nb.fit(ids)
    assert len(index.centres) == 110
    assert nb.measured_probes(nb.assign(ids, index, 1, "vec_id"), index, 20) < 60


def test_lists_are_full_however_few_are_probed(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(200)]
    df = table(spark, [(i, v, 0, 1, 2, 0.5) for i, v in rows])
    got = gather(nb.search(df, df.where("vec_id % 20 = 0").selectExpr("vec_id as query_id", "embedding"), 30, lists=40, probes=2))
    assert len(got) == 10 and all(len(x) == 30 for x in got.values())


def test_ties_copies_and_useless_vectors(spark):
    same, nan = [1.0, 0.0, 2.0], float("nan")
    rows = [(i, same) for i in range(40, 0, -1)] + [(50, [0.0, 0.0, 0.0]), (51, None), (52, [1.0, nan, 0.0]), (53, [1.0, None, 0.0]), (54, [float("inf"), 0.0, 0.0]), (None, same), (60, [-1.0, 0.5, 0.0]), (60, [-1.0, 0.5, 0.0])]
    df = table(spark, [(i, v, None, None, None, None) for i, v in rows])
    queries = df.selectExpr("vec_id as query_id", "embedding").where("query_id in (2, 50, 51, 52, 53, 54, 60) or query_id is null")
    got = gather(nb.search(df, queries, 5, lists=4, probes=4, part_rows=7, slice_queries=1))
    assert set(got) == {2, 60}
    assert got[2] == [(i, 5.0) for i in (1, 3, 4, 5, 6)] and [i for i, _ in got[60]] == [1, 2, 3, 4, 5]


def test_no_rows_and_few_rows(spark):
    empty = table(spark, [])
    assert nb.search(empty, empty.selectExpr("vec_id as query_id", "embedding")).collect() == []
    two = table(spark, [(1, [1.0, 2.0], 0, 0, 0, 0.0), (2, [2.0, 1.0], 0, 0, 0, 0.0)])
    got = gather(nb.search(two, two.selectExpr("vec_id as query_id", "embedding"), 20))
    assert got == {1: [(2, 4.0)], 2: [(1, 4.0)]}


def test_empty_parts():
    assert len(nb.search_part(pd.DataFrame(), pd.DataFrame(), None, 3)) == 0
