"""Lists finished where the queries are: one list a query, whatever the slices, with items that stream by."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kindred.config import Limits
from kindred.operators import dense, streams
from kindred.operators.ann import CellIndex, ivf_topk
from kindred.operators.bounded import bounded_topk
from kindred.operators.bounds import Asked, block_topk
from kindred.operators.dense import meet_in_cells
from kindred.session import scratch_path, stored

from tests.test_dense import brute, frame, rows, unit

# slices of a few queries, blocks that the former plan would have cut
MANY = Limits(block_rows=37, seed_rows=60, list_bytes=20_000)


def test_a_query_has_one_list_and_no_hit_is_moved(spark):
    queries, items = unit(120, 16, 1), unit(500, 16, 2)
    found = bounded_topk(frame(spark, queries, "query_id"), frame(spark, items, "candidate_id"), 5, limits=MANY)
    assert found.work.count() == 120
    assert "Window" not in found.found._jdf.queryExecution().toString()
    assert rows(found.found) == sorted(brute(queries, items, 5))


def test_items_are_written_once_however_many_slices(spark, monkeypatch):
    written = []
    monkeypatch.setattr(streams, "stored", lambda df, name: written.append(stored(df, name)) or written[-1])
    queries, items = unit(120, 16, 1), unit(500, 16, 2)
    # equal scores, so that the order of the ids decides though blocks come in any order
    items[100:400] = items[:100].repeat(3, axis=0)
    found = bounded_topk(frame(spark, queries, "query_id"), frame(spark, items, "candidate_id").repartition(7), 5, limits=MANY)
    assert rows(found.found) == sorted(brute(queries, items, 5))
    blocks = [(r["first"], pa.ipc.open_stream(r["block"]).read_all()["candidate_id"].to_pylist()) for r in written[0].collect()]
    assert [x for _, ids in sorted(blocks) for x in ids] == [f"p{i:04d}" for i in range(500)]
    assert "Exchange" not in found.work._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_query_share_its_list(spark):
    queries, items = unit(6, 8, 3), unit(40, 8, 4)
    twice = frame(spark, queries, "query_id")
    twice = twice.unionByName(twice).unionByName(twice.selectExpr("cast(null as string) as query_id", "vector"))
    found = bounded_topk(twice, frame(spark, items, "candidate_id"), 4, limits=MANY).found
    once = {(q, r): c for q, c, _, r in brute(queries, items, 4)}
    assert sorted((r[0], r[3], r[1]) for r in rows(found.where("query_id is not null"))) == sorted(
        (q, n + 1, once[q, 1 + n // 2]) for q in {q for q, _ in once} for n in range(4)
    )
    best = sorted((-s for _, _, s, _ in brute(queries, items, 4)))[:4]
    assert [-r["score"] for r in found.where("query_id is null").orderBy("rank").collect()] == best


def test_a_cell_gives_a_query_k_hits_however_many_items_it_holds(spark):
    queries, items = unit(60, 16, 5), unit(400, 16, 6)
    routed = frame(spark, queries, "query_id").selectExpr("query_id", "vector", "cast('-inf' as double) as floor", "explode(array(0, 1)) as cell")
    celled = frame(spark, items, "candidate_id").selectExpr("candidate_id", "vector", "cast(substr(candidate_id, 2) as int) % 2 as cell")
    hits = meet_in_cells(routed, celled, 3, limits=MANY).collect()
    assert len(hits) == 60 * 2 * 3
    for q in (0, 59):
        scores = np.floor(items.astype(float) @ queries[q].astype(float) * 1e6 + 0.5)
        for cell in (0, 1):
            mine = sorted(range(cell, 400, 2), key=lambda j: (-scores[j], j))[:3]
            assert {h["candidate_id"] for h in hits if h["query_id"] == f"p{q:04d}" and int(h["candidate_id"][1:]) % 2 == cell} == {f"p{j:04d}" for j in mine}


def test_items_of_cells_are_not_repeated_for_many_slices(spark, monkeypatch):
    queries, items = unit(120, 16, 8), unit(500, 16, 9)
    items[100:400] = items[:100].repeat(3, axis=0)
    index = CellIndex.around(frame(spark, items, "candidate_id"), scratch_path(spark, "cells"), items[:6].astype(float))
    asked = stored(frame(spark, queries, "query_id"), "asked")
    odd = asked.unionByName(asked.limit(3)).unionByName(asked.limit(2).selectExpr("cast(null as string) as query_id", "vector"))
    met = rows(ivf_topk(asked, index, 4, 3))
    named = "coalesce(query_id, 'none') as query_id", "candidate_id", "score", "rank"
    met_odd = rows(ivf_topk(odd, index, 4, 2).selectExpr(*named))
    monkeypatch.setattr(dense, "streamed_topk", lambda *a, **b: pytest.fail("items are repeated"))
    many = Limits(list_bytes=4_000)
    assert rows(ivf_topk(asked, index, 4, 3, limits=many)) == met
    assert rows(ivf_topk(odd, index, 4, 2, limits=many).selectExpr(*named)) == met_odd
    assert rows(ivf_topk(asked, index, 4, 6, limits=many)) == sorted(brute(queries, items, 4))


def test_products_in_single_precision_drop_no_hit():
    rng = np.random.default_rng(7)
    for scale in (1.0, 1e-3, 1e4):
        items, queries = rng.normal(size=(800, 24)) * scale, rng.normal(size=(50, 24))
        # pairs that differ by less than single precision tells
        items[400:] = items[:400] * (1 + 1e-9)
        scores = np.floor(queries @ items.T * 1e6 + 0.5) / 1e6
        floors = np.sort(scores, axis=1)[:, -6]
        found = block_topk(Asked(queries, None), floors, items, 5, 6)
        wanted = [sorted(range(800), key=lambda j: (-row[j], j))[:5] for row in scores]
        assert np.allclose(np.concatenate(found.scores), np.concatenate([row[w] for row, w in zip(scores, wanted)]), rtol=1e-12, atol=1.1e-6)
        assert found.lengths.tolist() == [5] * 50


def test_items_of_a_large_cell_are_repeated_once_a_core_by_all_tasks(spark, monkeypatch):
    vector = F.array_repeat(F.lit(1.0).cast("float"), 4000).alias("vector")
    routed = spark.range(4000).select(F.col("id").alias("query_id"), vector, F.lit(float("-inf")).alias("floor"), F.lit(0).alias("cell"))
    celled = stored(spark.range(2000).coalesce(1).select(F.col("id").alias("candidate_id"), vector, F.lit(0).alias("cell")), "one-file")
    met = []
    monkeypatch.setattr(dense, "streamed_topk", lambda left, right, *a, **b: met.append(right) or streams.streamed_topk(left, right, *a, **b))
    dense.meet_in_cells(routed, celled, 3)
    cores = spark.sparkContext.defaultParallelism
    rows = [r["count"] for r in met[0].groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert 2000 < sum(rows) <= 2000 * cores
    assert len(rows) >= cores and max(rows) < 0.5 * sum(rows)
