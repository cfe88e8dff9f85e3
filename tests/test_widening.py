"""Widening search in cells: full lists, exactness without a reach, recall with a calibrated one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.config import FIRST_CELLS, REACH, Limits, Search
from kindred.operators.ann import CellIndex, calibrated_reach, widening_search
from kindred.operators.dense import exact_topk
from kindred.operators.evaluate import recall_at_k
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
    x = centres[rng.integers(0, 40, 2000)] + rng.normal(0, 0.25, size=(2000, 16))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def uneven(x):
    """Centres of which the first holds nearly all items, and one none."""
    return np.vstack([x.mean(axis=0), 1.3 * x[:9], 50 * np.ones((1, x.shape[1]))])


def test_lists_are_full_however_uneven_the_cells(spark, clustered):
    x = clustered[:300]
    items = table(spark, x)
    cells = CellIndex.around(items, scratch_path(spark, "uneven"), uneven(x))
    sizes = sorted(r["count"] for r in cells.items.groupBy("cell").count().collect())
    assert sizes[0] < 10 < 200 < sizes[-1]
    for k, nprobe in ((1, 1), (25, 1), (299, 2), (1000, 3)):
        found = widening_search(asked(items), cells, k, nprobe, reach=0.0, limits=Limits(block_rows=64)).found
        counts = {r["count"] for r in found.groupBy("query_id").count().collect()}
        assert counts == {min(k, 300)} and found.select("query_id", "candidate_id").distinct().count() == 300 * min(k, 300)


def test_without_reach_it_is_exact(spark, clustered):
    items = table(spark, clustered[:400])
    truth = rows(exact_topk(asked(items), items, 7))
    for centres in (uneven(clustered[:400]), clustered[:20]):
        cells = CellIndex.around(items, scratch_path(spark, "exact"), centres)
        assert rows(widening_search(asked(items), cells, 7, 1, None).found) == truth
    # vectors of other lengths, zero vectors and copies
    odd = np.vstack([clustered[:50], 3 * clustered[:20], np.zeros((5, 16)), clustered[:50]])
    items = table(spark, odd)
    cells = CellIndex.build(items, scratch_path(spark, "odd"), 6)
    assert rows(widening_search(asked(items), cells, 4, 1, None).found) == rows(exact_topk(asked(items), items, 4))


def test_calibrated_recall_with_few_comparisons(spark, clustered):
    items = table(spark, clustered)
    cells = CellIndex.build(items, scratch_path(spark, "calibrated"), 40, target=0.95)
    assert cells.reach == pytest.approx(calibrated_reach(cells)) and cells.reach != REACH
    # less is found from fewer cells, so more reach is needed
    assert calibrated_reach(cells, nprobe=1) >= cells.reach
    probed = widening_search(asked(items), cells, 10, FIRST_CELLS, cells.reach)
    recall = recall_at_k(probed.found, exact_topk(asked(items), items, 10), 10).agg(F.avg("recall")).first()[0]
    assert recall >= 0.95
    visits = probed.visits.groupBy("query_id").count().agg(F.avg("count")).first()[0]
    assert probed.visits.distinct().count() == probed.visits.count() and visits < 20


def test_calibration_meets_its_target(spark):
    """Without any structure in the vectors the reach grows until recall is as asked."""
    x = np.random.default_rng(5).normal(size=(1500, 12))
    items = table(spark, x)
    cells = CellIndex.build(items, scratch_path(spark, "flat"), 25, target=0.9)
    found = widening_search(asked(items), cells, 10, FIRST_CELLS, cells.reach).found
    assert recall_at_k(found, exact_topk(asked(items), items, 10), 10).agg(F.avg("recall")).first()[0] >= 0.9


def test_no_queries_and_no_items(spark):
    none = table(spark, np.zeros((0, 4)))
    items = table(spark, np.eye(4))
    cells = CellIndex.build(items, scratch_path(spark, "few"), 3, target=0.95)
    assert widening_search(asked(none), cells, 3, 1).found.count() == 0
    empty = CellIndex.build(none, scratch_path(spark, "none"), 3, target=0.95)
    assert widening_search(asked(items), empty, 3, 1).found.count() == 0
    assert Search("ivf").reach == "calibrated"
