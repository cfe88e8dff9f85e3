import math
import zlib
from collections import Counter

import numpy as np
import pytest

from kindred.llm import sharding
from kindred.llm.queries import op6_shards


@pytest.mark.parametrize(("good", "bad", "draws"), [(5, 7, 4), (1, 20, 10), (30, 3, 20), (0, 5, 3), (4, 0, 2), (6, 6, 0)])
def test_draws_follow_the_exact_law(good, bad, draws):
    rng = np.random.default_rng(1)
    n = 20_000
    seen = Counter(sharding.hypergeometric(good, bad, draws, rng) for _ in range(n))
    for k in range(draws + 1):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
        assert abs(seen[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_draws_from_very_many():
    rng = np.random.default_rng(2)
    good, bad, draws = 3 * 10**12, 10**13, 10**9
    seen = np.array([sharding.hypergeometric(good, bad, draws, rng) for _ in range(40)], float)
    mean = draws * good / (good + bad)
    assert abs(seen.mean() - mean) < 5 * math.sqrt(mean / 40) and seen.std() > 0.3 * math.sqrt(mean * bad / (good + bad))


def test_matrix_has_its_margins():
    rng = np.random.default_rng(3)
    for _ in range(20):
        blocks = rng.integers(0, 50, 9).tolist()
        cells = sharding.equal_sizes(sum(blocks), 7)
        matrix = sharding.communication_matrix(blocks, cells, 5)
        assert matrix.sum(axis=1).tolist() == blocks and matrix.sum(axis=0).tolist() == cells and (matrix >= 0).all()


def check(rows, shards):
    sizes = Counter(r.shard for r in rows)
    sizes = [sizes[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_query(spark, sf_dir):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op6_shards(spark, sf_dir).collect()
    check(rows, 24)
    expected = {(i, len(t) + 8, zlib.crc32(t), "rows", None) for i, t in texts.items()}
    assert {(r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows} == expected and len(rows) == len(texts)


def test_cells_and_blocks(spark):
    rows = spark.range(1000).selectExpr("id", "1 as shard", "'x' as uid", "id % 2 as block", "2 as row")
    got = sharding.shuffle_into_shards(rows, 5, block_rows=30).collect()
    check(got, 5)
    assert sorted(r.id for r in got) == list(range(1000))
    assert set(got[0].asDict()) == {"id", "shard", "uid", "block", "row", "slot"}


def test_places_are_uniform(spark):
    rows = spark.range(8)
    seen = Counter()
    for seed in range(60):
        for r in sharding.shuffle_into_shards(rows, 2, seed).collect():
            seen[r.id, r.shard] += 1
    assert all(12 <= seen[i, s] <= 48 for i in range(8) for s in (0, 1))


def test_odd_rows(odd_docs, no_docs):
    rows = sharding.shard_documents(odd_docs, 3).collect()
    check(rows, 3)
    assert len(rows) == odd_docs.count() and {(r["size"], r.text_crc32) for r in rows if r.doc_id in (3, 4)} == {(8, 0)}
    assert sharding.shard_documents(no_docs).collect() == []
