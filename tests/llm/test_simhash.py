import random
import re

import numpy as np
import xxhash

from kindred.llm import graph, simhash
from kindred.llm.common import store
from kindred.llm.graph import components
from kindred.llm.queries import op4_simhash


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(links, nodes=()):
    parent = {n: n for n in nodes}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def brute_near(fps, distance):
    raw = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(raw[:, None] ^ raw[None, :]) <= distance
    return [(fps[i], fps[j]) for i, j in zip(*np.where(np.triu(near, 1)), strict=True)]


def test_fingerprints_against_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \n", "A", "a b", "a B c", "é Ü ñ"] + [" ".join(rng.choices(["A", "b", "É", "dd", "x\ty"], k=rng.randint(0, 40))) for _ in range(200)]
    got = simhash.fingerprints([t if t is None else t.encode() for t in texts])
    assert [int(x) % 2**64 for x in got] == [brute_fingerprint(t) for t in texts]


def crowd(seed):
    rng = np.random.default_rng(seed)
    found = {int(x) for x in rng.integers(-(2**63), 2**63 - 1, 40)} | {0}
    for centre in rng.integers(-(2**63), 2**63 - 1, 5):
        for _ in range(30):
            value = int(centre)
            for bit in rng.choice(64, rng.integers(0, 5), replace=False):
                value ^= 1 << int(bit) if bit < 63 else -(1 << 63)
            found.add(value)
    return sorted(found)


def test_links_lose_no_component(spark):
    fps = crowd(3)
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    for distance, pairwise in ((1, 512), (2, 512), (2, 2), (3, 2)):
        pairs = [tuple(r) for r in simhash.near_pairs(table, distance, pairwise).collect()]
        raw = np.array(pairs, np.int64).view(np.uint64)
        assert (np.bitwise_count(raw[:, 0] ^ raw[:, 1]) <= distance).all()
        assert roots(pairs) == roots(brute_near(fps, distance))
    # of many in reach of one another, links grow with their number only
    assert len(simhash.near_pairs(table, 2, 2).collect()) <= 2017 * len(fps)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)]
    for links in ([], [(1, 1)], chain, [(5, 3), (3, 5), (9, 8)]):
        expected = roots([(a, b) for a, b in links if a != b])
        table = spark.createDataFrame(links, "a long, b long")
        for per_task in (25, 1 << 20):
            assert {r.node: r.root for r in components(table, per_task).collect()} == expected


def test_query_on_whole_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 2]
    expected = roots(links, ids)
    rows = op4_simhash(spark, sf_dir).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{fps[i]:016x}", expected[i]) for i in ids}


def test_no_join_is_broadcast(spark, monkeypatch):
    """Tables made by an explode are sized by what went in, so the planner would collect them on the driver."""
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(simhash, "store", lambda df, name: store(planned(df), name))
    planned(graph._stars(spark.createDataFrame([(2, 1), (3, 2)], "a long, b long")))
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i // 2}") for i in range(8)], "doc_id long, text string")
    planned(simhash.keep_one(docs))
    assert sum("Join" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(odd_docs).collect()]
    assert len(rows) == odd_docs.count()
    assert {r for r in rows if r[1] == 0} == {(3, 0, 3), (4, 0, 3), (5, 0, 3), (None, 0, 3)}
    assert {r[2] for r in rows if r[0] in (1, 2)} == {1}
    assert [r[2] for r in rows if r[0] is None and r[1] != 0] == [None]
    assert simhash.near_duplicates(no_docs).collect() == []


def test_one_of_each_group_stays(odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [r[0] for r in rows].count(None) == 1 and sorted(r[0] for r in rows if r[0] is not None) == [1, 3, 6, 7, 7, 8]
    assert simhash.keep_one(no_docs).collect() == []


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c", 7, 8), (2, "a b c", 9, 9)], "doc_id long, text string, fp long, text_hash long")
    assert [tuple(r) for r in simhash.keep_one(docs).collect()] == [(1, "a b c", 7, 8)]
