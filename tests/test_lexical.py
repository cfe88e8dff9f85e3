import itertools
import math
import random
from collections import Counter
from dataclasses import replace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kindred.config import Limits
from kindred.operators.lexical import bm25_topk, build_lexical
from kindred.operators.postings import BestDocuments
from kindred.session import scratch_path

DIRECT = Limits()
IN_TASKS = Limits(direct_pairs=0)
PRUNED = Limits(direct_pairs=0, broadcast_bytes=0, postings_per_key=7, queries_per_key=5, pairs_per_task=500)


def brute(docs, queries, k, k1=1.5, b=0.75, epsilon=0.25):
    bags = {d: Counter(t.lower().split()) for d, t in docs.items()}
    n = len(docs)
    avgdl = sum(sum(c.values()) for c in bags.values()) / n
    df = Counter(t for c in bags.values() for t in c)
    idf = {t: math.log(n - x + 0.5) - math.log(x + 0.5) for t, x in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {t: epsilon * mean if v < 0 else v for t, v in idf.items()}
    out = []
    for q, text in queries.items():
        scores = {}
        for d, c in bags.items():
            dl = sum(c.values())
            scores[d] = round(
                sum(
                    idf.get(t, 0.0) * c[t] * (k1 + 1) / (c[t] + k1 * (1 - b + b * dl / avgdl))
                    for t in text.lower().split()
                ),
                6,
            )
        ranked = sorted(scores, key=lambda d: (-scores[d], d))[:k]
        out += [(q, d, scores[d], r + 1) for r, d in enumerate(ranked) if scores[d] != 0]
    return sorted(out)


def run(spark, docs, queries, k, limits):
    index = build_lexical(
        spark.createDataFrame(list(docs.items()), "uniq_id string, text string"), scratch_path(spark, "lex")
    )
    q = spark.createDataFrame(list(queries.items()), "query_id string, text string")
    return sorted(tuple(r) for r in bm25_topk(q, index, k, limits=limits).collect())


def close(found, expected):
    assert [r[:2] + r[3:] for r in found] == [r[:2] + r[3:] for r in expected]
    assert all(abs(f[2] - e[2]) < 2e-6 for f, e in zip(found, expected))


def corpus(seed=5, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = {
        f"d{i:04d}": " ".join(rng.choices(words, weights, k=rng.randint(1, 12))) for i in range(n)
    }
    for i in range(0, n, 3):  # a third of the corpus is one text
        docs[f"d{i:04d}"] = "w1 w5 w9 W5"
    docs["d0001"] = ""
    queries = {f"q{i}": " ".join(rng.choices(words, weights, k=rng.randint(1, 6))) for i in range(40)}
    queries |= {"q_copy": "w9 w5 w5 w1", "q_none": "unheard", "q_empty": "", "q_rep": "w30 w30 w2"}
    return docs, queries


@pytest.mark.parametrize("limits,k", [(DIRECT, 25), (IN_TASKS, 25), (PRUNED, 3), (PRUNED, 25)])
def test_equals_brute_force(spark, limits, k):
    docs, queries = corpus()
    close(run(spark, docs, queries, k, limits), brute(docs, queries, k))


@pytest.mark.parametrize("limits", [DIRECT, PRUNED])
def test_negative_scores_rank_behind_unmatched_documents(spark, limits):
    docs = {f"d{i}": "a b c" for i in range(6)} | {"d6": "z", "d7": "z a"}
    queries = {"q": "a z", "q2": "b"}
    for k in (3, 8):
        close(run(spark, docs, queries, k, limits), brute(docs, queries, k))


def test_plans_agree_on_scores_of_half_a_unit(spark):
    """Weights made so that sums end in half a unit of the rounded score: every plan must round them alike."""
    n = 400
    docs = {f"d{i:03d}": f"t{i} common" for i in range(n)}
    index = build_lexical(spark.createDataFrame(list(docs.items()), "uniq_id string, text string"), scratch_path(spark, "half"))
    number = F.regexp_extract("doc_id", r"d(\d+)", 1).cast("int")
    # idf 1 and weights of odd halves
    postings = index.postings.withColumn("tfw", F.when(F.col("term") == "common", (2 * number + 1) / 2e6).otherwise(F.col("tfw")))
    terms = index.terms.withColumn("idf", F.lit(1.0)).withColumn("max_tfw", F.lit(10.0))
    fixed = replace(index, postings=postings, terms=terms)
    queries = spark.createDataFrame([("a", "common"), ("b", "common common"), ("c", "common t7 t8")], "query_id string, text string")
    found = [
        sorted(tuple(r) for r in bm25_topk(queries, fixed, 50, limits=limits).collect()) for limits in (DIRECT, IN_TASKS, PRUNED)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 150


def test_streamed_lists_are_finished_where_the_bags_are(spark):
    """Groups of copies fill a list before its last groups; lists are no longer than k, however the documents come in blocks."""
    docs, queries = corpus(seed=11, n=400)
    docs |= {f"c{i:04d}": "w2 w3" for i in range(9)} | {f"e{i}": "w3 w2" for i in range(4)}
    queries |= {"q_pair": "w2 w3", "q_all": " ".join(f"w{i}" for i in range(60))}
    for k in (1, 7, 30):
        close(run(spark, docs, queries, k, PRUNED), brute(docs, queries, k))


def test_blocks_and_repeated_ids_of_documents():
    rng, step = random.Random(3), 10
    docs = [(f"d{i:03d}", sorted((rng.randrange(9), rng.randint(0, 4) / 2) for _ in range(rng.randint(0, 6)))) for i in range(200)]
    bags = [(i, sorted((t, float(rng.randint(0, 3))) for t in rng.sample(range(12), 5))) for i in range(40)]
    copies = [rng.randint(1, 4) for _ in docs]

    def lists(name, rows):
        own = {name: [r[0] for r in rows], "numbers": [[t for t, _ in r[1]] for r in rows], "weights": [[float(w) for _, w in r[1]] for r in rows]}
        return pa.table(own, pa.schema([(name, pa.int64() if name == "bag_id" else pa.string()), ("numbers", pa.list_(pa.int64())), ("weights", pa.list_(pa.float64()))]))

    schema = pa.schema([("bag_id", pa.int64()), ("hits", pa.list_(pa.struct([("doc_id", pa.string()), ("score", pa.float64())])))])
    for size in (200, 23):
        best = BestDocuments(lists("bag_id", bags), 5, step, 100)
        for start in range(0, 200, size):
            part = slice(start, start + size)
            best.add(lists("doc_id", docs[part]).append_column("copies", pa.array(copies[part])))
        found = best.batch(schema, 10.0).to_pylist()
        for (bag, asked), row in zip(bags, found):
            scored = sorted((-((sum(round(f * w * 100) for t, f in asked for u, w in d[1] if t == u) + step // 2) // step), d[0], c) for d, c in zip(docs, copies))
            expected, better = [], 0
            for score, group in itertools.groupby([s for s in scored if s[0] < 0], key=lambda s: s[0]):
                group = list(group)
                expected += [(d, -score / 10) for _, d, _ in group] if better < 5 else []
                better += sum(c for *_, c in group)
            assert [(h["doc_id"], h["score"]) for h in row["hits"]] == expected[:5]
