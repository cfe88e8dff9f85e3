"""The pipeline against plain versions of its stages, and what must stay or go."""

import random

import public_tokenizers

import corpus_pipeline as pipeline
from kindred.llm import packing, quality, repetition, simhash
from kindred.llm.common import crc_fold, store
from tests.llm.test_repetition import brute_row
from tests.llm.test_simhash import brute_fingerprint, roots

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_stages_have_the_columns_of_documents(spark, odd_docs):
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, odd_docs, SMALL).dtypes == odd_docs.dtypes


def test_run_against_plain_stages(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.fit(docs, labels.where(crc_fold("doc_id", 5) != 0))
    left = [(r.doc_id, r.text) for r in docs.collect() if model.score(quality.term_counts([r.text.encode()]))[0] >= quality.THRESHOLD]
    assert 0 < len(left) < docs.count()
    passed = []
    for i, text in left:
        # plain repetition of a long text takes too long
        if len(text) < 8000:
            kept = brute_row(text)[-1]
        else:
            kept = bool(repetition.measure([text.encode()])["kept"][0])
        if kept:
            passed.append((i, text))
    fps = {i: brute_fingerprint(t) for i, t in passed}
    ids = sorted(fps)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 2]
    first = roots(links, ids)
    final = {i: t for i, t in passed if first[i] == i}
    expected = {i: len(x) for i, x in zip(final, packing.token_ids(list(final.values()), PATH), strict=True)}
    found = {}
    for r in pipeline.run(spark, SMALL).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
        assert len(r.ids) == 4 * r.length
    assert found == expected


def test_planted_documents(spark):
    """Copies, repeated passages and short texts go through the pipeline's own stages; clean documents stay."""
    clean = {i: " ".join(f"{w}{i}{j}" for j, w in enumerate(["lorem", "ipsum", "dolor", "sit", "amet"] * 30)) for i in range(20)}
    rows = list(clean.items())
    rows += [(100, clean[3]), (101, clean[4].upper()), (102, " ".join(["same words again"] * 80)), (103, "too short")]
    passage = " ".join(f"part{i}" for i in range(120))
    rows += [(104, f"{passage} {' '.join(f'more{i}' for i in range(300))} {passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stages = dict(pipeline.STAGES)
    ruled = stages["quality_rules"](spark, docs, SMALL)
    assert {r.doc_id for r in ruled.collect()} == {*clean, 100, 101}
    kept = stages["near_dedup"](spark, ruled, SMALL)
    assert {r.doc_id for r in kept.collect()} == set(clean)
    pieces = stages["packing"](spark, kept, SMALL).collect()
    assert {r.doc_id for r in pieces} == set(clean)


def test_one_of_each_group_stays(spark):
    """Of texts whose fingerprints are linked in a chain one stays, the one with the smallest id."""
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(400)) for _ in range(12)]
    texts = [b if not n else " ".join([*b.split()[:-n], *(f"end{k}" for k in range(n))]) for b in base for n in range(6)]
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    first = roots(links, fps)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = pipeline.near_dedup(spark, docs, SMALL)
    assert {r.doc_id for r in kept.collect()} == {i for i in fps if first[i] == i}
    assert 0 < sum(first[i] == i for i in fps) < len(texts)


def test_deduplication_broadcasts_nothing(spark, monkeypatch):
    """Fingerprints and links grow with the documents; none of them may be collected on the driver, whatever their guessed size."""
    plans = []
    monkeypatch.setattr(simhash, "store", lambda df, name: plans.append(df) or store(df, name))
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i // 2}") for i in range(8)], "doc_id long, text string")
    plans.append(pipeline.near_dedup(spark, docs, SMALL))
    assert len(plans) > 3 and not any("Broadcast" in df._jdf.queryExecution().executedPlan().toString() for df in plans)


def test_no_documents(spark, no_docs):
    docs = no_docs
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.collect() == [], name
