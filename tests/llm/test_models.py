"""Quality classifier, language identification, hidden Markov language model."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import hmm, language, quality
from kindred.llm.common import crc_fold, crc_fold_value
from kindred.llm.queries import op8_quality, op9_hmm, op10_language

MIDDLE = "/root/testdata/sf0.01"


def test_crc_fold(spark):
    df = spark.createDataFrame([(i,) for i in (0, 7, 123456, -5, None)], "doc_id long")
    for row in df.select("doc_id", crc_fold("doc_id", 5).alias("f")).collect():
        assert row.f == crc_fold_value(row.doc_id, 5) == (zlib.crc32(str(row.doc_id).encode()) if row.doc_id is not None else 0) % 5


# --- quality


def brute_counts(text):
    raw = quality.CLASSES[np.frombuffer(text, np.uint8)].tolist()
    out = np.zeros(quality.TERMS)
    if len(raw) < 3:
        return out
    buckets = quality.TERMS - quality.REPEAT_LEVELS
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        mixed = a * 73856093 % 2**32 ^ b * 19349663 % 2**32 ^ c * 83492791 % 2**32
        out[(mixed * 2654435761 % 2**32 >> 16) * buckets >> 16] += 1
    words = text.lower().split()
    if len(words) > 1:
        again = sum(a == b for a, b in zip(words, words[1:])) / (len(words) - 1)
        out[buckets : buckets + math.ceil(quality.REPEAT_LEVELS * again)] = quality.REPEAT_COUNT
    return out


def test_term_counts_against_brute_force():
    texts = [None, b"", b"ab", b"Hello, World 42!", "äöü été".encode(), b"x x x y y", b"again " * 50]
    got = quality.term_counts(texts)
    for row, text in zip(got, texts, strict=True):
        assert np.array_equal(row, brute_counts(text or b""))


def brute_score(model, counts):
    v = np.log1p(counts) * model.weights
    v = v / np.linalg.norm(v) @ model.axes
    v = v / np.linalg.norm(v)
    near = sorted(range(len(model.labels)), key=lambda i: (-round(float(model.vectors[i] @ v), 5), i))[: quality.NEIGHBOURS]
    weight = [max(float(model.vectors[i] @ v), 0) ** quality.SHARPNESS for i in near]
    return sum(w * model.labels[i] for w, i in zip(weight, near, strict=True)) / sum(weight)


def test_votes_against_brute_force(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    texts = [r.text.encode() for r in docs.limit(60).collect()]
    got = model.score(quality.term_counts(texts))
    assert np.allclose(got, [brute_score(model, brute_counts(t)) for t in texts], atol=2e-3)
    assert len(quality.fit(docs, labels, max_labelled=10).labels) == 10


def test_quality_query_held_out(spark):
    rows = op8_quality(spark, MIDDLE).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    own = [(labels[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (crc_fold_value(r.doc_id, 5) == 0) for r in rows)
    assert sum(a == b for a, b, _ in own) >= 0.97 * len(own)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (8, 0), (8, 0), (None, 1), (6, None), (99, 1), (2, 7)], "doc_id long, quality int")
    model = quality.fit(odd_docs, labels)
    assert sorted(model.labels) == [0, 1]
    rows = quality.classify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(r.score == model.prior for r in rows if r.doc_id in (3, 4))
    assert quality.fit(odd_docs, labels.limit(0)) is None and quality.fit(no_docs, labels) is None
    assert {r.score for r in quality.classify(odd_docs, None).collect()} == {0.5}
    assert quality.classify(no_docs, model).collect() == [] == quality.keep_good(no_docs, model).collect()
    assert quality.keep_good(odd_docs, None).columns == odd_docs.columns


# --- language


def brute_bits(samples, text, order):
    """Prediction by partial matching, one byte at a time, from nested counts."""
    counts = defaultdict(Counter)
    for sample in samples:
        raw = bytes(order) + sample.lower().encode()
        for i in range(order, len(raw)):
            for k in range(order + 1):
                counts[raw[i - k : i]][raw[i]] += 1
    raw, bits = bytes(order) + text.lower().encode(), 0.0
    for i in range(order, len(raw)):
        for k in range(order, -1, -1):
            seen = counts[raw[i - k : i]]
            n, t = seen.total(), len(seen)
            if not n:
                continue
            if seen[raw[i]]:
                bits += math.log2((n + t) / seen[raw[i]])
                break
            bits += math.log2((n + t) / t)
        else:
            bits += 8
    return bits


def test_code_lengths_against_brute_force(spark):
    samples = {"aa": ["banana bandana", "ananas é"], "bb": ["xylo phone", "phony"]}
    docs = spark.createDataFrame([(i, t, lang) for lang, ts in samples.items() for i, t in enumerate(ts)], "doc_id long, text string, lang string")
    for order in (1, 3):
        model = language.fit(docs, order)
        assert model.languages == ["aa", "bb"]
        texts = ["banana", "phone ananas", "", "zzz éé Ω", None, "Ban xylo"]
        got = language.score_texts(texts, model, order)
        expected = [[brute_bits(samples[lang], t or "", order) for lang in model.languages] for t in texts]
        assert np.allclose(got, expected, rtol=1e-4)


def test_long_texts_are_scored_in_windows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "banana bandana", "aa"), (2, "xylo phone", "bb")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    texts = ["banana " * 50, "", "xylo", "phone " * 30]
    whole = language.score_texts(texts, model)
    monkeypatch.setattr(language, "WINDOW", 7)
    assert np.allclose(language.score_texts(texts, model), whole)


def test_language_query_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    rows = op10_language(spark, MIDDLE).collect()
    assert len(rows) == len(truth) and all(r.held_out == (crc_fold_value(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    own = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(own) >= 0.98 * len(own)


def test_language_odd_rows(odd_docs, no_docs):
    model = language.fit(odd_docs)
    assert model.languages == ["de", "en", "fr"]
    rows = language.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (3, 4, 5))
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2)} == {"en"}
    assert language.fit(no_docs) is None and language.identify(no_docs, model).collect() == []
    assert {r.lang_pred for r in language.identify(odd_docs, None).collect()} == {"und"}


def test_model_stays_within_its_bounds(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"), F.lit("en").alias("lang"))
    model = language.fit(docs, max_pieces=50, max_bytes=100)
    assert len(model.levels[0].known) <= 120


def test_languages_learn_from_long_documents(spark):
    """A language with nothing but one document beyond the bounds is learned, and a long one does not end another's learning."""
    rng = np.random.default_rng(6)
    word = lambda letters: "".join(rng.choice(list(letters), 5))
    rows = [(1, " ".join(word("abcde") for _ in range(600_000)), "long"), (2, " ".join(word("vwxyz") for _ in range(400_000)), "mixed")]
    rows += [(10 + i, " ".join(word("pqrst") for _ in range(50)), "mixed") for i in range(500)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["long", "mixed"]
    texts = ["abcde edcba", "zyxwv vvwwx", "pqrst tsrqp"]
    assert language.score_texts(texts, model).argmin(axis=1).tolist() == [0, 1, 1]


def test_very_long_texts_are_scored_whole(spark):
    docs = spark.createDataFrame([(1, "banana bandana", "aa"), (2, "xylo phone", "bb")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    long = ["banana " * 300_000, "phone" * 400_000, " " * 2_000_000, "xylo " * 1_200_000 + "banana " * 1_000_000]
    got = language.score_texts(long, model)
    assert got.argmin(axis=1).tolist()[:2] == [0, 1]
    parts = language.score_texts(["xylo " * 1_200_000, " " + "banana " * 1_000_000], model)
    assert np.allclose(got[3], parts.sum(axis=0), rtol=1e-4)


# --- hidden Markov model


@pytest.fixture(scope="module")
def chain():
    rng = np.random.default_rng(1)
    return hmm.Chain(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T.copy())


def brute_paths(chain, seen):
    total, starts, moves, emits = 0.0, np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=len(seen)):
        p = chain.start[path[0]] * chain.emit[seen[0], path[0]]
        for i in range(1, len(seen)):
            p *= chain.move[path[i - 1], path[i]] * chain.emit[seen[i], path[i]]
        total += p
        starts[path[0]] += p
        for i, s in enumerate(path):
            emits[seen[i], s] += p
            if i:
                moves[path[i - 1], s] += p
    return total, starts / total, moves / total, emits / total


def test_recursions_against_all_paths(chain):
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 5, n) for n in (1, 4, 2, 5, 4, 1)]
    brute = [brute_paths(chain, s) for s in sequences]
    assert np.allclose(chain.forward(sequences), [np.log10(b[0]) for b in brute])
    starts, moves, emits, log = chain.expected(sequences)
    for got, i in ((starts, 1), (moves, 2), (emits, 3)):
        assert np.allclose(got, sum(b[i] for b in brute), atol=1e-4)
    assert np.isclose(log, sum(np.log10(b[0]) for b in brute), atol=1e-4)
    assert len(chain.forward([])) == 0 and chain.expected([])[3] == 0


def test_training_raises_the_likelihood(spark):
    rng = np.random.default_rng(4)
    texts = [(rng.integers(0, 4, 60) + 4 * (i % 2)).astype("<u2") for i in range(200)]
    table = spark.createDataFrame([(i, bytearray(t.tobytes())) for i, t in enumerate(texts)], "uid long, classes binary")
    logs = [hmm.train(table, 8, 2, n).forward(texts).sum() for n in (0, 1, 4)]
    assert logs[0] <= logs[1] <= logs[2] + 1e-6 and logs[2] > 200 * 60 * np.log10(1 / 4) - 200


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")), None]


def test_language_model_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()]
    c = Counter(w for i, t in docs if crc_fold_value(i, 7) != 2 for w in tokens(t))
    n, v = c.total(), len(c)
    rows = {r.doc_id: r for r in op9_hmm(spark, MIDDLE).collect()}
    assert set(rows) == {i for i, _ in docs}
    gain = 0.0
    for i, t in docs:
        words, r = tokens(t), rows[i]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
        gain += r.score - r.base_score if r.held_out else 0
        assert r.held_out == (crc_fold_value(i, 7) == 2)
    assert gain > 0


def test_small_heads_give_the_same_base_and_a_whole_distribution(spark):
    """The next word after a context: all known words and one unknown of each class have probability 1 together."""
    docs = spark.createDataFrame([(1, "a b a c dd ee a b"), (2, "b b ff"), (3, None)], "doc_id long, text string")
    words = ["a", "b", "c", "dd", "ee", "ff"]
    for head, own in ((3, 2), (100, 1), (100, 99)):
        probes = docs.union(spark.createDataFrame([(10 + i, w) for i, w in enumerate([*words, ""])], docs.schema))
        scored = hmm.score_texts(probes, F.col("doc_id") < 10, 2, 2, head, own)
        rows = {r.doc_id: r for r in scored.collect()}
        assert rows[3].n_tokens == 1 and rows[3].base_score == pytest.approx(math.log10(4 / (14 + 7 + 1)))
        assert rows[1].base_score == pytest.approx(sum(math.log10((k + 1) / 22) for k in (3, 4, 3, 1, 1, 1, 3, 4, 3)))
    counts = hmm.word_counts(docs)
    lex = hmm.lexicon(counts, 3, 2)
    per_class = defaultdict(float)
    for r in counts.collect():
        word = bytes(r.token)
        if word in lex.head:
            at = lex.classes[lex.head.index(word)]
        else:
            at = lex.own + 1 + hmm.ending_class(word)
        per_class[int(at)] += 10 ** float(lex.word_log(np.array([r.c]), np.array([at]))[0])
    for at, known in per_class.items():
        unknown = 10 ** float(lex.word_log(np.array([0]), np.array([at]))[0]) if at > lex.own else 0
        assert known + unknown == pytest.approx(1)


def test_scores_do_not_depend_on_the_layout(spark, sf_dir):
    """The same rows in one partition, in five by id, and in reverse order: equal up to the rounding of sums."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    learn = crc_fold("doc_id", 7) != 2
    layouts = [docs.repartition(1), docs.repartition(5, "doc_id"), docs.orderBy(F.desc("doc_id")).coalesce(2)]
    found = [{r.doc_id: r.score for r in hmm.score_texts(d, learn).collect()} for d in layouts]
    for other in found[1:]:
        assert max(abs(other[i] / s - 1) for i, s in found[0].items()) < 1e-4


def test_first_stretches_are_the_same_in_any_layout(spark):
    rng = np.random.default_rng(9)
    rows = [(i, bytearray(rng.integers(0, 50, int(rng.integers(1, 2000))).astype("<u2").tobytes())) for i in range(300)]
    table = spark.createDataFrame([*rows, *rows[:50]], "uid long, classes binary")
    drawn = [[s.tolist() for s in hmm.first_stretches(table.repartition(n), 20)] for n in (1, 7)]
    assert drawn[0] == drawn[1] and len(drawn[0]) == 20 and any(len(s) < hmm.STRETCH for s in drawn[0])


def test_language_model_odd_rows(odd_docs, no_docs):
    rows = hmm.score_texts(odd_docs, F.col("doc_id") != 7, 2, 1).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.n_tokens, r.score) for r in rows if r.doc_id in (3, 4, 5)}.__len__() == 1
    assert hmm.score_texts(no_docs, F.lit(True), 2, 1).collect() == []
    nothing = hmm.score_texts(odd_docs, F.lit(False), 2, 1).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in nothing} == {(0, 0, 0.0)}
