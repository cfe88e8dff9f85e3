import random
import re

import numpy as np
import pytest

from kindred.llm import repetition as rep
from kindred.llm.queries import op3_repetition


def brute_reach(words):
    out = [0] * len(words)
    for i in range(len(words)):
        for j in range(len(words)):
            if i != j:
                k = 0
                while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                    k += 1
                out[i] = max(out[i], k)
    return out


def brute_maximal(words, least):
    places = {}
    for n in range(least, len(words) + 1):
        for i in range(len(words) - n + 1):
            places.setdefault(tuple(words[i : i + n]), []).append(i)
    found = set()
    for part, at in places.items():
        right = {words[i + len(part)] if i + len(part) < len(words) else ("end", i) for i in at}
        left = {words[i - 1] if i else ("start", i) for i in at}
        if len(at) > 1 and len(right) > 1 and len(left) > 1:
            found.add((min(at), len(part), len(at)))
    return found


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array_against_brute_force(seed):
    rng = random.Random(seed)
    docs = [[str(rng.randint(0, rng.choice([1, 3, 9]))).encode() for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 5))]
    codes, starts, n = rep.encode_words(docs)
    own = starts[n > 0]
    array = rep.suffix_array(codes, own)
    assert rep.reach(array).tolist() == [x for d in docs for x in brute_reach(d)]
    expected = sorted((int(s) + a, b, c) for d, s in zip(docs, starts, strict=True) for a, b, c in brute_maximal(d, 2))
    assert sorted(rep.maximal_repeats(array, codes, own, 2)) == expected


def brute_row(text, min_repeat=rep.MIN_REPEAT, max_covered=rep.MAX_COVERED, max_longest=rep.MAX_LONGEST):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    again = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    reach = brute_reach(words)
    inside = {j for i, k in enumerate(reach) if k >= min_repeat for j in range(i, i + k)}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    kept = not failed and len(inside) <= max_covered * len(words) and max(reach, default=0) <= max_longest
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(again), failed, kept)


def figures(got, i):
    return tuple(got[k][i].item() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


def test_figures_against_brute_force():
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(30)]
    texts = [None, "", " \n", "a\n\na\n a"]
    for _ in range(60):
        words = [rng.choice(["é", "b#", "c", "dd", f"w{rng.randint(0, 300)}"]) for _ in range(rng.randint(0, 90))]
        for _ in range(rng.choice([0, 0, 2, 3])):
            at = rng.randint(0, len(words))
            words[at:at] = passage
        texts.append("".join(w + rng.choice([" ", "\n", " ", "\t"]) for w in words))
    got = rep.measure([t if t is None else t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert figures(got, i) == brute_row(text), i


def test_query_on_whole_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op3_repetition(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        if len(texts[r.doc_id]) < 4000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == brute_row(texts[r.doc_id])


def test_a_long_passage_that_comes_twice_is_rejected(spark):
    clean = " ".join(f"word{i}" for i in range(400))
    long_passage = " ".join(f"again{i}" for i in range(120))
    half = " ".join(f"half{i}" for i in range(60))
    docs = spark.createDataFrame([(1, clean), (2, f"{long_passage} {clean} {long_passage}"), (3, f"{half} x {half}")], "doc_id long, text string")
    kept = {r.doc_id: (r.kept, r.base_failed, r.longest_repeat, r.n_covered) for r in rep.repetition(docs).collect()}
    assert kept[1][0] and kept[2] == (False, False, 120, 240)
    assert not kept[3][0]
    assert {r.doc_id for r in rep.keep_unrepetitive(docs).collect()} == {1}
    assert [tuple(r) for r in rep.repeated_substrings(docs.where("doc_id = 2")).collect()] == [(2, 0, 120, 2)]


def test_odd_rows(odd_docs, no_docs):
    rows = rep.repetition(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (3, 4, 5))
    kept = rep.keep_unrepetitive(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {6}
    assert rep.repetition(no_docs).collect() == [] == rep.keep_unrepetitive(no_docs).collect()
    assert np.array_equal(rep.suffix_array(np.zeros(0, np.int64), np.zeros(0, np.int64)).lcp, [])
