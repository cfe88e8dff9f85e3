import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindred.llm import bpe
from kindred.llm.queries import op7_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_decoded_text_equal_the_library(library):
    own = bpe.Codec(PATH)
    rng = random.Random(3)
    letters = "abcABC xyz'’sté ÉñÑß İıΣσς ſK Å é \x1c\x1d\x85\xa0 ​﻿ 123½²٣ 中文 🙂👍🏽 á̧ <|endoftext|> \t\n\x00 !!! *** 's 're ǅ ŉ ﬁ 한국"
    texts = ["", "a", "<|endoftext|>", "x<|startoftext|>y z<|endoftext|>", "Hello WORLD's don't", "a" * 5000, "ΑΣ ΣΑΣ"]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(1500)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        mine = own.encode(text)
        assert np.frombuffer(mine, "<u4").tolist() == ids
        assert own.decode(mine) == library.decode(ids, skip_special_tokens=False)


def test_forgetting_changes_nothing(library):
    own = bpe.Codec(PATH)
    own.known_words, own.known_runs = bpe.Remembered(3), bpe.Remembered(2)
    text = " ".join(f"word{i % 7} and{i % 5}!!" for i in range(200))
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def brute_merge(symbols, ranks, merged):
    symbols = list(symbols)
    while True:
        best = min(((ranks[a << 32 | b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 32 | b in ranks), default=None)
        if best is None:
            return symbols
        symbols[best[1] : best[1] + 2] = [merged[best[0]]]


def test_merges_against_brute_force():
    own = bpe.Codec(PATH)
    rng = random.Random(1)
    for _ in range(300):
        raw = "".join(rng.choices("aethnors", k=rng.randint(1, 30))).encode()
        symbols = [own.inner[b] for b in raw[:-1]] + [own.last[raw[-1]]]
        assert own.merge(list(symbols)) == brute_merge(symbols, own.ranks, own.merged)


def test_query_on_whole_documents(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op7_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(odd_docs, no_docs):
    rows = bpe.decode(bpe.encode(odd_docs, PATH), PATH).collect()
    assert len(rows) == odd_docs.count()
    assert all(bytes(r.ids) == b"" and r.decoded == "" for r in rows if r.doc_id in (3, 4, 5))
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).collect() == []
    with_null = odd_docs.selectExpr("doc_id", "cast(null as binary) as ids", "1 as decoded").limit(1)
    assert bpe.decode(with_null, PATH).first().decoded == ""
