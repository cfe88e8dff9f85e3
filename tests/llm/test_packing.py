import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindred.llm import packing
from kindred.llm.queries import op1_pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_cover(lengths, windows):
    pieces = {}
    for size, parts in windows:
        assert sum(n for *_, n in parts) == size and size & (size - 1) == 0
        for doc, start, n in parts:
            pieces.setdefault(doc, []).append((start, n))
    for doc, length in enumerate(lengths):
        at = 0
        for start, n in sorted(pieces.get(doc, [])):
            assert start == at and n > 0
            at += n
        assert at == length


@pytest.mark.parametrize("seed", range(6))
def test_every_token_once_in_full_windows(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 130, 1024, rng.randint(1, 4000)]) for _ in range(rng.randint(0, 300))]
    windows = packing.pack_lengths(lengths)
    check_cover(lengths, windows)
    small = [w for w in windows if w[0] < min(packing.TIERS)]
    assert sum(size for size, _ in small) < min(packing.TIERS)


def test_documents_go_to_the_tier_of_their_length():
    windows = packing.pack_lengths([1024, 500, 250, 120] * 50)
    whole = [parts for size, parts in windows if size == 1024]
    assert len(whole) >= 50
    assert {size for size, _ in windows} >= {1024, 512}
    # one cut a window at most
    assert sum(len(parts) for _, parts in windows) <= 200 + len(windows)
    # gaps of long windows hold whole documents of shorter tiers
    filled = packing.pack_lengths([600, 250, 250, 120] * 50)
    assert any(sorted(n for *_, n in parts)[-3:] == [120, 250, 600] for _, parts in filled)


def test_step_groups_have_like_work():
    rng = random.Random(1)
    windows = packing.pack_lengths([rng.randint(1, 1500) for _ in range(4000)])
    groups = packing._groups(windows, 8)
    work = {}
    for (size, parts), group in zip(windows, groups, strict=True):
        if size == 1024:
            work.setdefault(group, []).append(sum(n * n for *_, n in parts))
    full = [sum(w) for w in work.values() if len(w) == 8]
    assert max(full) < 1.6 * min(full)


def test_ids_equal_the_library():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(5)
    letters = "abC xyz'’stéÉñß İΣς \x1c\x85\xa0​ 12½² 中文 🙂👍🏽 á <|endoftext|> \t\n !!! 's 're"
    texts = ["", "<|endoftext|>", *("".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(500))]
    for text, ids in zip(texts, packing.token_ids(texts, PATH), strict=True):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]


def check_rows(rows, texts):
    """``texts``: (doc_id, text) of each row; rows with equal ids are told apart by their starts."""
    library = Tokenizer.from_file(PATH)
    sequences, found = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        found.setdefault(r.doc_id, []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    for doc_id, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(found[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_query_packs_whole_documents(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check_rows(op1_pack(spark, sf_dir).collect(), texts)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs, PATH, block_tokens=1000).collect()
    own = {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
    assert [(r.length, r.doc_tokens) for r in own[3]] == [(1, 1)]
    assert set(own) == {r.doc_id for r in odd_docs.collect()}
    total = sum(len(i) for i in packing.token_ids([r.text for r in odd_docs.collect()], PATH))
    assert sum(r.length for r in rows) == total
    assert packing.pack(no_docs, PATH).collect() == []


def test_tiers_must_be_powers_of_two(no_docs):
    with pytest.raises(ValueError):
        packing.pack(no_docs, PATH, tiers=(100,))


LONG = {
    "spaces": " " * 2_000_000, "newlines": "\n" * 2_000_000, "mixed blanks": " \n\t " * 500_000, "blanks between words": "word" + " " * 1_500_000 + "end",
    "letters": "a" * 2_000_000, "other letters": "é" * 1_000_000, "digits": "7" * 2_000_000, "marks": "!" * 2_000_000, "words": "some words " * 180_000,
    "blank runs": ("x" + " " * 90_000) * 20,
}


@pytest.mark.parametrize("kind", LONG)
def test_very_long_texts_equal_the_library(kind):
    ids = Tokenizer.from_file(PATH).encode(LONG[kind], add_special_tokens=False).ids
    assert packing.token_ids([LONG[kind]], PATH)[0].tolist() == [*ids, packing.SEPARATOR]


def test_files_of_another_kind_are_left_to_the_library():
    other = public_tokenizers.path("word_bpe_49k.json")
    text = "Some WORDS, and numbers 123"
    assert packing.encoder(other) is None
    assert packing.text_ids(text, other) == Tokenizer.from_file(other).encode(text, add_special_tokens=False).ids
