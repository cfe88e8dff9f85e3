"""Fill-in-the-middle: tokens by pattern, plain string arrangement, round trips, SQL for whole tables."""

import hashlib
import random
import re

import pytest

import __spark_entry__ as entry
from kindred.llm import fim
from tests.compare import compare, connect

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(text, doc_id):
    """(n, form, prefix, middle, output) with strings."""
    tokens = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_against_strings():
    rng = random.Random(2)
    forms = set()
    for doc_id in range(3000):
        text = "".join(rng.choices(["a", "é", "🙂", " ", "\n", "\t\x0b\x0c\r", "\x85", "\xa0", "<", "P>", "<S", ">", "<M> ", "word "], [4, 4, 2, 4, 2, 1, 1, 1, 2, 1, 1, 1, 0.2, 6], k=rng.randint(0, 40)))
        n, form, table, before, middle = fim.transform(text.encode(), doc_id)
        assert (n, form, before, middle, table.content().decode()) == plain(text, doc_id)
        assert table.sha256() == hashlib.sha256(table.content()).hexdigest()
        assert fim.restored(table.content(), form).content().decode() == text
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


def test_tokens_by_pattern():
    rng = random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choices("ab  \t\né", k=rng.randint(0, 15)))
        ends = [len(text[: found.end()].encode()) for found in TOKEN.finditer(text)]
        assert fim.token_ends(text.encode()).tolist() == ends


def test_piece_table():
    table = fim.PieceTable((b"abcdef", b"XY"), [(0, 0, 6)])
    table.cut(2)
    table.cut(4)
    table.cut(6)
    assert [bytes(v) for v in table.views()] == [b"ab", b"cd", b"ef", b""]
    table.cut(0)
    assert [bytes(v) for v in table.views()] == [b"", b"ab", b"cd", b"ef", b""]
    assert table.permuted((3, 1)).content() == b"efab"
    with pytest.raises(ValueError):
        table.cut(7)


@pytest.mark.parametrize("text", [" " * 2_000_000, "w" * 2_000_000, "é🙂" * 400_000, "a \n" * 500_000])
def test_very_long_texts(text):
    doc_id = next(i for i in range(100) if plain("x", i)[1] != "plain")
    n, form, table, before, middle = fim.transform(text.encode(), doc_id)
    assert (n, form, before, middle, table.content().decode()) == plain(text, doc_id) and form != "plain"
    assert fim.restored(table.content(), form).content().decode() == text


def test_odd_rows(odd_docs, no_docs):
    made = fim.fill_in_middle(odd_docs)
    back = fim.restore(made)
    texts = sorted((str(r.doc_id), r.text or "") for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.restored) for r in back.collect()) == texts
    for r in back.collect():
        expected = plain(r.restored, "" if r.doc_id is None else r.doc_id)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected
        assert r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
    assert fim.restore(fim.fill_in_middle(no_docs)).collect() == []


def test_rates(odd_docs):
    assert {r.form for r in fim.fill_in_middle(odd_docs.where("length(text) > 0"), fim_rate=100, spm_rate=0).collect()} == {"psm"}
    assert {r.form for r in fim.fill_in_middle(odd_docs, fim_rate=0).collect()} == {"plain"}


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), entry.queries()["op12_fim"], entry.oracle_sql()["op12_fim"], sf_dir) is None
