"""Chat formatting: round trips of hostile turns, whole conversations, the loss mask, SQL for whole tables."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

import __spark_entry__ as entry
from kindred.llm import chat
from tests.compare import compare, connect

TURNS = "conv_id long, turn long, role string, text string, formatted string, loss_start int"
# control strings, parts of them, escaped ones
PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "<", "/s>", "s>", "[", "/INST]", "INST]", "\\", "\\\\", "é🙂", " ", "\n", "ok"]
content = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)
roles = st.one_of(st.sampled_from(["system", "user", "assistant", "tool", ""]), content)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(roles, content), max_size=6))
def test_whole_conversations_read_back(turns):
    made = [chat.format_turn(role, text) for role, text in turns]
    assert chat.parse("".join(m[0] for m in made)) == turns
    for (_, text), (formatted, start, stop, rounds) in zip(turns, made, strict=True):
        assert chat.unescape(formatted[start:stop]) == text
        assert not chat.CONTROL.search(formatted[start:stop])
        assert rounds <= 1


@settings(max_examples=500, deadline=None)
@given(content)
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat.CONTROL.search(chat.escape(text))


def test_only_conflicting_content_is_escaped():
    assert chat.format_turn("user", "a < b [x] \\ <b>") == ("[INST]a < b [x] \\ <b>[/INST]", 6, 21, 0)
    assert chat.format_turn("assistant", "</s>[INST] ok [/INST]")[0] == "<\\/s>[\\INST] ok [\\/INST]</s>"
    assert chat.format_turn("user", "<\\/s>")[0] == "[INST]<\\\\/s>[/INST]"
    assert chat.format_turn("user", "[SYS]")[0] == "[INST][\\SYS][/INST]"


@pytest.mark.parametrize("text", ["[INST]open", "loose", "[INST]a[/SYS]", "[INST]a<s>[/INST]", "x[INST]a[/INST]", "[ROLE]a</s>", "[/INST]", "<s>", "a</s>b"])
def test_what_the_grammar_forbids(text):
    with pytest.raises(ValueError):
        chat.parse(text)


def brute(rows):
    """What must be read back, by conversation."""
    out = {}
    for conv, turn, role, text, *_ in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    found = {}
    for conv, turns in out.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        found[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return found


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "</s>", "x", 1), (1, 0, "user", None, "x", 1), (1, None, None, "first", "x", 1), (2, None, None, None, None, None)]
    rows += [(3, 0, "assistant", ""), (3, 1, "assistant", "[/INST]" * 1000), (3, 1, "assistant", "[/INST]" * 1000), (None, 0, "user", "no id")]
    rows += [(4, 0, "user", "[" * 1_000_000 + "\\" * 1_000_000), (4, 1, "assistant", " " * 2_000_000), (4, 2, "assistant", "<" + "\\" * 1_000_000 + "/s>")]
    rows += [(5, i, ("user", "assistant")[i % 2], f"row {i} <s>") for i in range(20_000)]
    rows = [(*r, "x", 1)[:6] for r in rows]
    read = chat.read_back(chat.format_chats(spark.createDataFrame(rows, TURNS).repartition(4))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read} == brute(rows)
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], TURNS))).collect() == []


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), entry.queries()["op13_chat"], entry.oracle_sql()["op13_chat"], sf_dir) is None


def test_the_planted_conversation(spark, sf_dir):
    row = next(r for r in entry.queries()["op13_chat"](spark, sf_dir).collect() if r.conv_id == -1)
    said = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(said)
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
