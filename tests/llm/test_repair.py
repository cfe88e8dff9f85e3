"""Conversation repair: every edit sequence of short conversations, whole charts of longer ones, SQL for whole tables."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

import __spark_entry__ as entry
from kindred.llm import repair
from tests.compare import compare, connect

PATTERN = re.compile(r"(s?(ua)+)?")
TURNS = "conv_id long, turn long, role string, text string, audit string, place long, digest int"


def brute(kinds):
    """The least (cost, audit) over all edits, with up to two rows inserted in each gap."""
    gaps = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    best = None
    ways = []
    for kind in kinds:
        extra = 3 if kind.isupper() else 0
        own = [(4, "D", "")]
        if kind != "-":
            own += [(extra, "K", kind.lower()), (3 + extra, "R", "u"), (3 + extra, "R", "a")]
        ways.append(own)
    for inserted in product(gaps, repeat=len(kinds) + 1):
        for edits in product(*ways):
            roles = "".join(inserted[0]) + "".join(e[2] + "".join(g) for e, g in zip(edits, inserted[1:], strict=True))
            if PATTERN.fullmatch(roles):
                audit = "I" * len(inserted[0]) + "".join(e[1] + "I" * len(g) for e, g in zip(edits, inserted[1:], strict=True))
                found = (sum(e[0] for e in edits) + 3 * sum(map(len, inserted)), audit)
                best = found if best is None or found < best else best
    return best


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_every_short_conversation(n):
    rng = random.Random(n)
    every = ["".join(k) for k in product("suaxSUAX-", repeat=n)]
    for kinds in every if n < 3 else rng.sample(every, 60):
        assert repair.parse(kinds) == brute(kinds), kinds


def test_charts_of_parts_equal_one_whole_chart():
    rng = random.Random(7)
    for n in (15, 16, 17, 31, 33, 50):
        for letters in ("sua-", "uuaaUAx-s", "ua", "D-x"):
            kinds = "".join(rng.choices(letters.replace("D", "X"), k=n))
            whole = repair.chart.__wrapped__(kinds)
            assert repair.parse(kinds) == min(whole[0][end] for end in repair.ENDS)


def test_long_conversations_take_linear_time():
    cost, audit = repair.parse("ua" * 50_000 + "-")
    assert (cost, audit) == (4, "K" * 100_000 + "D")


def repaired(spark, rows):
    turns = spark.createDataFrame(rows, TURNS)
    found = repair.audits(turns)
    lines = {}
    for r in repair.repair(turns, found).collect():
        lines.setdefault(r.conv_id, []).append(r)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digests(repair.repair(turns, found)).collect()}
    for conv, own in lines.items():
        own.sort(key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own)))
        assert PATTERN.fullmatch("".join(r.role[0] for r in own))
        assert digests[conv] == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest()
    return {r.conv_id: r for r in found.collect()}, lines


def rows_of(conv, *said):
    return [(conv, turn, role, text, "x", 9, 1) for turn, role, text in said]


def test_faults_and_edits(spark):
    rows = rows_of(1, (0, "system", "Be brief."), (1, "user", "Hi?"), (2, "assistant", "Yes."), (5, "user", "More"), (5, "user", "More"), (6, "assistant", " \t"))
    rows += rows_of(2, (0, "assistant", "Begin."), (1, "tool", "Result!"))
    rows += rows_of(3, (0, "user", ""), (1, "user", None))
    rows += rows_of(4, (3, "user", "Same."), (None, "user", "Same."), (None, None, "Who?"))
    rows += rows_of(None, (0, "user", "No id."), (1, "assistant", "Fine."))
    found, lines = repaired(spark, rows)
    one = found[1]
    assert (one.gaps, one.blank, one.duplicate, one.truncated, one.illegal) == (2, 1, 1, 1, 1)
    # the truncated question goes, as keeping it asks for an answer as well
    assert (one.cost, one.audit) == (12, "KKKDDD")
    assert (found[2].cost, found[2].audit) == brute("ax")
    assert (found[3].blank, found[3].cost, found[3].audit) == (2, 8, "DD") and 3 not in lines
    assert (found[4].duplicate, found[4].gaps, found[4].illegal) == (1, 0, 2)
    assert found[None].audit == "KK" and [r.text for r in lines[None]] == ["No id.", "Fine."]


def test_very_long_rows_and_conversations(spark):
    blanks, word = " \t\n" * 700_000, "w" * 2_000_000
    rows = rows_of(1, (0, "user", blanks), (1, "user", word + blanks), (2, "assistant", word + "." + blanks))
    rows += rows_of(2, *((i, ("user", "assistant")[i % 2], f"Row {i}.") for i in range(30_000)))
    found, lines = repaired(spark, rows)
    assert (found[1].cost, found[1].audit) == (7, "DKK") and lines[1][0].text == word + blanks
    assert found[2].cost == 0 and len(lines[2]) == 30_000


def test_repeated_rows_and_hot_conversation(spark):
    rows = rows_of(7, *[(1, "user", "Again.")] * 5_000)
    found, _ = repaired(spark, rows)
    assert found[7].duplicate == 4_999 and found[7].cost == 3 + 4 * 4_999 and found[7].audit == "K" + "D" * 4_999 + "I"


def test_no_rows(spark):
    none = spark.createDataFrame([], TURNS)
    assert repair.audits(none).collect() == [] and repair.repair(none, repair.audits(none)).collect() == []
    assert repair.damage(none).collect() == []


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(60), None) for t, r, x in ((0, "system", "Ja. Nein!"), (None, None, None), (2, "assistant", "So?"))]
    got = repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    expected = []
    for c, t, r, x in rows:
        deal = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        made = (c, t, "user" if deal == 4 else r, "" if deal == 1 else re.sub("[.!?]", "", x) if deal == 2 else x)
        expected += [made] * (0 if deal == 0 else 2 if deal == 3 else 1)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), entry.queries()["op11_repair"], entry.oracle_sql()["op11_repair"], sf_dir) is None
