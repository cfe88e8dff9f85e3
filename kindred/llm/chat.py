"""Chat formatting with a grammar round trip.

The template marks every turn: ``[SYS]text[/SYS]`` for the system, ``[INST]text[/INST]`` for the user, ``text</s>`` for
the assistant, ``[ROLE]name[/ROLE]text</s>`` for anyone else.  A deterministic parser reads rendered text back; a turn
that does not come back identical has the control strings in its content escaped by a backslash after their first letter
(one more if there are some), and is rendered and read again until it does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kindred.llm.common import map_slices
from kindred.llm.streams import batches_of, in_order, rows_of

BEGIN, END = "<s>", "</s>"
# role -> the strings around its text; other roles: NAMED around the name, then the text and END
TEMPLATE = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("", END)}
NAMED = ("[ROLE]", "[/ROLE]")
LEARNED = "assistant"

CONTROL = re.compile(r"(<s>|</s>|\[/?(?:SYS|INST|ROLE)\])")
# the first letter of a control string, behind which any number of backslashes may stand; and with one that stands there
FIRST = re.compile(r"<(?=\\*/?s>)|\[(?=\\*/?(?:SYS|INST|ROLE)\])")
MARKED = re.compile(r"([<\[])\\(?:(?<=<\\)(?=\\*/?s>)|(?<=\[\\)(?=\\*/?(?:SYS|INST|ROLE)\]))")


def escape(content: str) -> str:
    """One more backslash in every control string, so that none is left; other content is unchanged."""
    return FIRST.sub(lambda found: found[0] + "\\", content)


def unescape(content: str) -> str:
    return MARKED.sub(r"\1", content)


def render(role: str, name: str, text: str) -> tuple[str, int]:
    """The marked turn of a role, and where its text begins; ``name`` is what is written for a role without marks."""
    if role in TEMPLATE:
        before, after = TEMPLATE[role]
    else:
        before, after = name.join(NAMED), END
    return before + text + after, len(before)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns (role, text) of rendered text; a ValueError if the grammar does not allow it.

    Plain text and control strings alternate.  The string at hand decides what must follow, so nothing is read twice.
    """
    opened = {before: (role, after) for role, (before, after) in TEMPLATE.items() if before}
    tokens = CONTROL.split(rendered)
    turns, at = [], 0

    def expect(control: str) -> None:
        nonlocal at
        if at + 1 >= len(tokens) or tokens[at + 1] != control:
            raise ValueError(f"expected {control}")
        at += 2

    while at + 1 < len(tokens):
        control = tokens[at + 1]
        if control in opened or control == NAMED[0]:
            if tokens[at]:
                raise ValueError("text before a turn")
            expect(control)
        if control in opened:
            role, after = opened[control]
        elif control == NAMED[0]:
            role, after = unescape(tokens[at]), END
            expect(NAMED[1])
        else:
            role, after = LEARNED, END
        text = tokens[at]
        expect(after)
        turns.append((role, unescape(text)))
    if tokens[at]:
        raise ValueError("text after the last turn")
    return turns


def reads_as(rendered: str, role: str, text: str) -> bool:
    try:
        return parse(rendered) == [(role, text)]
    except ValueError:
        return False


def format_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """(formatted, start, stop, rounds): the turn as it reads back identical, the place of its text, and how often it was escaped.

    One round is enough: it leaves no control string in the content, and unescaping takes away what it added.
    """
    name, body, rounds = role, text, 0
    formatted, start = render(role, name, body)
    while not reads_as(formatted, role, text):
        if rounds:
            raise AssertionError("an escaped turn does not read back")
        name, body, rounds = escape(name), escape(body), rounds + 1
        formatted, start = render(role, name, body)
    return formatted, start, start + len(body), rounds


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, formatted, loss_start, loss_stop, rounds) for every row of (conv_id, turn, role, text).

    The formatted text of a conversation is that of its turns in order (by number, nulls first, then by role): every turn is marked on its own and
    no border between turns makes a control string, so turns need no shuffle to be formatted.  The loss mask is
    the part of an assistant's turn that holds its text, in code points; others have none.  Null roles and texts are
    empty, texts of any length are formatted whole, equal rows stay rows, other columns are ignored; no rows in, no rows out.
    """

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
        made = [format_turn(role, text) for role, text in zip(roles, texts, strict=True)]
        learned = [role == LEARNED for role in roles]
        columns = [
            pa.array([m[0] for m in made], pa.string()),
            pa.array([m[1] if own else None for m, own in zip(made, learned, strict=True)], pa.int64()),
            pa.array([m[2] if own else None for m, own in zip(made, learned, strict=True)], pa.int64()),
            pa.array([m[3] for m in made], pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("turn"), batch.column("role"), *columns],
            names=["conv_id", "turn", "role", "formatted", "loss_start", "loss_stop", "rounds"],
        )

    said = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    cut = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *said)
    schema = "conv_id long, turn long, role string, formatted string, loss_start long, loss_stop long, rounds int"
    return map_slices(cut, "text", schema, kernel)


READ = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)
READ_SQL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def read() -> Iterator[tuple]:
        for conv, rows in groupby(rows_of(batches, "formatted"), itemgetter(0)):
            turns, loss, n, learned, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, formatted, start, stop in rows:
                chars += len(formatted)
                for role, text in parse(formatted):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                if start is not None:
                    masked = unescape(formatted[start:stop])
                    learned += len(masked)
                    loss.update(masked.encode())
            yield conv, n, turns.hexdigest(), learned, loss.hexdigest(), chars

    yield from batches_of(read(), READ)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the parser and the loss mask read in the rows of ``format_chats``, by conversation, turn by turn.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).  Turns come by number, nulls first, those
    of one number by role and text; rows with a null id are one conversation.  A conversation of any length is a stream
    of one task, which holds a slice of it.
    """
    order = (F.col("turn").asc_nulls_first(), F.col("role"), F.col("formatted"))
    return in_order(formatted, "conv_id", *order).select("conv_id", "formatted", "loss_start", "loss_stop").mapInArrow(_read, READ_SQL)
