"""Conversation structure repair by weighted CYK parsing.

A repaired conversation has role initials ``(s?(ua)+)?``.  The repair grammar has a nonterminal for each pair of points
that a conversation can reach in this pattern: (p, q) derives the rows that lead from p to q.  Its rules are in Chomsky
normal form: (p, r) becomes (p, q) (q, r), or one row that is kept, given another role or deleted.  Inserted rows are
not in the input; the cheapest ones between two points are the closure that surrounds every row.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kindred.llm.streams import BLANKS, batches_of, in_order, rows_of

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# points: nothing yet, after the system row, after a user row, after an assistant row; a repaired conversation ends in ENDS
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
POINTS, ENDS = range(4), (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
# rows that one chart covers; cells of consecutive charts are combined like those of two spans
CHART = 16

# minimum (cost, audit) by nonterminal: first by the point it starts from, then by the one it leads to
Cell = dict[int, dict[int, tuple[int, str]]]


def add(cell: Cell, left: Cell, right: Cell) -> Cell:
    """``cell`` with what two neighbouring spans derive by all rules (p, r) -> (p, q) (q, r), as far as it is less."""
    for p, ways in left.items():
        best = cell.setdefault(p, {})
        for q, (c, a) in ways.items():
            for r, (d, b) in right[q].items():
                known = best.get(r)
                if known is None or c + d < known[0] or c + d == known[0] and a + b < known[1]:
                    best[r] = c + d, a + b
    return cell


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    return add({}, left, right)


def _insertions() -> Cell:
    """The closure: the cheapest inserted user and assistant rows between any two points."""
    step: Cell = {p: {p: (0, "")} for p in POINTS}
    for (p, initial), q in STEPS.items():
        if initial in ROLES:
            step[p][q] = INSERT, "I"
    return combine(combine(step, step), step)


INSERTIONS = _insertions()


@functools.cache
def leaf(kind: str) -> Cell:
    """The cell of one row.

    ``kind`` is ``-`` for a row that must go, else the initial of its role (any other letter: no role of the pattern), as
    a capital if the row is truncated.
    """
    row: Cell = {p: {p: (DELETE, "D")} for p in POINTS}
    if kind != "-":
        extra = TRUNCATED if kind.isupper() else 0
        for (p, initial), q in STEPS.items():
            if initial == kind.lower():
                row[p][q] = KEEP + extra, "K"
            elif initial in ROLES:
                row[p][q] = REROLE + extra, "R"
    return combine(combine(INSERTIONS, row), INSERTIONS)


@functools.lru_cache(maxsize=20_000)
def chart(kinds: str) -> Cell:
    """The cell of a short span by a whole CYK chart: spans of growing length, each over all its splits."""
    n = len(kinds)
    cells = {(i, i + 1): leaf(kind) for i, kind in enumerate(kinds)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = {}
            for k in range(i + 1, i + length):
                add(cell, cells[i, k], cells[k, i + length])
            cells[i, i + length] = cell
    return cells[0, n]


def parse(kinds: str) -> tuple[int, str]:
    """The least cost of a repair and the first in ASCII order of the audits with that cost.

    The audit has one letter an edit, in order: K(eep), R(erole), D(elete), I(nsert).  Rows beyond one chart are parsed
    in charts of ``CHART`` rows, the cells of which are combined in spans of doubling length.  This gives the same as
    a chart of all rows, as every nonterminal derives a span over any of its splits, and takes time in proportion to
    the rows.  No audit is the beginning of another with the same cost, so the least of parts make up the least whole.
    """
    if not kinds:
        return 0, ""
    cells = [chart(kinds[i : i + CHART]) for i in range(0, len(kinds), CHART)]
    while len(cells) > 1:
        cells = [combine(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return min(cells[0][0][end] for end in ENDS)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the faults that a hash of conversation and turn deals out.

    Of 20 hash values 0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes it the
    user's.  Null roles and texts, and null ids and turns in the hash, count as one space.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = F.pmod(F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")), F.lit(20))
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(said[3], "[.!?]", "")).otherwise(said[3])
    role = F.when(fault == 4, "user").otherwise(said[2])
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))).alias("copy")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


# the order of a conversation's rows; rows of one turn come by role and a hash of the text, so that equal rows are neighbours
def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


FOUND = pa.schema(
    [("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())]
)
FOUND_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _parse_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple]:
        for conv, rows in groupby(rows_of(batches), itemgetter(0)):
            faults, kinds, illegal, before, turns, low, last = [0, 0, 0, 0], [], 0, None, 0, None, None
            for _, turn, initial, fault in rows:
                faults[fault] += 1
                illegal += before is not None and before + initial not in LEGAL
                before = initial
                if turn is not None and turn != last:
                    turns, last = turns + 1, turn
                    low = turn if low is None else low
                own = initial if initial in ("s", "u", "a") else "x"
                kinds.append("-" if fault in (1, 2) else own.upper() if fault == 3 else own)
            cost, audit = parse("".join(kinds))
            yield conv, last - low + 1 - turns if turns else 0, faults[1], faults[2], faults[3], illegal, cost, audit

    yield from batches_of(found(), FOUND, text=len(FOUND) - 1)


def audits(conversations: DataFrame) -> DataFrame:
    """Faults and the cheapest repair of every conversation of rows (conv_id, turn, role, text).

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): turns missing between the first and the last;
    rows by their first fault, which is to be blank, to repeat role and text of an earlier row, or to end without
    ``[.!?]``; neighbours that may not follow each other; the least cost of edits and the first audit of that cost.

    Rows are taken by turn, nulls first, rows of one turn by role and a hash of the text.  Null roles and texts count as
    one space, rows with a null id are one conversation, other columns are ignored; no rows in, no rows out.  A task
    holds a letter for each row of a conversation and texts of none, however long they are: texts stay out of the shuffle.
    """
    rows = _turns(conversations)
    # trimming, unlike a pattern, takes linear time on long white space
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.substring(end, -1, 1)
    slim = rows.select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"), last.alias("last")
    )
    together = slim.repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = F.when(F.col("blank"), 1).when(F.col("again"), 2).when(~F.col("last").isin(*".!?"), 3).otherwise(0)
    marked = together.withColumn("again", again).withColumn("fault", fault)
    return marked.sortWithinPartitions("conv_id", *_order(), "again").select("conv_id", "turn", "initial", "fault").mapInArrow(_parse_rows, FOUND_SQL)


REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
REPAIRED_SQL = "conv_id long, place long, edit string, turn long, role string, text string"


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows from sorted rows (conv_id, audit, turn, role, text), the first of which in a conversation has its audit."""

    def edited(edits: Iterator[str], rows: Iterable[tuple]) -> Iterator[tuple]:
        """(edit, row) for each edit; an inserted row has none."""
        for row in rows:
            for edit in edits:
                yield edit, None if edit == "I" else row
                if edit != "I":
                    break
        for edit in edits:
            yield edit, None

    def repaired() -> Iterator[tuple]:
        for conv, rows in groupby(rows_of(batches, "text"), itemgetter(0)):
            point = place = 0
            audit = next(rows)[1]
            for edit, row in edited(iter(audit), rows):
                if edit == "D":
                    continue
                _, _, turn, role, text = row or (conv, None, None, None, "")
                initial = role[0] if edit == "K" else "a" if point == 2 else "u"
                yield conv, place, edit, turn, role if edit == "K" else ROLES[initial], text
                point, place = STEPS[point, initial], place + 1

    yield from batches_of(repaired(), REPAIRED, text=len(REPAIRED) - 1)


def repair(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows (conv_id, place, edit, turn, role, text) of rows (conv_id, turn, role, text) and their ``audits``.

    ``place`` counts from 0 without gaps; inserted rows have no turn and an empty text.  Rows of a conversation
    follow each other in one partition, in order of place.  A conversation of any length is a stream: a task holds its
    audit and one slice of its texts.
    """
    first = found.select("conv_id", "audit", *(F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "string"))))
    rows = _turns(conversations).select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", F.sha2("text", 256).alias("digest"))
    sorted_rows = in_order(first.union(rows), "conv_id", F.col("audit").isNull(), *_order())
    return sorted_rows.select("conv_id", "audit", "turn", "role", "text").mapInArrow(_apply, REPAIRED_SQL)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of rows as ``repair`` gives them: of ``role:text``, joined by newlines, as a stream."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def streamed() -> Iterator[tuple]:
            for conv, rows in groupby(rows_of(batches, "text"), itemgetter(0)):
                digest = hashlib.sha256()
                for _, place, role, text in rows:
                    digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
                yield conv, digest.hexdigest()

        yield from batches_of(streamed(), schema)

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")
