"""Fill-in-the-middle by a piece table: a document is a list of descriptors over immutable buffers."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm.common import map_slices

SEED = 42
# parts of 100 documents that are transformed, and of 100 of those that start with the suffix
FIM_RATE, SPM_RATE = 50, 80
# the sentinel buffer, and each sentinel's place in it
SENTINELS = b"<P><S><M>"
PREFIX, SUFFIX, MIDDLE = range(3)
# which pieces follow each other, each behind its sentinel; the middle's is always last
ARRANGEMENTS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
# the order of the pieces in the text
READING = (PREFIX, MIDDLE, SUFFIX)


def sentinel(part: int) -> bytes:
    return SENTINELS[3 * part : 3 * part + 3]


# a part of a buffer: (number of the buffer, first byte, byte after the last)
Descriptor = tuple[int, int, int]


@dataclass
class PieceTable:
    """Descriptors over buffers that never change: edits split and permute descriptors, no byte is moved."""

    buffers: tuple[bytes, ...]
    pieces: list[Descriptor]

    def cut(self, at: int) -> None:
        """Split the descriptor that holds byte ``at`` of the sequence; at a border an empty descriptor comes between."""
        for i, (buffer, start, stop) in enumerate(self.pieces):
            if at <= stop - start:
                self.pieces[i : i + 1] = [(buffer, start, start + at), (buffer, start + at, stop)]
                return
            at -= stop - start
        raise ValueError("cut behind the end")

    def permuted(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def views(self):
        for buffer, start, stop in self.pieces:
            yield memoryview(self.buffers[buffer])[start:stop]

    def sha256(self) -> str:
        """The digest of the sequence, streamed from the descriptors."""
        digest = hashlib.sha256()
        for view in self.views():
            digest.update(view)
        return digest.hexdigest()

    def content(self) -> bytes:
        return b"".join(self.views())


def token_ends(text: bytes) -> np.ndarray:
    """The byte after each token: words with the white space before them, and white space that ends the text."""
    raw = np.frombuffer(text, np.uint8)
    word = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
    ends = np.flatnonzero(word & ~np.append(word[1:], False)) + 1
    return np.append(ends, len(raw)) if len(raw) and not word[-1] else ends


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, ...]:
    """The first four 32-bit numbers of the digest of seed and id; a null id counts as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def characters(text: bytes | memoryview) -> int:
    """Code points of UTF-8 bytes."""
    raw = np.frombuffer(text, np.uint8)
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def transform(text: bytes, doc_id: int | None, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, PieceTable, int | None, int | None]:
    """(tokens, form, the arranged sequence, code points of prefix and middle or None) of one document."""
    ends = token_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    table = PieceTable((text, SENTINELS), [(0, 0, len(text))])
    if not text or h3 % 100 >= fim_rate or any(sentinel(part) in text for part in ARRANGEMENTS["psm"]):
        return n, "plain", table, None, None
    units = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, last = (int(ends[u - 1]) if u else 0 for u in units)
    table.cut(first)
    table.cut(last)
    chars = [characters(view) for view in table.views()]
    # the cut pieces stand in reading order; the sentinels are descriptors of their own
    table.pieces += [(1, 3 * part, 3 * part + 3) for part in range(3)]
    form = "spm" if h4 % 100 < spm_rate else "psm"
    order = tuple(i for part in ARRANGEMENTS[form] for i in (3 + part, READING.index(part)))
    return n, form, table.permuted(order), chars[0], chars[1]


def restored(output: bytes, form: str) -> PieceTable:
    """The text's sequence, rebuilt from an output and its form alone: descriptors over the output, put back in reading order."""
    if form == "plain":
        return PieceTable((output,), [(0, 0, len(output))])
    arranged, pieces, at = ARRANGEMENTS[form], [], 0
    for part, after in zip(arranged, [*arranged[1:], None], strict=True):
        start = at + len(sentinel(part))
        at = len(output) if after is None else output.index(sentinel(after), start)
        pieces.append((0, start, at))
    return PieceTable((output,), pieces).permuted(tuple(arranged.index(part) for part in READING))


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, output_sha256) for every row of (doc_id, text).

    ``n`` counts tokens, at borders of which the text is cut in prefix, middle and suffix by numbers drawn from the id;
    ``form`` is plain, psm or spm; a text that is empty or holds a sentinel stays plain.  A null text is empty, a null id
    draws like an empty one, repeated rows give repeated rows, texts of any length are transformed whole (a task holds
    one, some 20 times); other columns are ignored; no rows in, no rows out.
    """

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, rows = batch.column("doc_id"), []
        for doc_id, text in zip(ids.to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            n, form, table, before, middle = transform(text or b"", doc_id, seed, fim_rate, spm_rate)
            rows.append((n, form, before, middle, table.content(), table.sha256()))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        made[4] = made[4].cast(pa.string())
        return pa.RecordBatch.from_arrays([ids, *made], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"])

    cut = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"
    return map_slices(cut, "text", schema, kernel)


def restore(rows: DataFrame, keep_text: bool = True) -> DataFrame:
    """Rows of ``fill_in_middle`` with the text rebuilt from output and form (``restored``) and its digest.

    Without ``keep_text`` the digest alone is streamed from the descriptors, and output and text are left out.
    """
    kept = rows.drop("restored", "restored_sha256")
    left = kept if keep_text else kept.drop("output")
    names, fields = left.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        outputs, forms = batch.column("output").cast(pa.binary()).to_pylist(), batch.column("form").to_pylist()
        tables = [restored(output, form) for output, form in zip(outputs, forms, strict=True)]
        found = batch.select(names)
        if keep_text:
            found = found.append_column("restored", pa.array([t.content() for t in tables], pa.binary()).cast(pa.string()))
        return found.append_column("restored_sha256", pa.array([t.sha256() for t in tables], pa.string()))

    return map_slices(kept, "output", fields + (", restored string" if keep_text else "") + ", restored_sha256 string", kernel)
