"""Hierarchical multi-length packing.

Documents are routed to context-size tiers by length, each tier is packed into windows of its own size, gaps
of long windows are filled from shorter tiers, and windows of one tier are dealt into step groups of like
attention work.  Packing happens in the task that tokenizes, over blocks of a bounded number of tokens, so no
token is ever shuffled; a lost task makes the same windows again from the same rows.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from kindred.llm.common import slices

TIERS = (128, 256, 512, 1024)
# tokens packed together: more means fewer cuts, less means less memory in a task
BLOCK_TOKENS = 2_000_000
# windows of a step group
GROUP_WINDOWS = 8
SEPARATOR = 0

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
        ("step_group", pa.int64()), ("ids", pa.binary()),
    ]
)
PIECES_SQL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long, ids binary"
)


# white space in a row that the fast encoder's pattern may be given; it fails at about a million
LONG_BLANK = 100_000
BLANK = re.compile(r"\s+")


@functools.lru_cache(maxsize=2)
def library(path: str):
    import tokenizers

    return tokenizers.Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """A ``tiktoken`` encoder of a byte-level BPE file of the ``tokenizers`` library, or None for a file of another kind.

    Both give the same ids (tests compare them); this one needs a fifth of the time.  Special tokens are
    recognised in the text, as the file's own library does by default.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split, model = spec["pre_tokenizer"] or {}, spec["model"]
    plain_files = spec["normalizer"] is None and not any(model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    plain_tokens = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    # the pattern below is the one that this kind of file asks for without writing it out
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or not plain_files or not plain_tokens:
        return None
    # byte-level files write each byte as one printable character: printable bytes as themselves, others from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in plain}
    to_byte |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def text_ids(text: str, path: str) -> list[int]:
    """The ids of one text; the library itself encodes what the faster encoder cannot."""
    fast = encoder(path)
    if fast is None or len(text) > LONG_BLANK and any(m.end() - m.start() > LONG_BLANK for m in BLANK.finditer(text)):
        return library(path).encode(text, add_special_tokens=False).ids
    return fast.encode(text, allowed_special="all")


def token_ids(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Little-endian 32-bit ids of each text and the closing separator."""
    return [np.array([*text_ids(t or "", path), SEPARATOR], dtype="<u4") for t in texts]


class _Pool:
    """Unplaced pieces by length, with the longest that fits a gap found by one bit operation."""

    def __init__(self, longest: int):
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(longest + 1)]
        self.mask = 0

    def add(self, doc: int, start: int, length: int) -> None:
        if length:
            self.by_length[length].append((doc, start))
            self.mask |= 1 << length

    def take(self, length: int) -> tuple[int, int, int]:
        stack = self.by_length[length]
        doc, start = stack.pop()
        if not stack:
            self.mask &= ~(1 << length)
        return doc, start, length

    def longest(self, limit: int) -> int:
        """The greatest stored length up to ``limit``, or 0."""
        return (self.mask & ((1 << (limit + 1)) - 1)).bit_length() - 1 if self.mask & ((1 << (limit + 1)) - 1) else 0


def pack_lengths(lengths: Iterable[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows (tier, [(document, start, length), ...]) that hold each token of each document once.

    Whole windows of the longest tier are cut off long documents first.  The rest of a document belongs to the
    smallest tier that holds it.  From the longest tier down, a window takes the longest waiting document of its tier,
    then whole shorter ones that fit its gap best; what still gapes is cut off the next waiting document, whose rest
    goes back to the tier of its new length.  Documents too few to fill a window fall to shorter tiers, and the last
    tokens of a block take windows of halving sizes, so that none needs padding.
    """
    top = max(tiers)
    pool, windows = _Pool(top), []
    waiting = 0
    for doc, n in enumerate(lengths):
        whole = n // top * top
        windows += [(top, [(doc, s, top)]) for s in range(0, whole, top)]
        pool.add(doc, whole, n - whole)
        waiting += n - whole
    ladder = sorted(tiers, reverse=True)
    while ladder[-1] > 1:
        ladder.append(ladder[-1] // 2)
    for size, below in zip(ladder, [*ladder[1:], 0], strict=True):
        # longer tiers run while documents routed to them (or left by a longer one) wait; the shortest takes all the rest
        while waiting >= size and (size <= min(tiers) or pool.mask >> (below + 1)):
            gap, pieces = size, []
            while gap:
                length = pool.longest(gap)
                if length:
                    piece = pool.take(length)
                else:  # only longer documents wait: cut the shortest of them
                    doc, start, length = pool.take((pool.mask & -pool.mask).bit_length() - 1)
                    pool.add(doc, start + gap, length - gap)
                    piece = (doc, start, gap)
                pieces.append(piece)
                gap -= piece[2]
            windows.append((size, pieces))
            waiting -= size
    return windows


def _groups(windows: list[tuple[int, list]], group: int) -> list[int]:
    """Step groups: windows of one tier dealt in order of attention work, there and back, so that group sums are alike."""
    out = [0] * len(windows)
    base = 0
    for tier in sorted({t for t, _ in windows}):
        own = sorted((i for i, (t, _) in enumerate(windows) if t == tier), key=lambda i: -sum(p[2] ** 2 for p in windows[i][1]))
        n = -(-len(own) // group)
        for at, i in enumerate(own):
            lap, pos = divmod(at, n)
            out[i] = base + (pos if lap % 2 == 0 else n - 1 - pos)
        base += n
    return out


def _emit(ids: list[np.ndarray], doc_ids: list, first: int, tiers, group: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    windows = pack_lengths(map(len, ids), tiers)
    groups = _groups(windows, group)
    raw = [x.tobytes() for x in ids]
    rows: list[tuple] = []
    for at, ((tier, pieces), step) in enumerate(zip(windows, groups, strict=True)):
        offset = 0
        for doc, start, length in pieces:
            part = raw[doc][4 * start : 4 * (start + length)]
            rows.append((doc_ids[doc], start, length, zlib.crc32(part), len(ids[doc]), first + at, offset, tier, first + step, part if keep_ids else None))
            offset += length
        if len(rows) > 20_000 or at == len(windows) - 1:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)
            rows = []


def pack(
    docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, block_tokens: int = BLOCK_TOKENS,
    group_windows: int = GROUP_WINDOWS, keep_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents (doc_id, text) in packed windows, one row each.

    ``tokenizer`` is the path of a byte-level BPE file on the workers.  ``tier`` is the window's size, ``step_group``
    names windows to be trained in one step, ``ids`` holds the piece's tokens as 32-bit little-endian integers
    (null unless ``keep_ids``).  Null and empty texts are one separator.  Rows with equal or null ids are packed
    as separate documents.  Columns other than doc_id and text are ignored.  No rows in, no rows out.  Texts of any length
    are tokenized whole: a task holds one with its ids.  Tiers, gap filling and step groups see one block of ``block_tokens``
    tokens of one partition; nothing is balanced between blocks or tasks.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # room for 2^40 windows in each partition
        next_id = TaskContext.get().partitionId() << 40
        ids: list[np.ndarray] = []
        doc_ids: list = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            yield from _emit(ids, doc_ids, next_id, tiers, group_windows, keep_ids)
            # no more windows than tokens, even if each were one token
            next_id += held
            ids.clear()
            doc_ids.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                more = token_ids(part.column("text").to_pylist(), tokenizer)
                ids += more
                doc_ids += part.column("doc_id").to_pylist()
                held += sum(map(len, more))
                if held >= block_tokens:
                    yield from flush()
                    held = 0
        if ids:
            yield from flush()

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, PIECES_SQL)
