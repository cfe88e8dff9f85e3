"""Byte-pair encoding by a priority queue of merges over a linked list of symbols, and decoding."""

from __future__ import annotations

import functools
import json
import struct
import unicodedata
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kindred.llm.common import map_slices

# words, and runs of words, whose ids a worker remembers, in each of two generations: some 150 MB at most
REMEMBERED = 200_000


# these separate words for str.split, but are no white space to the pattern
SEPARATORS = regex.compile("[\x1c-\x1f]")


class Remembered:
    """Results in two generations: when one is full, the other, less recent one is dropped."""

    def __init__(self, entries: int = REMEMBERED):
        self.entries = entries
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(key) > 64:  # too rare and large to keep
            return
        if len(self.new) >= self.entries:
            self.old = self.new.copy()
            self.new.clear()
        self.new[key] = value


class Codec:
    """A word-level BPE file of the ``tokenizers`` library: NFC, lower case, a split pattern, byte letters, word ends.

    Special tokens are found in the raw text first.  Ids are kept as little-endian 32-bit strings.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        words = vocab | self.special
        self.strings = [""] * (max(words.values()) + 1)
        for word, i in words.items():
            self.strings[i] = word
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in plain)}
        suffix = model["end_of_word_suffix"] or ""
        self.inner = [vocab.get(letters[b]) for b in range(256)]
        self.last = [vocab.get(letters[b] + suffix) for b in range(256)]
        # (left id, right id) in one number -> rank, and the merged id of each rank
        self.ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(model["merges"])}
        self.merged = [vocab[a + b] for a, b in model["merges"]]
        self.alone = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        # the file's pattern for words; its \s is the White_Space property
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.known_words, self.known_runs = Remembered(), Remembered()

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges, the lowest rank first and of equal ones the leftmost."""
        n = len(symbols)
        rank_of, merged_id = self.ranks.get, self.merged
        # the rank of each symbol and the one after it, or -1
        ranks = [rank_of(left << 32 | right, -1) for left, right in zip(symbols, symbols[1:])]  # noqa: B905
        heap = [rank << 32 | i for i, rank in enumerate(ranks) if rank >= 0]  # rank and place in one number
        if not heap:
            return symbols
        ranks.append(-1)
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            if ranks[i] != rank:  # stale: a side was merged since this entry was made
                continue
            j = after[i]
            merged = symbols[i] = merged_id[rank]
            symbols[j] = ranks[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks[i] = rank_of(merged << 32 | symbols[k], -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | i)
            else:
                ranks[i] = -1
            h = before[i]
            if h >= 0:
                rank = ranks[h] = rank_of(symbols[h] << 32 | merged, -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> bytes:
        """The ids of one word of the split pattern."""
        ids = self.known_words.get(word)
        if ids is None:
            raw = word.encode()
            symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
            ids = struct.pack(f"<{len(found)}I", *found) if (found := self.merge([s for s in symbols if s is not None])) else b""
            self.known_words.put(word, ids)
        return ids

    def run(self, run: str) -> bytes:
        """The ids of characters without white space between."""
        ids = self.known_runs.get(run)
        if ids is None:
            ids = b"".join(map(self.word, self.words.findall(run)))
            self.known_runs.put(run, ids)
        return ids

    def _plain(self, text: str) -> bytes:
        # letters are lowered one by one: a capital sigma gives the same letter everywhere in a word
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if SEPARATORS.search(lowered):
            return b"".join(map(self.word, self.words.findall(lowered)))
        known, run = self.known_runs.new, self.run
        return b"".join([known.get(r) or run(r) for r in lowered.split()])

    def encode(self, text: str) -> bytes:
        """The ids of a text, little-endian 32-bit."""
        out, at = [], 0
        if "<" in text or not self.special:
            for found in self.alone.finditer(text):
                out += [self._plain(text[at : found.start()]), self.special[found[0]].to_bytes(4, "little")]
                at = found.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings of the ids, with a space between, as a file without a decoder asks for."""
        return " ".join(map(self.strings.__getitem__, memoryview(ids).cast("I").tolist()))


@functools.lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) for every row of (doc_id, text): ids as a string of little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of the file on the workers.  A null or empty text has no ids.  Equal rows give equal
    rows; other columns are ignored; no rows in, no rows out.
    """

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(tokenizer)
        ids = [own.encode(t or "") for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    cut = docs.select("doc_id", docs["text"].cast("string"))
    return map_slices(cut, "text", f"doc_id {cut.schema['doc_id'].dataType.simpleString()}, ids binary", kernel)


def decode(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` (with a column ids, as ``encode`` gives it) and the column ``decoded``; null ids decode to an empty text."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(tokenizer)
        texts = [own.decode(i or b"") for i in batch.column("ids").to_pylist()]
        return batch.append_column("decoded", pa.array(texts, pa.string()))

    kept = rows.drop("decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_slices(kept, "ids", f"{fields}, decoded string", kernel)
